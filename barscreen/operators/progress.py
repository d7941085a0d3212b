"""Net movement in ATR, the volume spent on it, and movement per unit of volume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barscreen.functions.orders import bar_order, day_order, slot_order
from barscreen.functions import trailing as tr
from barscreen.operators.volume import valid_bar
from barscreen.schema import ratio

PROGRESS_SPANS = (3, 5, 10)
VOLUME_SPANS = (3, 5)
MIN_PARTICIPATION = 0.1


def net_moves(bars: DataFrame, hourly: bool) -> DataFrame:
    """`ret_atr` and `progress_k`, and the volume totals `volume_history` ranks.

    Everything read in bar order. Needs the bar's own ATR: `atr20_bar` (hourly) or `atr20_day`.
    """
    order = bar_order() if hourly else day_order()
    atr = F.col("atr20_bar" if hourly else "atr20_day")
    columns = {"ret_atr": ratio(F.col("close") - tr.shifted(F.col("close"), order, 1), atr)}
    for k in PROGRESS_SPANS:
        columns[f"progress_{k}"] = ratio(F.col("close") - tr.shifted(F.col("close"), order, k), atr)
    for k in VOLUME_SPANS:
        columns[f"_sum_{k}"] = tr.span_total(F.col("volume"), order, k)
        columns[f"_ok_{k}"] = tr.span_all(valid_bar(), order, k)
    return bars.withColumns(columns)


def effort(usual: Column) -> Column:
    """`efficiency`: the move per share of the `usual` volume."""
    participation = ratio(F.col("volume"), usual)
    # A floor on a known participation only: `greatest` would turn an unknown one into it.
    floored = F.when(participation.isNotNull(), F.greatest(participation, F.lit(MIN_PARTICIPATION)))
    return F.abs(F.col("ret_atr")) / floored


def volume_history(moved: DataFrame, hourly: bool, window: int = 60) -> DataFrame:
    """`cum_vol_pct_k` and `efficiency`, against the same slot (hourly) before.

    A stretch of bars counts as a baseline only if every bar in it is valid.
    """
    like = slot_order() if hourly else day_order()
    measurable = tr.measurable(F.col("is_half_day")) if hourly else F.lit(True)
    need = tr.min_valid(window)
    histories = {
        f"_past_{k}": tr.past_values(F.col(f"_sum_{k}"), F.col(f"_ok_{k}"), like, window)
        for k in VOLUME_SPANS
    }
    histories["_usual"] = tr.past_values(F.col("volume"), valid_bar(), like, window)
    percentiles = {
        f"cum_vol_pct_{k}": F.when(
            measurable & F.col(f"_ok_{k}"),
            tr.percentile_in(F.col(f"_past_{k}"), F.col(f"_sum_{k}"), need),
        )
        for k in VOLUME_SPANS
    }
    efficiency = F.when(measurable, effort(tr.median_of(F.col("_usual"), need)))
    spent = [f"_{name}_{k}" for name in ("sum", "ok") for k in VOLUME_SPANS]
    return (
        moved.withColumns(histories)
        .withColumns({**percentiles, "efficiency": efficiency})
        .drop(*spent, *histories)
    )


def moves_and_effort(bars: DataFrame, hourly: bool) -> DataFrame:
    """`ret_atr`, `progress_k` and `efficiency` of bars that have their earlier closes and the median
    volume before them as columns."""
    atr, close = F.col("atr20_bar" if hourly else "atr20_day"), F.col("close")
    moves = {f"progress_{k}": ratio(close - F.col(f"_close_{k}"), atr) for k in PROGRESS_SPANS}
    bars = bars.withColumns({"ret_atr": ratio(close - F.col("_pc"), atr), **moves})
    return bars.withColumn("efficiency", effort(F.col("_usual")))


def progress(bars: DataFrame, hourly: bool, window: int = 60) -> DataFrame:
    return volume_history(net_moves(bars, hourly), hourly, window)
