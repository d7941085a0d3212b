"""How unusual a bar's volume is against its own history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barscreen.functions.orders import day_order, slot_order
from barscreen.functions import trailing as tr
from barscreen.schema import require



def valid_bar():
    return tr.baseline_valid(F.col("low_quality"), F.col("is_half_day"))


RANKS = ("_pct_long", "_pct_short", "_z_long")


def _against(bars: DataFrame, value: Column, window: WindowSpec, long: int, short: int) -> DataFrame:
    """`value` against its own `long` and `short` history (RANKS). The median and the distances
    from it are columns of their own, each worked out once."""
    past, last = F.col("_long"), F.col("_log")
    found = bars.withColumns(
        {
            "_long": tr.past_values(value, valid_bar(), window, long),
            "_short": tr.past_values(value, valid_bar(), window, short),
            "_log": value,
        }
    )
    found = found.withColumn("_mid", tr.centre_of(past))
    found = found.withColumn("_off", tr.distances(past, F.col("_mid")))
    need = tr.min_valid(long)
    ranks = (
        tr.percentile_in(past, last, need),
        tr.percentile_in(F.col("_short"), last, tr.min_valid(short)),
        tr.robust_z_of(past, F.col("_mid"), F.col("_off"), last, need),
    )
    return found.withColumns(dict(zip(RANKS, ranks))).drop("_long", "_short", "_log", "_mid", "_off")


def hourly_volume(bars: DataFrame, long: int = 60, short: int = 20) -> DataFrame:
    """`vol_pct_slot_60/20` and `vol_z_slot_60`: each slot against the same slot before."""
    require(bars, ["slot_index", "volume", "low_quality", "is_half_day"], "bars")
    value = tr.log_volume(F.col("volume"))
    measurable = tr.measurable(F.col("is_half_day"))
    found = _against(bars, value, slot_order(), long, short)
    return found.withColumns(
        {
            "vol_pct_slot_60": F.when(measurable, F.col("_pct_long")),
            "vol_pct_slot_20": F.when(measurable, F.col("_pct_short")),
            "vol_z_slot_60": F.when(measurable, F.col("_z_long")),
        }
    ).drop(*RANKS)


def daily_volume(bars: DataFrame, long: int = 120, short: int = 20) -> DataFrame:
    """The same on daily bars, without slots."""
    require(bars, ["volume", "low_quality"], "bars")
    value = tr.log_volume(F.col("volume"))
    found = _against(bars, value, day_order(), long, short)
    return found.withColumnsRenamed(dict(zip(RANKS, ("vol_pct_d_120", "vol_pct_d_20", "vol_z_d_120"))))
