"""All that a daily bar's features read of the bars before it, a partition at a time.

The same measures as in `volume`, `volatility`, `progress`, `market` and `structure`, whose
windows cost a large table some 160 CPU microseconds a bar.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barscreen.functions import vectors as vc
from barscreen.functions.trailing import min_valid
from barscreen.operators.market import BETA_WINDOW, market_series
from barscreen.operators.progress import PROGRESS_SPANS, VOLUME_SPANS
from barscreen.operators.structure import EXTREMES
from barscreen.operators.volatility import ATR_PERIOD

LONG, SHORT, USUAL = 120, 20, 60
COUNTS = ("paired", "ranges_seen")
MEASURES = (
    "beta_60", "_pc", "true_range", "atr20_day", "range_value", "vol_pct_d_120", "vol_pct_d_20", "vol_z_d_120",
    *[f"_close_{k}" for k in PROGRESS_SPANS], *[f"cum_vol_pct_{k}" for k in VOLUME_SPANS], "_usual",
    "prior_day_high", "prior_day_low", *[f"{side}_{n}" for n in EXTREMES for side in ("high", "low")],
    *[f"prior_{p}_{side}" for p in ("week", "month") for side in ("high", "low")],
)


def valid(rows: pa.Table) -> np.ndarray:
    """`volume.valid_bar`."""
    unknown = rows["low_quality"].combine_chunks().is_null().to_numpy(zero_copy_only=False)
    return ~vc.flags(rows, "low_quality") & ~unknown & ~vc.flags(rows, "is_half_day")


def spans(volume: np.ndarray, valid: np.ndarray, place: np.ndarray) -> dict[int, np.ndarray]:
    """The volume of VOLUME_SPANS bars up to each, where all of them are valid: only a stretch that
    is valid itself is ranked."""
    out = {}
    for k in VOLUME_SPANS:
        total = volume
        for back in range(1, k):
            total = vc.lag(volume, back, place) + total
        whole = (vc.count_before(valid, k - 1, place) == k - 1) & valid
        out[k] = np.where(whole, total, np.nan)
    return out


def _volume(found: dict, rows: pa.Table, place: np.ndarray) -> None:
    volume, usable = vc.doubles(rows, "volume"), valid(rows)
    log = np.log1p(volume)
    logs, volumes = np.where(usable, log, np.nan), np.where(usable, volume, np.nan)
    known = spans(volume, usable, place)
    names = ("vol_pct_d_120", "vol_pct_d_20", "vol_z_d_120", "_usual", *[f"cum_vol_pct_{k}" for k in VOLUME_SPANS])
    found |= {name: np.empty(len(place)) for name in names}
    for at in vc.chunks(len(place)):
        long = vc.windows(logs, LONG, place, at)
        found["vol_pct_d_120"][at] = vc.share_below(long, log[at], min_valid(LONG))
        found["vol_pct_d_20"][at] = vc.share_below(long[:, -SHORT:], log[at], min_valid(SHORT))
        found["vol_z_d_120"][at] = vc.robust_z(long, log[at], min_valid(LONG))
        found["_usual"][at] = vc.median(vc.windows(volumes, USUAL, place, at), min_valid(USUAL))
        for k, stretch in known.items():
            found[f"cum_vol_pct_{k}"][at] = vc.share_below(vc.windows(stretch, USUAL, place, at), stretch[at], min_valid(USUAL))


def with_beta(found: dict, close: np.ndarray, market: np.ndarray, week: np.ndarray, place: np.ndarray) -> None:
    previous = vc.lag(close, 1, place)
    change = np.divide(close, previous, out=np.full(len(close), np.nan), where=previous != 0) - 1.0
    both = ~np.isnan(change) & ~np.isnan(market)
    opens = (place == 0) | np.concatenate([[True], week[1:] != week[:-1]])[: len(week)]
    paired = vc.so_far(both, place)
    wanted = both & opens & (vc.count_before(both, BETA_WINDOW, place) >= min_valid(BETA_WINDOW)) & (paired > BETA_WINDOW)
    # The rows with both returns lie side by side, so that a window is of them only.
    rank, fit = np.cumsum(both) - 1, np.full(len(close), np.nan)
    ys, xs, among = change[both], market[both], paired[both] - 1
    rows = np.flatnonzero(wanted)
    for at in vc.chunks(len(rows)):
        pick = rank[rows[at]]
        fit[rows[at]] = vc.slope(vc.windows(ys, BETA_WINDOW, among, pick), vc.windows(xs, BETA_WINDOW, among, pick))
    found |= {"beta_60": vc.held(fit, place), "paired": paired.astype(np.int64)}


def true_range(high: np.ndarray, low: np.ndarray, close: np.ndarray, place: np.ndarray) -> np.ndarray:
    previous = vc.lag(close, 1, place)
    reach = np.maximum(high - low, np.maximum(np.abs(high - previous), np.abs(low - previous)))
    return np.where(np.isnan(previous), high - low, reach)


def periods(day: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the weeks, from Monday on, and of the months."""
    return (day + 3) // 7, day.astype("datetime64[D]").astype("datetime64[M]").astype(np.int64)


def with_levels(found: dict, high: np.ndarray, low: np.ndarray, week: np.ndarray, month: np.ndarray, place: np.ndarray) -> None:
    found |= {"prior_day_high": vc.lag(high, 1, place), "prior_day_low": vc.lag(low, 1, place)}
    found |= {f"{side}_{n}": np.empty(len(place)) for n in EXTREMES for side in ("high", "low")}
    for at in vc.chunks(len(place)):
        tops, bottoms = (vc.windows(side, max(EXTREMES), place, at) for side in (high, low))
        for n in EXTREMES:
            found[f"high_{n}"][at], found[f"low_{n}"][at] = tops[:, -n:].max(axis=1), bottoms[:, -n:].min(axis=1)
    for name, period in (("week", week), ("month", month)):
        found[f"prior_{name}_high"] = vc.prior_extreme(high, period, place, np.fmax)
        found[f"prior_{name}_low"] = vc.prior_extreme(low, period, place, np.fmin)


def _measures(rows: pa.Table, place: np.ndarray) -> pa.Table:
    high, low, close = (vc.doubles(rows, c) for c in ("high", "low", "close"))
    week, month = periods(rows["_day"].to_numpy())
    found: dict[str, np.ndarray] = {"_pc": vc.lag(close, 1, place), "true_range": true_range(high, low, close, place)}
    with_beta(found, close, vc.doubles(rows, "_m"), week, place)
    found["atr20_day"], found["ranges_seen"], found["range_value"] = vc.averaged(found["true_range"], place, ATR_PERIOD)
    found |= {f"_close_{k}": vc.lag(close, k, place) for k in PROGRESS_SPANS}
    _volume(found, rows, place)
    with_levels(found, high, low, week, month, place)
    return vc.with_columns(rows, found)


def _partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(invalid="ignore", divide="ignore"):
        for batch in vc.by_group(batches, "security_key", _measures):
            yield batch.select([*[c for c in batch.schema.names if c not in (*MEASURES, *COUNTS)], *MEASURES, *COUNTS])


def with_daily_measures(bars: DataFrame, market_daily: DataFrame) -> DataFrame:
    """MEASURES and COUNTS of daily bars that lie at their security; they are sorted there, not moved."""
    returns = F.broadcast(market_series(market_daily, hourly=False).withColumnRenamed("market_return", "_m"))
    rows = bars.join(returns, "date", "left").withColumn("_day", F.unix_date("date"))
    rows = rows.sortWithinPartitions("security_key", "date")
    schema = ", ".join(
        [f"{c} {kind}" for c, kind in rows.dtypes] + [f"{c} double" for c in MEASURES] + [f"{c} bigint" for c in COUNTS]
    )
    return rows.mapInArrow(_partition, schema).drop("_m", "_day")
