"""The hourly and daily feature tables, assembled from the section operators.

Everything is keyed by security: the bars are shuffled to their security once and every window
(bar order, slot order, session order) reuses that partitioning, changing only the local sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barscreen.functions import trailing as tr
from barscreen.functions.orders import by_security, day_order
from barscreen.operators import daily as dl
from barscreen.operators import hourly as hr
from barscreen.operators import levels as lv
from barscreen.operators import market as mk
from barscreen.operators import pivots as pv
from barscreen.operators import progress as pg
from barscreen.operators import sequence as sq
from barscreen.operators import structure as st
from barscreen.operators import volatility as vt
from barscreen.operators import volume as vl
from barscreen.schema import alone, ratio

IDENTITY = ("security_key", "requested_ticker", "date")
VOLUME_HOURLY = ("vol_pct_slot_60", "vol_pct_slot_20", "vol_z_slot_60")
VOLUME_DAILY = ("vol_pct_d_120", "vol_pct_d_20", "vol_z_d_120")
VOLATILITY_HOURLY = ("true_range", "atr20_bar", "spread_atr", "spread_pct_slot_60")
VOLATILITY_DAILY = ("true_range", "atr20_day", "spread_atr")
GEOMETRY = ("body_frac", "upper_wick_frac", "lower_wick_frac", "close_loc")
PROGRESS = (
    "ret_atr", "progress_3", "progress_5", "progress_10", "cum_vol_pct_3", "cum_vol_pct_5",
    "efficiency",
)
MARKET = ("beta_60", "resid_ret_atr", "market_ret_day", "sector_resid_ret_atr", "sector_ret_day")
DISTANCES = (*[f"dist_{name}" for name in st.LEVELS], "dist_round_number")
PIVOTS = ("dist_nearest_swing_pivot", "dist_nearest_pivot_high", "dist_nearest_hvn")
NEAREST = ("level_touch_count", "level_age_bars")
SEQUENCE = ("repeat_hv_narrow_5", "repeat_upper_reject_5", "failed_new_high", "failed_new_low")
HOURLY = (
    *VOLUME_HOURLY, *VOLATILITY_HOURLY, *GEOMETRY, *PROGRESS, *MARKET, *DISTANCES, *PIVOTS,
    *NEAREST, *SEQUENCE,
)
DAILY = (*VOLUME_DAILY, *VOLATILITY_DAILY, *GEOMETRY, *PROGRESS, *MARKET, *DISTANCES)
PRICES = ("open", "high", "low", "close", "volume")


def daily_atr(daily: DataFrame) -> DataFrame:
    """`daily_atr` per session: the averaged range as of the previous close."""
    return vt.with_wilder_atr(vt.with_true_range(daily, day_order()), ["date"], "daily_atr").drop(
        "true_range"
    )


def session_context(daily: DataFrame, hourly: DataFrame | None) -> DataFrame:
    """Per security and session: ATR, levels, and (with hourly bars) pivots, node and touches."""
    context = st.session_levels(daily_atr(daily))
    if hourly is None:
        return context
    found = pv.pivots_by_session(pv.confirmed_pivots(daily_atr(daily))).select("security_key", "date", *pv.STATE[:4])
    nodes = pv.volume_nodes(daily, hourly)
    keys = ["security_key", "date"]
    return lv.touch_counts(context.join(found, keys, "left").join(nodes, keys, "left"))


def _raw_columns(raw: DataFrame, raw_daily: DataFrame, keys: list[str]) -> DataFrame:
    """As-traded closes with the as-traded daily ATR, for the round-number distance."""
    atr = daily_atr(raw_daily).select("security_key", "date", F.col("daily_atr").alias("raw_atr"))
    closes = raw.select(*keys, F.col("close").alias("raw_close"))
    return closes.join(atr, ["security_key", "date"], "left")


def hourly_features(
    bars: DataFrame,
    daily: DataFrame,
    market_hourly: DataFrame,
    market_daily: DataFrame,
    raw_bars: DataFrame | None = None,
    raw_daily: DataFrame | None = None,
    keep: tuple[str, ...] = (),
    rows: int | None = None,
    **sequence_limits,
) -> DataFrame:
    """Every hourly feature, one wide row a bar.

    `bars` and `daily` are split-adjusted; pass the as-traded ones as well where they differ.
    `rows`, the number of `bars`, keeps the tasks of large tables small.
    """
    used = dict.fromkeys((*IDENTITY, "slot_index", "timestamp_utc", "is_half_day", "low_quality", *PRICES, *[c for c in keep if c in bars.columns]))
    both = by_security(hr.with_sessions(bars.select(*used), daily), rows)
    out = _measured(both, market_hourly, market_daily, sequence_limits)
    if raw_bars is None:
        out = st.level_distances(out)
    else:
        keys = ["security_key", "date", "slot_index"]
        out = st.level_distances(
            out.join(_raw_columns(raw_bars, raw_daily, keys), keys, "left"), "raw_close", "raw_atr"
        )
    return _assembled(out, keep)


def hourly_features_of(
    both: DataFrame, market_hourly: DataFrame, market_daily: DataFrame, keep: tuple[str, ...] = (), **sequence_limits
) -> DataFrame:
    """`hourly_features` of bars with their sessions (`hr.with_sessions`) that lie at their security."""
    return _assembled(st.level_distances(_measured(both, market_hourly, market_daily, sequence_limits)), keep)


def _assembled(out: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    out = lv.nearest_level(pv.pivot_distances(out.withColumn("security_key", alone("security_key"))))
    return out.select(*IDENTITY, "slot_index", "timestamp_utc", "is_half_day", "low_quality", *HOURLY, *keep)


def _measured(both: DataFrame, market_hourly: DataFrame, market_daily: DataFrame, limits: dict) -> DataFrame:
    own = hr.with_hourly_measures(both, market_daily, **limits)
    own = own.withColumn("spread_atr", ratio(F.col("true_range"), F.col("atr20_bar")))
    own = sq.failed_extremes(pg.moves_and_effort(vt.geometry(own), hourly=True))
    own = own.withColumn("efficiency", F.when(tr.measurable(F.col("is_half_day")), F.col("efficiency")))
    own = own.withColumn("security_key", alone("security_key"))
    return mk.market_features(own, market_hourly, hourly=True)


def daily_features(
    bars: DataFrame,
    market_daily: DataFrame,
    raw_bars: DataFrame | None = None,
    keep: tuple[str, ...] = (),
    carried: DataFrame | None = None,
    rows: int | None = None,
) -> DataFrame:
    """One row a daily bar with its volume, range, progress, market and level measures.

    `carried` (security_key, close, ranges_seen, range_value, beta_60, paired) lets `bars` begin
    in the middle: what has no bounded window goes on from it, and rows that have all of
    their windows within `bars` come out as from the whole history. Kept columns may include
    `ranges_seen`, `range_value` and `paired`, the state after each bar. `rows`, the number of
    `bars`, keeps the tasks of large tables small.
    """
    if carried is None:
        used = dict.fromkeys((*IDENTITY, "timestamp_utc", "is_half_day", "low_quality", *PRICES, *[c for c in keep if c in bars.columns]))
        own = dl.with_daily_measures(by_security(bars.select(*used), rows), market_daily)
        own = vt.geometry(own.withColumn("spread_atr", ratio(F.col("true_range"), F.col("atr20_day"))))
        own = pg.moves_and_effort(own, hourly=False).withColumn("daily_atr", F.col("atr20_day"))
    else:
        own = _resumed(by_security(bars, rows), market_daily, carried)
    out = mk.market_features(own, market_daily, hourly=False)
    if raw_bars is None:
        out = st.level_distances(out)
    else:
        keys = ["security_key", "date"]
        out = st.level_distances(
            out.join(_raw_columns(raw_bars, raw_bars, keys), keys, "left"), "raw_close", "raw_atr"
        )
    return out.select(*IDENTITY, "timestamp_utc", "is_half_day", "low_quality", *DAILY, *keep)


def _resumed(bars: DataFrame, market_daily: DataFrame, carried: DataFrame) -> DataFrame:
    """What daily features read of the bars before, gone on with from `carried`, by windows: the
    few bars of late sessions."""
    fields = F.struct("close", "ranges_seen", "range_value").alias("_state")
    bars = bars.join(carried.select("security_key", fields), "security_key", "left")
    own = mk.with_beta(bars, market_daily, carried=carried)
    own = own.withColumn("_pc", F.lag("close").over(day_order()))
    own = vt.geometry(vt.daily_volatility(own, F.col("_state"), keep_state=True))
    own = pg.progress(vl.daily_volume(own), hourly=False)
    return st.session_levels(own.withColumn("daily_atr", F.col("atr20_day")))


def security_directory(bars: DataFrame) -> DataFrame:
    """The distinct securities with bars, and the ticker each was requested under."""
    return bars.groupBy("security_key").agg(F.min("requested_ticker").alias("requested_ticker"))
