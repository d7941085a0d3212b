"""Trailing-window and feature queries.

Hourly features run on nation x week with line-number slots, daily ones on nation x day, and
the plain window measures on supplier x week, whose bars grow with the data.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from barscreen.functions import trailing as tr
from barscreen.functions.orders import bar_order, by_security, day_order
from barscreen.operators import levels as lv
from barscreen.operators import market as mk
from barscreen.operators import pivots as pv
from barscreen.operators import progress as pg
from barscreen.operators import sequence as sq
from barscreen.operators import structure as st
from barscreen.operators import volatility as vt
from barscreen.operators import volume as vl
from barscreen.plans import adapters as ad
from barscreen.plans import features as ft
from barscreen.plans.catalog import base as b
from barscreen.plans.catalog.base import BAR_W, DAY_W, SLOT_W, SO_FAR, chain, frame, query, select, tidy
from barscreen.session import cut_lineage, shared_folder
from barscreen.sources import store
from barscreen.streaming import carried

BAR = ["security_key", "date", "slot_index"]
DAY = ["security_key", "date"]
VALID = "NOT low_quality AND NOT is_half_day"

# --- plain trailing measures ----------------------------------------------------


def _bars(spark, sf):
    return by_security(ad.slot_bars(spark, sf))


def _days(spark, sf, security="nation", session="week"):
    return by_security(ad.day_bars(spark, sf, security, session))




@query(
    select(
        b.days("supplier", "week"),
        f"""(SELECT security_key, date,
    count(CASE WHEN {VALID} THEN 1 END) OVER (w {frame(20)}) AS n_20,
    CASE WHEN count(CASE WHEN {VALID} THEN 1 END) OVER (w {frame(60)}) >= 40
      THEN median(volume) FILTER ({VALID}) OVER (w {frame(60)}) END AS median_60,
    CASE WHEN count(high) OVER (w {frame(10)}) = 10 THEN max(high) OVER (w {frame(10)}) END AS high_10,
    CASE WHEN count(low) OVER (w {frame(10)}) = 10 THEN min(low) OVER (w {frame(10)}) END AS low_10,
    CASE WHEN count(*) OVER (w {frame(5)}) = 5
      THEN CAST(count(CASE WHEN volume > 40 THEN 1 END) OVER (w {frame(5)}) AS DOUBLE) END AS busy_5,
    CASE WHEN count(volume) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 3
      THEN sum(volume) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) END AS span_3,
    count(CASE WHEN volume > 20 THEN 1 END) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 3 AS all_3,
    lag(close, 3) OVER w AS close_3_ago,
    min(low) OVER (w {SO_FAR}) AS running_low,
    last_value(CASE WHEN volume > 60 THEN volume END IGNORE NULLS) OVER (w {SO_FAR}) AS last_busy,
    close / lag(close) OVER w - 1 AS change
  FROM days WINDOW w AS ({DAY_W}))""",
        "security_key date n_20 median_60 high_10 low_10 busy_5 span_3 all_3 close_3_ago running_low last_busy",
        "change",
    )
)
def trailing_measures(spark, sf):
    days = _days(spark, sf, "supplier", "week")
    w, volume, close = day_order(), F.col("volume"), F.col("close")
    return tidy(
        days.select(
            *DAY,
            tr.trailing_count(vl.valid_bar(), w, 20).alias("n_20"),
            tr.trailing_median(volume, vl.valid_bar(), w, 60).alias("median_60"),
            tr.highest_before(F.col("high"), w, 10).alias("high_10"),
            tr.lowest_before(F.col("low"), w, 10).alias("low_10"),
            tr.count_before(volume > 40, w, 5).alias("busy_5"),
            tr.span_total(volume, w, 3).alias("span_3"),
            tr.span_all(volume > 20, w, 3).alias("all_3"),
            tr.shifted(close, w, 3).alias("close_3_ago"),
            tr.running_low(F.col("low"), w).alias("running_low"),
            tr.forward_fill(F.when(volume > 60, volume), w).alias("last_busy"),
            tr.fractional_change(close, w).alias("change"),
        ),
        exact="median_60 high_10 low_10 busy_5 span_3 close_3_ago running_low last_busy",
    )


# --- volume -------------------------------------------------------------------

VOLUME = f"""vol AS (SELECT security_key, date, slot_index,
    CASE WHEN NOT is_half_day THEN {b.percentile('l60', 'lv', 40)} END AS vol_pct_slot_60,
    CASE WHEN NOT is_half_day THEN {b.percentile('l20', 'lv', 14)} END AS vol_pct_slot_20,
    CASE WHEN NOT is_half_day AND len(l60) >= 40 AND spread > 0 THEN (lv - med) / (1.4826 * spread) END AS vol_z_slot_60
  FROM (SELECT *, list(lv) FILTER ({VALID}) OVER (w {frame(60)}) AS l60,
      list(lv) FILTER ({VALID}) OVER (w {frame(20)}) AS l20,
      median(lv) FILTER ({VALID}) OVER (w {frame(60)}) AS med, mad(lv) FILTER ({VALID}) OVER (w {frame(60)}) AS spread
    FROM (SELECT *, ln(volume + 1) AS lv FROM bars) WINDOW w AS ({SLOT_W})))"""
VOLUME_COLS = " ".join(ft.VOLUME_HOURLY)


@query(select(chain(b.bars(), VOLUME), "vol", "security_key date slot_index", VOLUME_COLS))
def hourly_volume(spark, sf):
    return tidy(vl.hourly_volume(_bars(spark, sf)), *BAR, *ft.VOLUME_HOURLY)


DVOLUME = f"""dvol AS (SELECT security_key, date,
    {b.percentile('l120', 'lv', 80)} AS vol_pct_d_120, {b.percentile('l20', 'lv', 14)} AS vol_pct_d_20,
    CASE WHEN len(l120) >= 80 AND spread > 0 THEN (lv - med) / (1.4826 * spread) END AS vol_z_d_120
  FROM (SELECT *, list(lv) FILTER ({VALID}) OVER (w {frame(120)}) AS l120,
      list(lv) FILTER ({VALID}) OVER (w {frame(20)}) AS l20,
      median(lv) FILTER ({VALID}) OVER (w {frame(120)}) AS med, mad(lv) FILTER ({VALID}) OVER (w {frame(120)}) AS spread
    FROM (SELECT *, ln(volume + 1) AS lv FROM days) WINDOW w AS ({DAY_W})))"""


@query(select(chain(b.days("supplier", "week"), DVOLUME), "dvol", "security_key date", " ".join(ft.VOLUME_DAILY)))
def daily_volume(spark, sf):
    return tidy(vl.daily_volume(_days(spark, sf, "supplier", "week")), *DAY, *ft.VOLUME_DAILY)


# --- volatility, geometry, progress ---------------------------------------------

VOLAT = chain(
    b.atr("bars", "date, slot_index", "abar"),
    f"""volat AS (SELECT *, CASE WHEN atr20 > 0 THEN true_range / atr20 END AS spread_atr, atr20 AS atr20_bar,
    CASE WHEN NOT is_half_day THEN {b.percentile('t60', 'true_range', 40)} END AS spread_pct_slot_60
  FROM (SELECT *, list(true_range) FILTER ({VALID} AND true_range IS NOT NULL) OVER ({SLOT_W} {frame(60)}) AS t60 FROM abar))""",
)


@query(
    select(
        chain(b.bars(), VOLAT),
        "(SELECT *, round(atr20_bar, 4) + 0.0 AS atr FROM volat)",
        "security_key date slot_index true_range atr",
        "spread_atr spread_pct_slot_60",
    )
)
def hourly_volatility(spark, sf):
    found = vt.hourly_volatility(_bars(spark, sf))
    found = found.withColumn("atr", F.round("atr20_bar", 4) + F.lit(0.0))
    return tidy(found, *BAR, "true_range", "atr", "spread_atr", "spread_pct_slot_60", exact="true_range atr")


@query(select(chain(b.days("supplier", "week"), b.atr("days", "date", "aday")), "aday", "security_key date", "atr20", digits=4))
def daily_atr(spark, sf):
    found = ft.daily_atr(_days(spark, sf, "supplier", "week"))
    return tidy(found.withColumnRenamed("daily_atr", "atr20"), *DAY, "atr20", digits=4)


GEOMETRY = """geo AS (SELECT security_key, date, slot_index,
    CASE WHEN true_range > 0 THEN abs(close - open) / true_range END AS body_frac,
    CASE WHEN true_range > 0 THEN (high - greatest(open, close)) / true_range END AS upper_wick_frac,
    CASE WHEN true_range > 0 THEN (least(open, close) - low) / true_range END AS lower_wick_frac,
    CASE WHEN high - low > 0 THEN (close - low) / (high - low) END AS close_loc FROM volat)"""


@query(select(chain(b.bars(), VOLAT, GEOMETRY), "geo", "security_key date slot_index", " ".join(ft.GEOMETRY)))
def bar_geometry(spark, sf):
    ranged = vt.with_true_range(_bars(spark, sf), bar_order())
    return tidy(vt.geometry(ranged), *BAR, *ft.GEOMETRY)


def _progress_sql(source: str, order: str, like: str, hourly: bool) -> str:
    keys = "security_key, date, slot_index" if hourly else "security_key, date"
    guard = "NOT is_half_day AND " if hourly else ""
    moves = ", ".join(
        f"CASE WHEN atr20 > 0 THEN (close - lag(close, {k}) OVER w) / atr20 END AS {n}"
        for n, k in (("ret_atr", 1), ("progress_3", 3), ("progress_5", 5), ("progress_10", 10))
    )
    spans = ", ".join(
        f"""CASE WHEN count(volume) OVER s{k} = {k} THEN sum(volume) OVER s{k} END AS sum{k},
        count(CASE WHEN {VALID} THEN 1 END) OVER s{k} = {k} AS ok{k}"""
        for k in (3, 5)
    )
    return f"""prg AS (SELECT {keys}, ret_atr, progress_3, progress_5, progress_10,
    CASE WHEN {guard}ok3 THEN {b.percentile('h3', 'sum3', 40)} END AS cum_vol_pct_3,
    CASE WHEN {guard}ok5 THEN {b.percentile('h5', 'sum5', 40)} END AS cum_vol_pct_5,
    CASE WHEN {guard}usual > 0 AND n60 >= 40 AND ret_atr IS NOT NULL
      THEN abs(ret_atr) / greatest(volume / usual, 0.1) END AS efficiency
  FROM (SELECT *, list(sum3) FILTER (ok3 AND sum3 IS NOT NULL) OVER (w {frame(60)}) AS h3,
      list(sum5) FILTER (ok5 AND sum5 IS NOT NULL) OVER (w {frame(60)}) AS h5,
      median(volume) FILTER ({VALID}) OVER (w {frame(60)}) AS usual,
      count(CASE WHEN {VALID} THEN 1 END) OVER (w {frame(60)}) AS n60
    FROM (SELECT *, {moves}, {spans} FROM {source}
      WINDOW w AS ({order}), s3 AS ({order} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
        s5 AS ({order} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
    WINDOW w AS ({like})))"""


PROGRESS = _progress_sql("volat", BAR_W, SLOT_W, True)


@query(select(chain(b.bars(), VOLAT, PROGRESS), "prg", "security_key date slot_index", " ".join(ft.PROGRESS)))
def hourly_progress(spark, sf):
    return tidy(pg.progress(vt.hourly_volatility(_bars(spark, sf)), True), *BAR, *ft.PROGRESS)


# --- the market ---------------------------------------------------------------


@query(select(chain(b.days("nation", "day"), b.market("day"), b.BETA), "beta", "security_key date", "beta_60"))
def weekly_beta(spark, sf):
    daily = _days(spark, sf, "nation", "day")
    _, market = ad.market_bars(spark, sf, "day")
    return tidy(mk.beta_by_session(daily, market).drop("paired"))


MARKET = f"""mkt AS (SELECT v.security_key, v.date, v.slot_index, beta_60,
    CASE WHEN atr20 > 0 THEN (close - prev - beta_60 * m * prev) / atr20 END AS resid_ret_atr, market_ret_day,
    CAST(NULL AS DOUBLE) AS sector_resid_ret_atr, CAST(NULL AS DOUBLE) AS sector_ret_day
  FROM (SELECT *, lag(close) OVER ({BAR_W}) AS prev FROM volat) v
  LEFT JOIN beta USING (security_key, date) LEFT JOIN mbret USING (date, slot_index) LEFT JOIN mbday USING (date))"""


@query(select(chain(b.bars(), VOLAT, b.market(), b.BETA, MARKET), "mkt", "security_key date slot_index", " ".join(ft.MARKET)))
def hourly_market(spark, sf):
    bars, days = _bars(spark, sf), _days(spark, sf)
    hourly, daily = ad.market_bars(spark, sf)
    own = vt.hourly_volatility(bars).withColumn("_pc", F.lag("close").over(bar_order()))
    own = own.join(mk.beta_by_session(days, daily).drop("paired"), DAY, "left")
    return tidy(mk.market_features(own, hourly, True), *BAR, *ft.MARKET)


# --- levels -------------------------------------------------------------------


def _last_at(side: str, level: str) -> str:
    return (
        f"(SELECT max(e.pos) FROM ctx e WHERE e.security_key = c.security_key AND e.pos < c.pos "
        f"AND e.{side} = c.{level})"
    )


def _period(name: str) -> str:
    return f"""prior_{name} AS (SELECT security_key, period, lag(high) OVER w AS prior_{name}_high, lag(low) OVER w AS prior_{name}_low
  FROM (SELECT security_key, date_trunc('{name}', date) AS period, max(high) AS high, min(low) AS low
    FROM days GROUP BY 1, 2) WINDOW w AS (PARTITION BY security_key ORDER BY period))"""


LEVELS = chain(
    _period("week"),
    _period("month"),
    f"""ctx AS MATERIALIZED (SELECT d.*, row_number() OVER w - 1 AS pos, lag(high) OVER w AS prior_day_high, lag(low) OVER w AS prior_day_low,
    prior_week_high, prior_week_low, prior_month_high, prior_month_low,
    CASE WHEN count(high) OVER w20 = 20 THEN max(high) OVER w20 END AS high_20,
    CASE WHEN count(low) OVER w20 = 20 THEN min(low) OVER w20 END AS low_20,
    CASE WHEN count(high) OVER w60 = 60 THEN max(high) OVER w60 END AS high_60,
    CASE WHEN count(low) OVER w60 = 60 THEN min(low) OVER w60 END AS low_60
  FROM aday d LEFT JOIN prior_week pw ON pw.security_key = d.security_key AND pw.period = date_trunc('week', d.date)
  LEFT JOIN prior_month pm ON pm.security_key = d.security_key AND pm.period = date_trunc('month', d.date)
  WINDOW w AS (PARTITION BY d.security_key ORDER BY d.date), w20 AS (PARTITION BY d.security_key ORDER BY d.date {frame(20)}),
    w60 AS (PARTITION BY d.security_key ORDER BY d.date {frame(60)})),
lev AS MATERIALIZED (SELECT c.*, {_last_at('high', 'high_20')} AS set_high_20, {_last_at('low', 'low_20')} AS set_low_20,
    {_last_at('high', 'prior_week_high')} AS set_prior_week_high, {_last_at('low', 'prior_week_low')} AS set_prior_week_low,
    {_last_at('high', 'prior_month_high')} AS set_prior_month_high FROM ctx c)""",
)
SETS = "set_high_20 set_low_20 set_prior_week_high set_prior_week_low set_prior_month_high"
DAILY_ATR = b.atr("days", "date", "aday", "d")


@query(select(chain(b.days("nation", "day"), DAILY_ATR, LEVELS), "lev", f"security_key date pos {' '.join(st.LEVELS)} {SETS}"))
def session_levels(spark, sf):
    found = st.session_levels(_days(spark, sf, "nation", "day"))
    return found.select(*DAY, "pos", *st.LEVELS, *SETS.split())


PIVOTS = """piv(security_key, pos, up, ext, place, ph, php, pl, plp) AS (
  SELECT security_key, pos, true, high, pos, CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT)
  FROM ctx WHERE pos = 0
  UNION ALL
  SELECT security_key, pos, CASE WHEN turns THEN NOT up ELSE up END,
    CASE WHEN runs THEN (CASE WHEN up THEN high ELSE low END) WHEN turns THEN (CASE WHEN up THEN low ELSE high END) ELSE ext END,
    CASE WHEN runs OR turns THEN pos ELSE place END,
    CASE WHEN turns AND up THEN ext ELSE ph END, CASE WHEN turns AND up THEN place ELSE php END,
    CASE WHEN turns AND NOT up THEN ext ELSE pl END, CASE WHEN turns AND NOT up THEN place ELSE plp END
  FROM (SELECT *, NOT runs AND atr20 > 0 AND coalesce(CASE WHEN up THEN ext - low ELSE high - ext END >= 1.5 * atr20, false) AS turns
    FROM (SELECT p.security_key, d.pos, p.up, p.ext, p.place, p.ph, p.php, p.pl, p.plp, d.high, d.low, coalesce(d.atr20, 0) AS atr20,
        CASE WHEN p.up THEN d.high >= p.ext ELSE d.low <= p.ext END AS runs
      FROM piv p JOIN ctx d ON d.security_key = p.security_key AND d.pos = p.pos + 1))),
pivs AS (SELECT ctx.security_key, ctx.date, ctx.pos, lag(ph) OVER w AS pivot_high, lag(php) OVER w AS set_pivot_high,
    lag(pl) OVER w AS pivot_low, lag(plp) OVER w AS set_pivot_low
  FROM ctx JOIN piv USING (security_key, pos) WINDOW w AS (PARTITION BY ctx.security_key ORDER BY ctx.pos))"""


@query(
    select(
        chain(b.days("nation", "week"), DAILY_ATR, LEVELS, PIVOTS),
        "(SELECT * REPLACE (CAST(set_pivot_high AS DOUBLE) AS set_pivot_high, CAST(set_pivot_low AS DOUBLE) AS set_pivot_low) FROM pivs)",
        "security_key date pivot_high set_pivot_high pivot_low set_pivot_low",
    )
)
def swing_pivots(spark, sf):
    found = pv.pivots_by_session(pv.confirmed_pivots(ft.daily_atr(_days(spark, sf))))
    return found.select(*DAY, *pv.STATE[:4])


NODES = """nwin AS (SELECT d.security_key, d.pos, h.close, h.volume, min(h.low) OVER w AS lo, max(h.high) OVER w AS hi
  FROM ctx d JOIN ctx o ON o.security_key = d.security_key AND o.pos BETWEEN d.pos - 60 AND d.pos - 1
  JOIN bars h ON h.security_key = o.security_key AND h.date = o.date
  WHERE d.pos >= 60 WINDOW w AS (PARTITION BY d.security_key, d.pos)),
nbin AS (SELECT security_key, pos, lo, hi, least(greatest(CAST(floor((close - lo) / ((hi - lo) / 50)) AS INTEGER), 0), 49) AS bin, sum(volume) AS v
  FROM nwin WHERE close IS NOT NULL AND hi > lo GROUP BY ALL),
nodes AS (SELECT security_key, pos, lo + (bin + 0.5) * (hi - lo) / 50 AS node
  FROM (SELECT *, row_number() OVER (PARTITION BY security_key, pos ORDER BY v DESC, bin) AS r FROM nbin) WHERE r = 1)"""


@query(
    select(
        chain(b.bars(), DAILY_ATR, LEVELS, NODES),
        "(SELECT security_key, date, node / close AS node_to_close FROM ctx LEFT JOIN nodes USING (security_key, pos))",
        "security_key date",
        "node_to_close",
    )
)
def volume_node(spark, sf):
    bars, days = cut_lineage(_bars(spark, sf)), cut_lineage(_days(spark, sf))
    found = days.join(pv.volume_nodes(days, bars), DAY, "left")
    return tidy(found.select(*DAY, (F.col("node") / F.col("close")).alias("node_to_close")))


TOUCH = ", ".join(
    f"CASE WHEN {a} IS NOT NULL AND pos > 0 THEN CAST((SELECT count(*) FROM ctx e WHERE e.security_key = c.security_key "
    f"AND e.pos BETWEEN c.pos - 60 AND c.pos - 1 AND e.low <= c.{a} AND e.high >= c.{a}) AS DOUBLE) END AS touch_{a}"
    for a in lv.ANCHORS
)
ANCHORED = f"""anc AS MATERIALIZED (SELECT c.*, {TOUCH} FROM (SELECT lev.*, pivot_high, set_pivot_high, pivot_low FROM lev JOIN pivs USING (security_key, date, pos)) c)"""
TOUCHES = [f"touch_{a}" for a in lv.ANCHORS]


@query(select(chain(b.bars(), DAILY_ATR, LEVELS, PIVOTS, ANCHORED), "anc", f"security_key date {' '.join(TOUCHES)}"))
def level_touches(spark, sf):
    bars, days = cut_lineage(_bars(spark, sf)), _days(spark, sf)
    return ft.session_context(days, bars).select(*DAY, *TOUCHES)


@query(
    "WITH RECURSIVE "
    + chain(b.bars(), DAILY_ATR, LEVELS, PIVOTS)
    + " "
    + " UNION ALL ".join(
        f"SELECT security_key, date, '{a}' AS anchor, {a} AS price FROM lev JOIN pivs USING (security_key, date, pos)"
        for a in lv.ANCHORS
    )
)
def anchor_prices(spark, sf):
    bars, days = cut_lineage(_bars(spark, sf)), _days(spark, sf)
    return lv.anchor_prices(ft.session_context(days, bars))


DISTANCE = ", ".join(
    f"CASE WHEN c.atr20 > 0 THEN (h.close - {n}) / c.atr20 END AS dist_{n}" for n in st.LEVELS
)
ROUND = "CASE WHEN c.atr20 > 0 THEN (h.close - round_even(h.close / 0.5, 0) * 0.5) / c.atr20 END AS dist_round_number"
GAPS = ", ".join(
    f"CASE WHEN {a} IS NOT NULL AND h.close IS NOT NULL THEN {{'g': abs({a} - h.close), 'i': {i}, 't': touch_{a}, 's': CAST(set_{a} AS DOUBLE)}} END"
    for i, a in enumerate(lv.ANCHORS)
)
STRUCTURE = f"""str AS (SELECT security_key, date, slot_index, {', '.join(f'dist_{n}' for n in st.LEVELS)}, dist_round_number,
    CASE WHEN th IS NOT NULL AND (tl IS NULL OR abs(th) <= abs(tl)) THEN th ELSE tl END AS dist_nearest_swing_pivot,
    th AS dist_nearest_pivot_high, dist_nearest_hvn, near.t AS level_touch_count, pos - near.s AS level_age_bars
  FROM (SELECT *, list_min(list_filter([{GAPS}], lambda x: x IS NOT NULL)) AS near
    FROM (SELECT h.security_key, h.date, h.slot_index, h.close, c.pos, {DISTANCE}, {ROUND},
        CASE WHEN c.atr20 > 0 THEN (h.close - pivot_high) / c.atr20 END AS th,
        CASE WHEN c.atr20 > 0 THEN (h.close - pivot_low) / c.atr20 END AS tl,
        CASE WHEN c.atr20 > 0 THEN (h.close - node) / c.atr20 END AS dist_nearest_hvn,
        {', '.join(f'{a}, touch_{a}, set_{a}' for a in lv.ANCHORS)}
      FROM bars h LEFT JOIN anc c USING (security_key, date) LEFT JOIN nodes USING (security_key, pos)) h))"""
STRUCTURE_ALL = chain(DAILY_ATR, LEVELS, PIVOTS, NODES, ANCHORED, STRUCTURE)
STRUCTURE_COLS = (*ft.DISTANCES, *ft.PIVOTS, *ft.NEAREST)


@query(select(chain(b.bars(), STRUCTURE_ALL), "str", "security_key date slot_index", " ".join(STRUCTURE_COLS)))
def level_distances(spark, sf):
    bars, days = cut_lineage(_bars(spark, sf)), _days(spark, sf)
    context = ft.session_context(days, bars).drop(
        "open", "high", "low", "close", "volume", "requested_ticker", "ticker", "timestamp_utc",
        "is_half_day", "low_quality", "transactions", "minutes_with_trades",
    )
    joined = bars.join(context, DAY, "left")
    found = lv.nearest_level(pv.pivot_distances(st.level_distances(joined, raw_atr="daily_atr")))
    return tidy(found, *BAR, *STRUCTURE_COLS)


# --- sequence and the assembled tables --------------------------------------------

SEQUENCE = f"""seq AS (SELECT security_key, date, slot_index,
    CASE WHEN count(*) OVER w5 = 5 THEN CAST(sum(CASE WHEN coalesce(vol_pct_slot_60 >= 90 AND spread_atr <= 0.6, false) THEN 1 ELSE 0 END) OVER w5 AS DOUBLE) END AS repeat_hv_narrow_5,
    CASE WHEN count(*) OVER w5 = 5 THEN CAST(sum(CASE WHEN coalesce(vol_pct_slot_60 >= 90 AND upper_wick_frac >= 0.5, false) THEN 1 ELSE 0 END) OVER w5 AS DOUBLE) END AS repeat_upper_reject_5,
    CASE WHEN count(high) OVER w10 = 10 AND count(close) OVER w10 = 10 AND high IS NOT NULL AND close IS NOT NULL
      THEN high > max(high) OVER w10 AND close <= max(close) OVER w10 END AS failed_new_high,
    CASE WHEN count(low) OVER w10 = 10 AND count(close) OVER w10 = 10 AND low IS NOT NULL AND close IS NOT NULL
      THEN low < min(low) OVER w10 AND close >= min(close) OVER w10 END AS failed_new_low
  FROM volat JOIN vol USING (security_key, date, slot_index) JOIN geo USING (security_key, date, slot_index)
  WINDOW w5 AS ({BAR_W} {frame(5)}), w10 AS ({BAR_W} {frame(10)}))"""


@query(
    select(
        chain(b.bars(), VOLUME, VOLAT, GEOMETRY, SEQUENCE), "seq",
        "security_key date slot_index " + " ".join(ft.SEQUENCE),
    )
)
def bar_sequence(spark, sf):
    own = vl.hourly_volume(vt.geometry(vt.hourly_volatility(_bars(spark, sf))))
    return sq.sequence_features(own).select(*BAR, *ft.SEQUENCE)


ASSEMBLED = chain(
    VOLUME, VOLAT, GEOMETRY, PROGRESS, b.BETA, MARKET, STRUCTURE_ALL, SEQUENCE,
    """feat AS (SELECT * FROM (SELECT security_key, date, slot_index, is_half_day, low_quality, open, high, low, close, volume,
      true_range, atr20_bar, spread_atr, spread_pct_slot_60 FROM volat)
  JOIN vol USING (security_key, date, slot_index) JOIN geo USING (security_key, date, slot_index)
  JOIN prg USING (security_key, date, slot_index) JOIN mkt USING (security_key, date, slot_index)
  JOIN str USING (security_key, date, slot_index) JOIN seq USING (security_key, date, slot_index)
  LEFT JOIN (SELECT security_key, date, atr20 AS daily_atr FROM aday) USING (security_key, date))""",
)
HOURLY_CTES = chain(b.bars(), b.market(), ASSEMBLED)
FLAGS = ("failed_new_high", "failed_new_low")
HOURLY_DOUBLES = tuple(c for c in ft.HOURLY if c not in (*FLAGS, "true_range", "atr20_bar"))


FEATURE_PLAIN = "security_key date slot_index is_half_day low_quality true_range " + " ".join(FLAGS)


def _assembled(found):
    return tidy(
        found, *BAR, "is_half_day", "low_quality", "true_range", *FLAGS, *HOURLY_DOUBLES, exact="true_range"
    )


@query(select(HOURLY_CTES, "feat", FEATURE_PLAIN, " ".join(HOURLY_DOUBLES)))
def hourly_features(spark, sf):
    return _assembled(hourly_frame(spark, sf))


@query(
    select(
        chain(b.bars("supplier", "month"), b.market("month"), ASSEMBLED), "feat", FEATURE_PLAIN,
        " ".join(HOURLY_DOUBLES),
    )
)
def supplier_features(spark, sf):
    """The same table on suppliers by month, whose bars grow with the data."""
    return _assembled(hourly_frame(spark, sf, "supplier", "month"))


def stored_features(spark, sf):
    """The hourly feature table with prices, as the screens read it: written once, then scanned."""
    return b.stored(spark, sf, "hourly_features", lambda: hourly_frame(spark, sf))


def hourly_frame(spark, sf, security="nation", session="week"):
    """The feature table with prices."""
    both = ad.bars_with_sessions(spark, sf, security, session)
    return ft.hourly_features_of(both, *ad.market_bars(spark, sf, session), keep=("daily_atr", *ft.PRICES))


DAILY_ASSEMBLED = chain(
    b.market("day"), DAILY_ATR, LEVELS, b.BETA, DVOLUME,
    _progress_sql("aday", DAY_W, DAY_W, False),
    f"""dfeat AS (SELECT l.security_key, l.date, l.is_half_day, l.low_quality, l.true_range,
    CASE WHEN atr20 > 0 THEN true_range / atr20 END AS spread_atr,
    CASE WHEN true_range > 0 THEN abs(close - open) / true_range END AS body_frac,
    CASE WHEN true_range > 0 THEN (high - greatest(open, close)) / true_range END AS upper_wick_frac,
    CASE WHEN true_range > 0 THEN (least(open, close) - low) / true_range END AS lower_wick_frac,
    CASE WHEN high - low > 0 THEN (close - low) / (high - low) END AS close_loc,
    prg.* EXCLUDE (security_key, date), dvol.* EXCLUDE (security_key, date), beta_60, m AS market_ret_day,
    CASE WHEN atr20 > 0 THEN (close - pc - beta_60 * m * pc) / atr20 END AS resid_ret_atr,
    CAST(NULL AS DOUBLE) AS sector_resid_ret_atr, CAST(NULL AS DOUBLE) AS sector_ret_day,
    {', '.join(f'CASE WHEN atr20 > 0 THEN (close - {n}) / atr20 END AS dist_{n}' for n in st.LEVELS)},
    CASE WHEN atr20 > 0 THEN (close - round_even(close / 0.5, 0) * 0.5) / atr20 END AS dist_round_number
  FROM ctx l JOIN prg USING (security_key, date) JOIN dvol USING (security_key, date)
  JOIN beta USING (security_key, date) LEFT JOIN mret USING (date))""",
)
DAILY_CTES = chain(b.days("nation", "day"), DAILY_ASSEMBLED)
DAILY_DOUBLES = tuple(c for c in ft.DAILY if c not in ("true_range", "atr20_day"))


@query(
    select(DAILY_CTES, "dfeat", "security_key date is_half_day low_quality true_range", " ".join(DAILY_DOUBLES))
)
def daily_features(spark, sf):
    return _daily(spark, sf, "nation")


def _daily(spark, sf, security):
    _, market = ad.market_bars(spark, sf, "day")
    found = ft.daily_features(ad.day_bars(spark, sf, security, "day"), market, rows=ad.trade_count(spark, sf))
    return tidy(found, *DAY, "is_half_day", "low_quality", "true_range", *DAILY_DOUBLES, exact="true_range")


@query(
    select(
        chain(b.days("supplier", "day"), DAILY_ASSEMBLED), "dfeat",
        "security_key date is_half_day low_quality true_range", " ".join(DAILY_DOUBLES),
    )
)
def supplier_daily_features(spark, sf):
    """The same table on suppliers, whose bars grow with the data."""
    return _daily(spark, sf, "supplier")


LATE = dt.date(1997, 9, 3)


def _late_session(spark, sf):
    """Snapshots that were taken before LATE, and the bars stored by session: only those of
    the year, as nothing earlier may be needed. Returns the store and the benchmark."""
    root = f"{shared_folder(spark)}/late/{uuid.uuid4().hex}"
    days = cut_lineage(_days(spark, sf))
    _, market = ad.market_bars(spark, sf)
    market = cut_lineage(market)
    early = days.where(F.col("date") < F.lit(LATE))
    # A snapshot every 40 days, and none in the last ones before LATE.
    held = F.col("date").between(F.lit(dt.date(1997, 1, 1)), F.lit(dt.date(1997, 8, 15)))
    at = early.select("date").distinct().where((F.datediff("date", F.lit(LATE)) % 40 == 0) & held)
    store.write_sessions(days.where(F.col("date") >= F.lit(dt.date(1997, 1, 1))), root, "daily")
    carried.write_snapshots(carried.states(early, market), at, root)
    return root, market


@query(
    select(
        DAILY_CTES.replace("'day'", "'week'"), "dfeat", "security_key date is_half_day low_quality true_range", " ".join(DAILY_DOUBLES),
        tail=f"WHERE date >= DATE '{LATE}'",
    )
)
def late_daily_features(spark, sf):
    """Features of late sessions from a snapshot and the bars after it."""
    root, market = _late_session(spark, sf)
    found = carried.late_features(spark, root, market, LATE)
    return tidy(found, *DAY, "is_half_day", "low_quality", "true_range", *DAILY_DOUBLES, exact="true_range")


@query(
    select(
        chain(b.days("nation", "week"), DAILY_ATR, LEVELS, PIVOTS),
        "(SELECT date, security_key, ph AS pivot_high, CAST(php AS DOUBLE) AS set_pivot_high, pl AS pivot_low, CAST(plp AS DOUBLE) AS set_pivot_low, "
        "CAST(up AS INTEGER) * 1.0 AS way, ext AS extreme, CAST(place AS DOUBLE) AS place FROM ctx JOIN piv USING (security_key, pos))",
        "security_key date " + " ".join(pv.STATE), tail=f"WHERE date >= DATE '{LATE}'",
    )
)
def late_pivots(spark, sf):
    """The pivot search of late sessions gone on with from a snapshot."""
    root, market = _late_session(spark, sf)
    return carried.late_states(spark, root, market, LATE).select(*DAY, *pv.STATE)


@query(f"WITH {b.days('supplier', 'week')} SELECT DISTINCT security_key, security_key AS requested_ticker FROM days")
def security_directory(spark, sf):
    return ft.security_directory(ad.trades(spark, sf, "supplier", "week"))


@query(
    select(
        b.days("supplier", "week"), "days", "security_key date close volume",
        tail="WHERE security_key IN ('S1', 'S2', 'S3', 'S5', 'S8')",
    )
)
def one_batch(spark, sf):
    """Bars stored by security, and a batch of securities read back."""
    root = f"{shared_folder(spark)}/batches/{uuid.uuid4().hex}"
    store.write_by_security(_days(spark, sf, "supplier", "week"), root, "daily")
    found = store.read_batch(spark, root, "daily", ["S1", "S2", "S3", "S5", "S8"])
    return found.select(*DAY, "close", "volume")
