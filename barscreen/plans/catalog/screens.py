"""Pattern screens, the daily budget, reports on both, and chart histories.

The limits are looser than the defaults because the derived bars are sparse.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from barscreen.operators import patterns as pt
from barscreen.operators import sampling as sp
from barscreen.plans import adapters as ad
from barscreen.plans.catalog import base as b
from barscreen.plans.catalog.base import chain, query, select, tidy
from barscreen.plans.catalog.features import BAR, HOURLY_CTES, stored_features

LIMITS = {
    **pt.LIMITS,
    "min_vol_pct": 60, "a_max_spread_atr": 2.0, "a_max_ret_atr": 1.0, "a_max_resid_ret_atr": 1.0,
    "b_min_upper_wick_frac": 0.2, "b_max_close_loc": 0.8, "c_min_repeat": 0,
    "c_min_cum_vol_pct": 30, "c_max_progress_atr": 1.5, "c_location_atr": 3.0,
    "c_up_min_close_loc": 0.3, "c_down_max_close_loc": 0.7,
}
CAP = 8


def _nearest(levels) -> str:
    return f"least({', '.join(f'abs({n})' for n in levels)})"


def _tested(levels, limit) -> str:
    return " OR ".join(
        f"(coalesce(abs({n}) <= {limit}, false) AND (coalesce({n} <= 0, false) OR coalesce(drop_atr >= {n}, false)))"
        for n in levels
    )


L = LIMITS
SHAPE_B = (
    f"coalesce(vol_pct_slot_60 >= {L['min_vol_pct']} AND upper_wick_frac >= {L['b_min_upper_wick_frac']} "
    f"AND close_loc <= {L['b_max_close_loc']} AND failed_new_high AND NOT low_quality, false)"
)
STRETCH = (
    f"repeat_hv_narrow_5 >= {L['c_min_repeat']} AND cum_vol_pct_5 >= {L['c_min_cum_vol_pct']} "
    f"AND abs(progress_5) <= {L['c_max_progress_atr']} AND vol_pct_slot_60 >= {L['min_vol_pct']} AND NOT low_quality"
)
LOW, HIGH = _nearest(pt.C_LOW_LEVELS), _nearest(pt.C_HIGH_LEVELS)
MARKED = f"""low AS (SELECT *, CASE WHEN daily_atr > 0 THEN (close - min(low) OVER (PARTITION BY security_key, date ORDER BY slot_index {b.SO_FAR})) / daily_atr END AS drop_atr FROM feat),
marked AS (SELECT *, family_a OR family_b AS is_candidate FROM (SELECT *,
    coalesce(vol_pct_slot_60 >= {L['min_vol_pct']} AND spread_atr <= {L['a_max_spread_atr']} AND abs(ret_atr) <= {L['a_max_ret_atr']}
      AND abs(resid_ret_atr) <= {L['a_max_resid_ret_atr']} AND NOT low_quality AND {_nearest(pt.A_LEVELS)} <= {L['a_location_atr']}, false) AS family_a,
    {SHAPE_B} AND ({_tested(pt.B_LEVELS, L['b_location_atr'])}) AS family_b,
    coalesce({STRETCH} AND {LOW} <= {L['c_location_atr']} AND {LOW} <= {HIGH} AND close_loc >= {L['c_up_min_close_loc']}, false) AS family_c_up,
    coalesce({STRETCH} AND {HIGH} <= {L['c_location_atr']} AND {HIGH} <= {LOW} AND close_loc <= {L['c_down_max_close_loc']}, false) AS family_c_down
  FROM low))"""
MARKED_CTES = chain(HOURLY_CTES, MARKED)
FAMILIES = "family_a family_b is_candidate family_c_up family_c_down"


def marked(spark, sf):
    return pt.candidates(stored_features(spark, sf), LIMITS)


@query(select(MARKED_CTES, "marked", f"security_key date slot_index {FAMILIES}"))
def candidates(spark, sf):
    return marked(spark, sf).select(*BAR, *FAMILIES.split())


def _condition(family: str, name: str, value: str, sense: str, limit) -> str:
    return (
        f"SELECT security_key, date, slot_index, '{family}' AS family, '{name}' AS condition, "
        f"round({value}, 6) + 0.0 AS value, CAST({limit} AS DOUBLE) AS threshold, "
        f"coalesce({value} {sense} {limit}, false) AS passed FROM feat"
    )


def _touch(n: str) -> str:
    return f"CASE WHEN {n} <= 0 OR drop_atr >= {n} THEN abs({n}) END"


def _levels():
    for family, levels, limit in (("A", pt.A_LEVELS, "a_location_atr"), ("B", pt.B_LEVELS, "b_location_atr")):
        for n in levels:
            near = f"abs({n})" if family == "A" else _touch(n)
            yield _condition(family, n, n, "<=", L[limit]).replace(f"coalesce({n} <=", f"coalesce({near} <=")


@query(
    f"WITH RECURSIVE {MARKED_CTES} "
    + " UNION ALL ".join(
        [
            _condition(*c)
            for c in (
                ("A", "vol_pct_slot_60", "vol_pct_slot_60", ">=", L["min_vol_pct"]),
                ("A", "spread_atr", "spread_atr", "<=", L["a_max_spread_atr"]),
                ("A", "abs_ret_atr", "abs(ret_atr)", "<=", L["a_max_ret_atr"]),
                ("A", "abs_resid_ret_atr", "abs(resid_ret_atr)", "<=", L["a_max_resid_ret_atr"]),
                ("A", "low_quality", "CAST(low_quality AS DOUBLE)", "<=", 0),
                ("A", "nearest_level", _nearest(pt.A_LEVELS), "<=", L["a_location_atr"]),
                ("B", "vol_pct_slot_60", "vol_pct_slot_60", ">=", L["min_vol_pct"]),
                ("B", "upper_wick_frac", "upper_wick_frac", ">=", L["b_min_upper_wick_frac"]),
                ("B", "close_loc", "close_loc", "<=", L["b_max_close_loc"]),
                ("B", "failed_new_high", "CAST(failed_new_high AS DOUBLE)", ">=", 1),
                ("B", "low_quality", "CAST(low_quality AS DOUBLE)", "<=", 0),
                ("B", "tested_level", f"least({', '.join(map(_touch, pt.B_LEVELS))})", "<=", L["b_location_atr"]),
            )
        ]
        + list(_levels())
    ).replace("FROM feat", "FROM low")
)
def condition_report(spark, sf):
    return tidy(pt.explain_conditions(stored_features(spark, sf), LIMITS))


DIRECTIONAL = ", ".join(f"CASE WHEN {n} <= 0 THEN abs({n}) END" for n in pt.B_LEVELS)


@query(
    f"""WITH RECURSIVE {MARKED_CTES}
SELECT count(*) FILTER ({SHAPE_B} AND {_nearest(pt.B_LEVELS)} <= 2.0) AS proximity,
  count(*) FILTER ({SHAPE_B} AND ({_tested(pt.B_LEVELS, 2.0)})) AS tested,
  count(*) FILTER ({SHAPE_B} AND {_nearest(pt.B_LEVELS)} <= 2.0 AND least({DIRECTIONAL}) <= 2.0) AS directional
FROM marked"""
)
def location_readings(spark, sf):
    return pt.location_readings(stored_features(spark, sf), LIMITS)


CAPPED = f"""capped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY date
    ORDER BY vol_pct_slot_60 DESC NULLS LAST, security_key, slot_index) AS place FROM marked WHERE is_candidate) WHERE place <= {CAP})"""


@query(select(chain(MARKED_CTES, CAPPED), "capped", "security_key date slot_index family_a family_b", "vol_pct_slot_60 spread_atr close_loc"))
def capped_candidates(spark, sf):
    return tidy(
        pt.apply_cap(marked(spark, sf), CAP), *BAR, "family_a", "family_b", "vol_pct_slot_60",
        "spread_atr", "close_loc",
    )


@query(
    f"""WITH RECURSIVE {MARKED_CTES}, n AS (SELECT date, count(*) FILTER (is_candidate) AS candidates FROM marked GROUP BY date)
SELECT date, candidates, least(candidates, {CAP}) AS kept, candidates - least(candidates, {CAP}) AS dropped, candidates > {CAP} AS capped FROM n"""
)
def cap_report(spark, sf):
    return pt.cap_report(marked(spark, sf), CAP)


SUMMARY = """summary AS (SELECT date, count(*) AS bars, count(*) FILTER (family_a) AS family_a, count(*) FILTER (family_b) AS family_b,
    count(*) FILTER (family_a AND family_b) AS "both", count(*) FILTER (is_candidate) AS candidates,
    count(DISTINCT CASE WHEN is_candidate THEN security_key END) AS securities FROM marked GROUP BY date)"""
SUMMARY_CTES = chain(MARKED_CTES, SUMMARY)


@query(select(SUMMARY_CTES, "summary", 'date bars family_a family_b "both" candidates securities'))
def candidate_summary(spark, sf):
    return pt.summarise(marked(spark, sf))


@query(
    f"WITH RECURSIVE {SUMMARY_CTES} "
    + " UNION ALL ".join(
        f"""SELECT '{m}' AS measure, round(avg("{m}"), 6) + 0.0 AS mean, median("{m}") + 0.0 AS median,
  round(quantile_cont("{m}", 0.9), 6) + 0.0 AS p90, max("{m}") AS max, count(*) AS sessions,
  count(*) FILTER (candidates > {CAP}) AS capped_sessions, CAST(sum(greatest(candidates - {CAP}, 0)) AS BIGINT) AS dropped,
  count(*) FILTER (candidates = 0) AS empty_sessions FROM summary"""
        for m in ("family_a", "family_b", "both", "candidates", "securities")
    )
)
def yield_distribution(spark, sf):
    return tidy(pt.yield_distribution(pt.summarise(marked(spark, sf)), CAP))


@query(select(SUMMARY_CTES, "summary", "date candidates securities", tail="ORDER BY candidates DESC, date LIMIT 5"))
def busiest_sessions(spark, sf):
    return pt.busiest_sessions(pt.summarise(marked(spark, sf))).select("date", "candidates", "securities")


# --- events on screen days ------------------------------------------------------
# Flags for the derived weeks: an order total above a bound, an urgent order, an open order.

NOTES = """wflags AS (SELECT n_name AS security_key, CAST(date_trunc('week', o_orderdate) AS DATE) AS date,
    CASE WHEN count(*) > 1 THEN max(o_totalprice) > 400000 END AS big_order, bool_or(o_orderpriority = '1-URGENT') AS urgent,
    bool_or(o_orderstatus = 'O') AS open_order
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
wnotes AS (SELECT *, big_order OR urgent OR open_order AS any_event,
    coalesce(nullif(concat_ws(', ', CASE WHEN big_order THEN 'big order' END, CASE WHEN urgent THEN 'urgent' END, CASE WHEN open_order THEN 'open order' END), ''), 'no known event') AS events
  FROM wflags)"""
NOTE_FLAGS = ("big_order", "urgent", "open_order")


def week_flags(spark, sf):
    orders = ad.table(spark, sf, "orders")
    customer = ad.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = ad.table(spark, sf, "nation").select("n_nationkey", "n_name")
    named = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    week = F.date_trunc("week", "o_orderdate").cast("date")
    flags = named.groupBy(F.col("n_name").alias("security_key"), week.alias("date")).agg(
        F.when(F.count(F.lit(1)) > 1, F.max("o_totalprice") > 400000).alias("big_order"),
        F.max(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        F.max(F.col("o_orderstatus") == "O").alias("open_order"),
    )
    either = F.col("big_order") | F.col("urgent") | F.col("open_order")
    return flags.withColumn("any_event", either).withColumn("events", pt.event_note(NOTE_FLAGS))


@query(
    select(
        chain(MARKED_CTES, NOTES),
        """(SELECT m.security_key, m.date, m.slot_index, CASE WHEN family_c_up THEN 'C-up' ELSE 'C-down' END AS direction, events
           FROM marked m LEFT JOIN wnotes USING (security_key, date) WHERE family_c_up OR family_c_down)""",
        "security_key date slot_index direction events",
    )
)
def pattern_scan(spark, sf):
    notes = week_flags(spark, sf).select("security_key", "date", "events")
    return pt.scan(marked(spark, sf), notes).select(*BAR, "direction", "events")


@query(
    f"""WITH {NOTES} SELECT security_key, date, any_event, coalesce(NOT any_event, false) AS usable_strict,
  coalesce(NOT any_event, true) AS usable_lenient, events FROM wnotes"""
)
def validation_mask(spark, sf):
    return week_flags(spark, sf).select(
        "security_key", "date", "any_event",
        pt.unflagged(F.col("any_event")).alias("usable_strict"),
        pt.unflagged(F.col("any_event"), strict=False).alias("usable_lenient"), "events",
    )


# --- chart histories --------------------------------------------------------------

JUDGED = "judged AS (SELECT security_key, date, CAST(max(slot_index) AS INTEGER) AS judged_slot FROM bars WHERE NOT low_quality GROUP BY 1, 2)"


def _judged(bars):
    return bars.where(~F.col("low_quality")).groupBy("security_key", "date").agg(F.max("slot_index").alias("judged_slot"))


@query(
    select(
        chain(b.bars(), b.WEEKS, JUDGED),
        """(SELECT j.security_key, j.date AS judged_date, judged_slot, h.date, h.slot_index, h.close, h.volume,
             row_number() OVER (PARTITION BY j.security_key, j.date ORDER BY h.date DESC, h.slot_index DESC) AS r
           FROM judged j JOIN weeks jw ON jw.date = j.date JOIN bars h ON h.security_key = j.security_key
           JOIN weeks hw ON hw.date = h.date AND hw.session_no BETWEEN jw.session_no - 10 AND jw.session_no
           WHERE h.date < j.date OR h.slot_index <= judged_slot)""",
        "security_key judged_date judged_slot date slot_index close volume",
        tail="WHERE r <= 60",
    )
)
def chart_history(spark, sf):
    bars = ad.slot_bars(spark, sf)
    found = sp.chart_history(bars, _judged(bars), ad.sessions_of(ad.day_bars(spark, sf)))
    return found.select("security_key", "judged_date", "judged_slot", "date", "slot_index", "close", "volume")


@query(
    select(
        chain(b.bars(), b.WEEKS, JUDGED),
        """(SELECT j.security_key, j.date AS judged_date, judged_slot, d.date, d.open, d.high, d.low, d.close, d.volume
            FROM judged j JOIN weeks jw ON jw.date = j.date JOIN days d ON d.security_key = j.security_key
            JOIN weeks dw ON dw.date = d.date AND dw.session_no BETWEEN jw.session_no - 60 AND jw.session_no - 1
            UNION ALL
            SELECT j.security_key, j.date, judged_slot, j.date, max(open) FILTER (slot_index = 0), max(high), min(low),
              max(close) FILTER (slot_index = judged_slot), sum(volume)
            FROM judged j JOIN bars h ON h.security_key = j.security_key AND h.date = j.date AND h.slot_index <= judged_slot
            GROUP BY 1, 2, 3, 4)""",
        "security_key judged_date judged_slot date open high low close volume",
    )
)
def daily_history(spark, sf):
    bars, days = ad.slot_bars(spark, sf), ad.day_bars(spark, sf)
    return sp.daily_history(days, bars, _judged(bars), ad.sessions_of(days))
