"""Matched controls, exit-rule outcomes, statistics on them, and label sampling.

The study runs on suppliers by week: a bar a supplier and week, so it grows with the data.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import functions as F

from barscreen.functions.orders import by_security, day_order
from barscreen.operators import controls as ct
from barscreen.operators import exits as ex
from barscreen.operators import sampling as sp
from barscreen.operators import study as sd
from barscreen.operators import universe as un
from barscreen.operators import volatility as vt
from barscreen.operators import volume as vl
from barscreen.plans import adapters as ad
from barscreen.plans import features as ft
from barscreen.plans.catalog import base as b
from barscreen.plans.catalog import features as cf
from barscreen.plans.catalog import screens as cs
from barscreen.plans.catalog import universe as cu
from barscreen.plans.catalog.base import chain, query, select, tidy

FAMILIES = ("family_a", "family_b")

#: The study's universe: the rules of the universe queries, with as many members as pass.
STUDY_RULES = dataclasses.replace(cu.RULES, top_n=400)
MEMBERS = f"""mem AS MATERIALIZED (SELECT w.date, k.ticker AS security_key, k.median_dollar_volume_60
  FROM (SELECT w2.date, max(r2.rebalance_date) AS r FROM weeks w2 JOIN (SELECT DISTINCT rebalance_date FROM failing WHERE failed_step IS NULL) r2 ON r2.rebalance_date <= w2.date GROUP BY 1) w
  JOIN (SELECT *, row_number() OVER (PARTITION BY rebalance_date ORDER BY median_dollar_volume_60 DESC, ticker) AS rank FROM failing WHERE failed_step IS NULL) k
    ON k.rebalance_date = w.r AND k.rank <= {STUDY_RULES.top_n})"""
DAY = chain(
    cu.RATED.split("picked AS")[0], MEMBERS, b.atr("days", "date", "aday", "s"), cf.DVOLUME,
    """sday AS MATERIALIZED (SELECT a.*, a.atr20 AS daily_atr, v.vol_pct_d_20,
    CASE WHEN atr20 > 0 THEN (close - pc) / atr20 END AS ret_atr
  FROM aday a JOIN dvol v USING (security_key, date)),
fired AS MATERIALIZED (SELECT *, coalesce(vol_pct_d_20 >= 90 AND ret_atr >= 0, false) AS family_a, coalesce(vol_pct_d_20 >= 90 AND ret_atr < 0, false) AS family_b FROM sday),
day AS MATERIALIZED (SELECT f.*, m.median_dollar_volume_60, family_a OR family_b AS is_candidate FROM fired f JOIN mem m USING (date, security_key)),
fire AS MATERIALIZED (SELECT d.*, CAST(s.slot AS INTEGER) AS slot FROM day d, (VALUES (0), (1)) s(slot) WHERE is_candidate AND (s.slot = 0 OR transactions % 2 = 0))""",
)


def _decile_sql(value: str, into: str) -> str:
    return f"""{into}_r AS (SELECT security_key, date, count(*) OVER (PARTITION BY date) AS n,
    row_number() OVER (PARTITION BY date ORDER BY {value}, md5(security_key), security_key) AS r FROM day WHERE {value} IS NOT NULL),
{into}_d AS (SELECT security_key, date, CASE WHEN n >= 10 THEN CAST(greatest((10 * (r - 1) + n - 2) // (n - 1) - 1, 0) AS INTEGER) END AS {into} FROM {into}_r)"""


DECILES = chain(
    DAY,
    _decile_sql("daily_atr / close", "atr_decile"),
    _decile_sql("median_dollar_volume_60", "volume_decile"),
    """dec AS MATERIALIZED (SELECT day.*, atr_decile, volume_decile FROM day LEFT JOIN atr_decile_d USING (security_key, date) LEFT JOIN volume_decile_d USING (security_key, date))""",
)
MATCHED = """near AS (SELECT c.date, c.security_key AS candidate_key, c.slot AS candidate_slot, e.security_key AS control_key,
    greatest(abs(c.atr_decile - e.atr_decile), abs(c.volume_decile - e.volume_decile)) AS w,
    sha1(CAST(c.date AS VARCHAR) || '|' || c.security_key || '|' || c.slot || '|' || e.security_key) AS digest
  FROM (SELECT dec.*, slot FROM dec JOIN (SELECT date, security_key, slot FROM fire) USING (date, security_key)) c JOIN dec e ON e.date = c.date AND c.is_candidate AND NOT e.is_candidate
    AND c.atr_decile IS NOT NULL AND c.volume_decile IS NOT NULL AND e.atr_decile IS NOT NULL AND e.volume_decile IS NOT NULL),
width AS (SELECT date, candidate_key, candidate_slot, CASE WHEN count(*) FILTER (w <= 0) >= 5 THEN 0 WHEN count(*) FILTER (w <= 1) >= 5 THEN 1
    WHEN count(*) FILTER (w <= 2) >= 5 THEN 2 WHEN count(*) FILTER (w <= 3) >= 5 THEN 3 END AS widening FROM near GROUP BY 1, 2, 3),
matched AS MATERIALIZED (SELECT date, candidate_key, candidate_slot, control_key, widening FROM (
  SELECT *, row_number() OVER (PARTITION BY date, candidate_key, candidate_slot ORDER BY digest) AS r FROM near JOIN width USING (date, candidate_key, candidate_slot) WHERE w <= widening) WHERE r <= 5)"""
MATCHED_CTES = chain(DECILES, MATCHED)


def study_members(spark, sf):
    """The members of the study's universe: at most 400 a month, whatever the data."""
    kept = ["rebalance_date", "ticker", "median_dollar_volume_60"]
    return b.stored(
        spark, sf, "study_members", lambda: un.select_universe(cu.rated(spark, sf), STUDY_RULES).select(*kept)
    )


def study_bars(spark, sf):
    """The whole history of every security that was ever a member. Nothing in the study looks at
    another, so they are left out before any window is opened."""

    def build():
        ever = study_members(spark, sf).select(F.col("ticker").alias("security_key")).distinct()
        return ad.day_bars(spark, sf, "supplier", "week").join(F.broadcast(ever), "security_key", "left_semi")

    return b.stored(spark, sf, "study_bars", build)


def _day_frame(spark, sf):
    days = by_security(study_bars(spark, sf))
    own = vl.daily_volume(vt.daily_volatility(days))
    before = F.lag("close").over(day_order())
    own = own.withColumns(
        {
            "daily_atr": F.col("atr20_day"),
            "ret_atr": F.when(F.col("atr20_day") > 0, (F.col("close") - before) / F.col("atr20_day")),
        }
    )
    busy = F.coalesce(F.col("vol_pct_d_20") >= 90, F.lit(False))
    # What is not kept is not worked out: the longer windows of volume are of no use here.
    own = own.select(
        "security_key", "requested_ticker", "date", "close", "transactions", "daily_atr", "vol_pct_d_20", "ret_atr"
    )
    members = un.members_in_force(cu.supplier_weeks(spark, sf), study_members(spark, sf), "ticker")
    return ct.among_members(own, members).withColumns(
        {
            "family_a": busy & F.coalesce(F.col("ret_atr") >= 0, F.lit(False)),
            "family_b": busy & F.coalesce(F.col("ret_atr") < 0, F.lit(False)),
        }
    ).withColumn("is_candidate", F.col("family_a") | F.col("family_b"))


def day_frame(spark, sf):
    """One row per supplier and week, as the matching reads it: stored, then scanned."""
    return b.stored(spark, sf, "study_days", lambda: _day_frame(spark, sf))


def with_deciles(spark, sf):
    return b.stored(spark, sf, "study_deciles", lambda: ct.attach_deciles(day_frame(spark, sf)))


def firing(spark, sf):
    """One or two bars of each candidate day: bars of one security draw their own controls."""
    slots = F.when(F.col("transactions") % 2 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return day_frame(spark, sf).where("is_candidate").withColumn("slot_index", F.explode(slots))


def matched(spark, sf):
    return b.stored(
        spark, sf, "study_matched", lambda: ct.match(with_deciles(spark, sf), firing(spark, sf))
    )


@query(select(DECILES, "dec", "security_key date is_candidate atr_decile volume_decile"))
def deciles(spark, sf):
    return with_deciles(spark, sf).select("security_key", "date", "is_candidate", "atr_decile", "volume_decile")


CELLS = "cells AS (SELECT date, atr_decile, volume_decile, count(*) AS eligible FROM dec WHERE NOT is_candidate AND atr_decile IS NOT NULL AND volume_decile IS NOT NULL GROUP BY ALL)"


@query(select(chain(DECILES, CELLS), "cells", "date atr_decile volume_decile eligible"))
def cell_sizes(spark, sf):
    return ct.cell_sizes(with_deciles(spark, sf))


@query(select(chain(DECILES, CELLS), "(SELECT date, CAST(sum(eligible) AS BIGINT) AS eligible, sum(eligible) / 100.0 AS per_cell, count(*) AS cells FROM cells GROUP BY 1)", "date eligible cells", "per_cell"))
def cell_occupancy(spark, sf):
    return tidy(ct.mean_cell_occupancy(ct.cell_sizes(with_deciles(spark, sf))))


@query(select(MATCHED_CTES, "matched", "date candidate_key candidate_slot control_key widening"))
def matched_controls(spark, sf):
    return ct.match(with_deciles(spark, sf), firing(spark, sf))


@query(
    f"""WITH RECURSIVE {MATCHED_CTES}, per AS (SELECT date, candidate_key, candidate_slot, count(*) AS n FROM matched GROUP BY ALL)
SELECT (SELECT count(*) FROM fire) AS candidates, (SELECT count(*) FROM per WHERE n >= 5) AS matched,
  (SELECT count(*) FROM fire) - (SELECT count(*) FROM per) AS unmatched, count(*) FILTER (widening = 0) AS exact,
  count(*) FILTER (widening > 0) AS widened, round(avg(widening), 6) + 0.0 AS mean_widening FROM matched"""
)
def match_summary(spark, sf):
    return tidy(ct.match_summary(matched(spark, sf), firing(spark, sf)))


# --- outcomes -------------------------------------------------------------------


def _walk_sql(signals: str, source: str, sessions: str) -> str:
    side = []
    for name, sign in ex.DIRECTIONS.items():
        stop, target = f"entry - {sign} * 1.5 * daily_atr", f"entry + {sign} * 3.0 * daily_atr"
        if sign > 0:
            hs, ht = f"low <= {stop}", f"high >= {target}"
            fs, ft_ = f"least(open, {stop})", f"greatest(open, {target})"
        else:
            hs, ht = f"high >= {stop}", f"low <= {target}"
            fs, ft_ = f"greatest(open, {stop})", f"least(open, {target})"
        side.append(
            f"coalesce({hs}, false) AS {name}_s, coalesce({hs} OR {ht}, false) AS {name}_h, "
            f"CASE WHEN coalesce({hs}, false) THEN {fs} ELSE {ft_} END AS {name}_f"
        )
    flags = ", ".join(side)
    firsts = ", ".join(
        f"arg_min({n}_f, ord) FILTER ({n}_h) AS {n}_f, arg_min(held, ord) FILTER ({n}_h) AS {n}_held, arg_min({n}_s, ord) FILTER ({n}_h) AS {n}_s"
        for n in ex.DIRECTIONS
    )
    closes = ", ".join(
        f"arg_max(close, ord) FILTER (held = {h} AND close IS NOT NULL) AS c{h}" for h in ex.HORIZONS
    )
    out = []
    for n, sign in ex.DIRECTIONS.items():
        move = f"CASE WHEN usable THEN {sign} * (CASE WHEN {n}_held IS NOT NULL THEN {n}_f ELSE last_close END - entry) END"
        out.append(
            f"""CASE WHEN n IS NULL THEN NULL WHEN NOT usable THEN 'no_entry' WHEN {n}_held IS NOT NULL AND {n}_s THEN 'stop' WHEN {n}_held IS NOT NULL THEN 'target' WHEN n >= 10 THEN 'timeout' ELSE 'delisted' END AS {n}_reason,
    ({move}) / (1.5 * daily_atr) AS {n}_r, ({move}) / daily_atr AS {n}_move_atr,
    CAST(CASE WHEN n IS NULL THEN NULL WHEN NOT usable THEN 0 ELSE coalesce({n}_held, n) END AS INTEGER) AS {n}_sessions"""
        )
    moves = ", ".join(
        f"CASE WHEN daily_atr > 0 THEN (c{h} - entry) / daily_atr END AS move_{h}d_atr" for h in ex.HORIZONS
    )
    return f"""fwd AS (SELECT g.security_key, g.date, g.daily_atr, h.open, h.high, h.low, h.close, hs.session_no * 100 + h.slot_index AS ord, hs.session_no AS s
  FROM {signals} g JOIN {sessions} gs ON gs.date = g.date JOIN {source} h ON h.security_key = g.security_key
  JOIN {sessions} hs ON hs.date = h.date AND hs.session_no BETWEEN gs.session_no + 1 AND gs.session_no + 10),
ent AS (SELECT *, first_value(open) OVER (PARTITION BY security_key, date ORDER BY ord) AS entry, dense_rank() OVER (PARTITION BY security_key, date ORDER BY s) AS held FROM fwd),
hit AS (SELECT *, entry IS NOT NULL AND coalesce(daily_atr > 0, false) AS usable, {flags} FROM ent),
agg2 AS (SELECT security_key, date, any_value(entry) AS entry, max(held) AS n,
    last(close ORDER BY ord) AS last_close, bool_or(usable) AS usable, {firsts}, {closes} FROM hit GROUP BY 1, 2),
walked AS MATERIALIZED (SELECT g.security_key, g.date, g.daily_atr, entry, {', '.join(out)}, {moves} FROM {signals} g LEFT JOIN agg2 USING (security_key, date))"""


WALK_PLAIN = "long_reason short_reason long_sessions short_sessions"
WALK_DOUBLES = "entry long_r long_move_atr short_r short_move_atr move_1d_atr move_3d_atr move_5d_atr move_10d_atr"
HOURLY_SIGNALS = chain(
    b.bars(), b.WEEKS, b.atr("days", "date", "aday", "x"),
    "sig AS (SELECT security_key, date, atr20 AS daily_atr FROM aday)", _walk_sql("sig", "bars", "weeks"),
)


@query(select(HOURLY_SIGNALS, "walked", f"security_key date entry {WALK_PLAIN}", WALK_DOUBLES.replace("entry ", "")))
def exit_walk(spark, sf):
    bars, days = ad.slot_bars(spark, sf), ad.day_bars(spark, sf)
    signals = ft.daily_atr(by_security(days)).select("security_key", "date", "daily_atr")
    found = ex.walk(signals, bars, ad.sessions_of(days))
    return tidy(found.drop("daily_atr"), exact="entry")


@query(
    select(
        HOURLY_SIGNALS, "(SELECT security_key, date, count(*) AS bars, count(DISTINCT s) AS sessions FROM fwd GROUP BY 1, 2)",
        "security_key date bars sessions",
    )
)
def forward_window(spark, sf):
    bars, days = ad.slot_bars(spark, sf), ad.day_bars(spark, sf)
    signals = days.select("security_key", "date", F.lit(1.0).alias("daily_atr"))
    found = ex.forward_window(signals, bars, ad.sessions_of(days))
    return found.groupBy("security_key", "date", "_at").agg(F.count(F.lit(1)).alias("n")).groupBy(
        "security_key", "date"
    ).agg(F.sum("n").alias("bars"), F.count(F.lit(1)).alias("sessions"))


OUTCOMES = chain(
    MATCHED_CTES,
    """sig AS (SELECT DISTINCT k.security_key, k.date, d.daily_atr FROM (SELECT security_key, date FROM day WHERE is_candidate UNION SELECT control_key, date FROM matched) k LEFT JOIN day d USING (security_key, date)),
sbars AS (SELECT *, 0 AS slot_index FROM days)""",
    _walk_sql("sig", "sbars", "weeks"),
    """evf AS (SELECT security_key, date, CASE WHEN CAST(volume AS BIGINT) % 7 <> 0 THEN transactions >= 3 END AS any_event FROM days),
outc AS MATERIALIZED (SELECT k.*, e.any_event, w.* EXCLUDE (security_key, date) FROM (
    SELECT 'candidate' AS kind, security_key, security_key AS requested_ticker, date, slot AS slot_index, family_a, family_b, CAST(NULL AS VARCHAR) AS matched_candidate_key, -1 AS matched_candidate_slot, -1 AS widening FROM fire
    UNION ALL SELECT 'control', control_key, NULL, date, -1, false, false, candidate_key, candidate_slot, widening FROM matched) k
  LEFT JOIN evf e USING (security_key, date) LEFT JOIN walked w USING (security_key, date))""",
)
OUT_PLAIN = f"kind security_key requested_ticker date slot_index family_a family_b matched_candidate_key matched_candidate_slot widening any_event entry {WALK_PLAIN}"


def _outcomes(spark, sf):
    days = study_bars(spark, sf)
    frame, pairs, fired = day_frame(spark, sf), matched(spark, sf), firing(spark, sf)
    signals = ex.distinct_signals(fired, pairs, frame)
    walked = ex.walk(signals, days.withColumn("slot_index", F.lit(0)), cu.supplier_weeks(spark, sf))
    flags = days.select(
        "security_key", "date",
        F.when(F.col("volume").cast("bigint") % 7 != 0, F.col("transactions") >= 3).alias("any_event"),
    )
    return ex.outcomes_table(fired, pairs, walked, flags)


def stored_outcomes(spark, sf):
    return b.stored(spark, sf, "study_outcomes", lambda: _outcomes(spark, sf))


@query(select(OUTCOMES, "outc", OUT_PLAIN, WALK_DOUBLES.replace("entry ", "")))
def outcomes(spark, sf):
    return tidy(_outcomes(spark, sf).drop("daily_atr"), exact="entry")


# --- statistics -----------------------------------------------------------------

PICKED = """studied AS (SELECT date, kind, move_5d_atr FROM outc WHERE kind = 'candidate' AND (family_a OR family_b)
  UNION ALL SELECT o.date, o.kind, o.move_5d_atr FROM outc o WHERE o.kind = 'control' AND EXISTS (SELECT 1 FROM outc c WHERE c.kind = 'candidate' AND (c.family_a OR c.family_b)
    AND c.date = o.date AND c.security_key = o.matched_candidate_key AND c.slot_index = o.matched_candidate_slot))"""


def _estimate(rows: str, into: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""{into}_day AS (SELECT {keys}date, count(move_5d_atr) FILTER (kind = 'candidate') AS candidates, count(move_5d_atr) FILTER (kind = 'control') AS controls,
    avg(abs(move_5d_atr)) FILTER (kind = 'candidate') AS candidate_mean, avg(abs(move_5d_atr)) FILTER (kind = 'control') AS control_mean FROM {rows} GROUP BY {keys}date),
{into} AS (SELECT *, edge / standard_error AS t FROM (SELECT {keys}count(*) AS dates, CAST(sum(candidates) AS BIGINT) AS candidates, CAST(sum(controls) AS BIGINT) AS controls, avg(candidate_mean) AS candidate_mean,
    avg(control_mean) AS control_mean, avg(candidate_mean - control_mean) AS edge, stddev_samp(candidate_mean - control_mean) / sqrt(count(*)) AS standard_error FROM {into}_day WHERE candidates > 0 AND controls > 0 {group}))"""


@query(select(chain(OUTCOMES, PICKED, _estimate("studied", "est")), "est", "dates candidates controls", "candidate_mean control_mean edge standard_error t"))
def clustered_difference(spark, sf):
    return tidy(sd.clustered_difference(stored_outcomes(spark, sf), FAMILIES).drop("p"))


@query(
    f"""WITH RECURSIVE {chain(OUTCOMES, PICKED, _estimate('studied', 'est'))}
SELECT round(t, 6) + 0.0 AS t, round(1 - 2 / sqrt(pi()) * (SELECT sum(pow(-1, n) * pow(abs(t) / sqrt(2), 2 * n + 1) / (gamma(n + 1) * (2 * n + 1)))
  FROM (SELECT unnest(range(81)) AS n)), 6) + 0.0 AS p FROM est"""
)
def clustered_p_value(spark, sf):
    """The two-sided p-value; the comparison sums the series of the error function."""
    return tidy(sd.clustered_difference(stored_outcomes(spark, sf), FAMILIES), "t", "p")


HOLDOUT = dt.date(2001, 1, 1)
FOLDED = f"""usable AS (SELECT date FROM weeks WHERE session_no >= 120 AND date < DATE '{HOLDOUT}'),
span AS (SELECT min(date) AS first, (date_diff('day', min(date), max(date)) - 180) // 3 AS len FROM usable),
folded AS (SELECT o.*, CASE WHEN date >= first AND (date_diff('day', first, date) // (len + 90)) < 3 AND date_diff('day', first, date) % (len + 90) < len
    THEN CAST(date_diff('day', first, date) // (len + 90) AS INTEGER) END AS fold FROM outc o, span WHERE date IN (SELECT date FROM usable))"""


@query(f"WITH RECURSIVE {chain(OUTCOMES, FOLDED)} SELECT fold, kind, count(*) AS n, min(date) AS first_date, max(date) AS last_date FROM folded GROUP BY ALL")
def walk_forward_folds(spark, sf):
    sessions = cu.supplier_weeks(spark, sf)
    rows, usable = sd.study_window(stored_outcomes(spark, sf), sessions, HOLDOUT)
    return sd.with_fold(rows, usable).groupBy("fold", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


@query(
    f"""WITH RECURSIVE {OUTCOMES} SELECT count(*) AS controls, count(*) FILTER (widening = 0) AS exact, count(*) FILTER (widening = 1) AS within_one,
  count(*) FILTER (widening >= 2) AS within_two_or_more, round(avg(widening), 6) + 0.0 AS mean_widening FROM outc WHERE kind = 'control'"""
)
def match_quality(spark, sf):
    return tidy(sd.match_quality(stored_outcomes(spark, sf)))


DEV = PICKED.replace("outc", "folded").replace("SELECT date, kind", "SELECT fold, date, kind").replace("SELECT o.date", "SELECT o.fold, o.date")
# p < 0.01 two-sided is |t| beyond this normal quantile.
SURE = "abs(t) > 2.575829303548901"


@query(
    f"""WITH RECURSIVE {chain(OUTCOMES, FOLDED, DEV, _estimate('studied', 'est'), _estimate('(SELECT * FROM studied WHERE fold IS NOT NULL)', 'fest', 'fold'))}
SELECT dates, candidates, controls, round(edge, 6) + 0.0 AS edge, round(t, 6) + 0.0 AS t, f.folds_effect, f.folds_whole, coalesce(edge >= 0.15, false) AS edge_ok, coalesce({SURE}, false) AS p_ok,
  f.folds_effect / 3.0 >= 2.0 / 3 AS folds_ok, coalesce(edge >= 0.15, false) AND coalesce({SURE}, false) AND f.folds_effect / 3.0 >= 2.0 / 3 AS earned
FROM est, (SELECT CAST(count(*) FILTER (edge >= 0.15) AS BIGINT) AS folds_effect, CAST(count(*) FILTER (edge >= 0.15 AND {SURE}) AS BIGINT) AS folds_whole FROM fest) f"""
)
def verdict(spark, sf):
    sessions = cu.supplier_weeks(spark, sf)
    found = sd.verdict(stored_outcomes(spark, sf), sessions, FAMILIES, HOLDOUT)
    return tidy(
        found, "dates", "candidates", "controls", "edge", "t", "folds_effect", "folds_whole",
        "edge_ok", "p_ok", "folds_ok", "earned",
    )


# --- label sampling ---------------------------------------------------------------


def _draw_sql(pool: str, count: int, seed: str) -> str:
    wanted = {"candidate": round(count / 3)}
    wanted["population"] = count - wanted["candidate"]
    parts = []
    for stratum, n in wanted.items():
        test = "is_candidate" if stratum == "candidate" else "NOT is_candidate"
        text = "security_key || '|' || CAST(date AS VARCHAR) || '|' || slot_index"
        parts.append(
            f"""SELECT security_key, date, slot_index, '{stratum}' AS stratum, size / least(size, {n}) AS weight, sha1('{seed}|order|' || {text}) AS o FROM (
      SELECT *, count(*) OVER () AS size, row_number() OVER (ORDER BY sha1('{seed}|{stratum}|' || {text})) AS r FROM {pool} WHERE {test}) WHERE r <= {n}"""
        )
    return f"drawn AS ({' UNION ALL '.join(parts)}), placed AS (SELECT *, CAST(row_number() OVER (ORDER BY o) AS INTEGER) AS place FROM drawn)"


@query(select(chain(cs.MARKED_CTES, _draw_sql("marked", 60, "2024-03-01")), "placed", "security_key date slot_index stratum place", "weight"))
def label_draw(spark, sf):
    return tidy(sp.draw(cs.marked(spark, sf), 60, "2024-03-01"))


SEEN = "seen AS (SELECT security_key, date, slot_index FROM marked WHERE volume > 60)"
POOL = """usable AS (SELECT date, row_number() OVER (ORDER BY session_no) - 1 AS p, count(*) OVER () AS n FROM weeks WHERE session_no >= 120),
spaced AS (SELECT date, row_number() OVER (ORDER BY date DESC) AS back FROM usable WHERE p % greatest(n // 40, 1) = 0),
pool AS (SELECT m.* FROM marked m JOIN spaced USING (date) LEFT JOIN seen s USING (security_key, date, slot_index) WHERE back <= 40 AND s.security_key IS NULL)"""


@query(select(chain(cs.MARKED_CTES, b.WEEKS, SEEN, POOL, _draw_sql("pool", 10, "2024-04-01")), "placed", "security_key date slot_index stratum place", "weight"))
def label_session(spark, sf):
    rows = cs.marked(spark, sf)
    sessions = ad.sessions_of(ad.day_bars(spark, sf))
    return tidy(sp.plan_session(rows, sessions, rows.where(F.col("volume") > 60), 10, "2024-04-01"))


LABELS = """lab AS (SELECT lang AS security_key, DATE '2024-01-01' + CAST(doc_id % 60 AS INTEGER) AS date, CAST(doc_id % 997 AS INTEGER) AS slot_index, source AS stratum,
    DATE '2024-01-01' + CAST(doc_id % 60 AS INTEGER) AS shown_on, toxic = 1 AND doc_id % 3 = 0 AS is_retest, CASE WHEN quality = 1 THEN 'interesting' ELSE 'not_interesting' END AS response,
    CASE WHEN doc_id % 5 = 0 THEN ' ' WHEN doc_id % 5 = 1 THEN 'seen' END AS note, ['', 'flag', 'wedge', 'base'][CAST(doc_id % 4 + 1 AS INTEGER)] AS pattern_guess,
    TIMESTAMP '2024-01-01' + to_seconds(doc_id * 4 + n_chars % 4) AS answered_at, doc_id FROM labels JOIN documents USING (doc_id))"""


def label_rows(spark, sf):
    docs = ad.table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    k = F.col("doc_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (k % 60).cast("int"))
    guess = F.array(*map(F.lit, ("", "flag", "wedge", "base")))
    stamp = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        secs=(k * 4 + F.col("n_chars") % 4).cast("decimal(18,6)")
    )
    return ad.table(spark, sf, "labels").join(docs, "doc_id").select(
        F.col("lang").alias("security_key"), day.alias("date"), (k % 997).cast("int").alias("slot_index"),
        F.col("source").alias("stratum"), day.alias("shown_on"),
        ((F.col("toxic") == 1) & (k % 3 == 0)).alias("is_retest"),
        F.when(F.col("quality") == 1, "interesting").otherwise("not_interesting").alias("response"),
        F.when(k % 5 == 0, " ").when(k % 5 == 1, "seen").alias("note"),
        F.get(guess, (k % 4).cast("int")).alias("pattern_guess"), stamp.alias("answered_at"), "doc_id",
    )


RETEST = """ripe AS (SELECT *, row_number() OVER (ORDER BY sha1('2024-03-01|retest|' || security_key || '|' || CAST(date AS VARCHAR) || '|' || slot_index), security_key, date, slot_index) AS r
  FROM lab WHERE shown_on <= DATE '2024-03-01' - 28 AND NOT is_retest)"""


@query(select(chain(LABELS, RETEST), "ripe", "doc_id security_key date slot_index", tail="WHERE r <= round_even((SELECT count(*) FROM lab) * 0.1, 0)"))
def label_retest(spark, sf):
    due = sp.due_for_retest(label_rows(spark, sf), dt.date(2024, 3, 1), "2024-03-01", ("doc_id",))
    return due.select("doc_id", "security_key", "date", "slot_index")


@query(
    f"""WITH {LABELS} SELECT count(*) AS labels, greatest(300 - count(*), 0) AS still_to_do, count(*) FILTER (response = 'interesting') AS interesting,
  count(*) FILTER (response = 'not_interesting') AS not_interesting, round(count(*) FILTER (response = 'interesting') / count(*), 6) + 0.0 AS rate,
  count(*) FILTER (response = 'interesting') / count(*) BETWEEN 0.08 AND 0.6 AS rate_in_range, count(*) FILTER (trim(coalesce(note, '')) <> '') AS notes, count(*) FILTER (is_retest) AS planned_retests FROM lab"""
)
def label_summary(spark, sf):
    return tidy(sp.label_summary(label_rows(spark, sf)))


@query(
    f"""WITH {LABELS}, t AS (SELECT *, CASE WHEN lag(response) OVER w = response THEN 0 ELSE 1 END AS turned FROM lab WINDOW w AS (PARTITION BY security_key, stratum ORDER BY answered_at)),
i AS (SELECT *, sum(turned) OVER (PARTITION BY security_key, stratum ORDER BY answered_at) AS island FROM t), r AS (SELECT security_key, stratum, island, count(*) AS n FROM i GROUP BY ALL)
SELECT security_key, stratum, max(n) AS longest_run FROM r GROUP BY 1, 2"""
)
def label_runs(spark, sf):
    return sp.longest_run(label_rows(spark, sf), per=("security_key", "stratum"))


@query(
    f"""WITH {LABELS}, g AS (SELECT security_key, date_diff('second', lag(answered_at) OVER w, answered_at) AS gap FROM lab WINDOW w AS (PARTITION BY security_key ORDER BY answered_at)),
k AS (SELECT security_key, list_sort(list(gap)) AS a, count(*) FILTER (gap < 3) AS quick FROM g WHERE gap < 600 GROUP BY 1)
SELECT security_key, len(a) AS gaps, a[len(a) // 2 + 1] AS typical_seconds, quick, quick > len(a) * 0.2 AS too_quick FROM k"""
)
def label_pace(spark, sf):
    return sp.label_pace(label_rows(spark, sf), per=("security_key",))


@query(f"WITH {LABELS} SELECT pattern_guess, count(*) AS labels FROM lab WHERE pattern_guess <> '' GROUP BY 1")
def label_guesses(spark, sf):
    return sp.pattern_guesses(label_rows(spark, sf))


@query(
    f"""WITH {LABELS}, p AS (SELECT security_key, date, slot_index, count(*) AS n, count(*) FILTER (is_retest) AS planned FROM lab GROUP BY 1, 2, 3)
SELECT count(*) FILTER (n > 1) AS repeated, CAST(sum(planned) AS BIGINT) AS planned, count(*) FILTER (n > 1) > 0 AND count(*) FILTER (n > 1) > sum(planned) AS unplanned FROM p"""
)
def label_repeats(spark, sf):
    return sp.repeated_charts(label_rows(spark, sf))


@query(
    f"""WITH {LABELS} SELECT stratum, count(*) FILTER (response = 'interesting') AS hits, count(*) AS labels, round(count(*) FILTER (response = 'interesting') / count(*), 6) + 0.0 AS rate
FROM lab WHERE (SELECT count(*) FROM lab) >= 300 GROUP BY 1"""
)
def stratum_rates(spark, sf):
    return tidy(sp.stratum_rates(label_rows(spark, sf)))
