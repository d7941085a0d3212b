"""Rules of the reference that the comparison SQL alone would not catch, and plans that must hold."""

from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from barscreen.functions.ranks import first_by_digest, top_rows
from barscreen.operators import adjust
from barscreen.operators import calendar as cal
from barscreen.operators import controls as ct
from barscreen.operators import exits as ex
from barscreen.operators import identity as idn
from barscreen.operators import intervals as iv
from barscreen.operators import patterns as pt
from barscreen.operators import sampling as sp
from barscreen.operators import study as sd
from barscreen.operators import universe as un
from barscreen.plans.catalog import QUERIES
from barscreen.session import shared_folder

D = dt.date


def calendar(spark, start, n):
    days = [start + dt.timedelta(days=i) for i in range(2 * n)]
    days = [d for d in days if d.weekday() < 5][:n]
    return cal.session_dimension(spark.createDataFrame([(d,) for d in days], "date date"))


def test_a_cluster_must_name_the_shared_folder():
    conf = SimpleNamespace(get=lambda key, default: default)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master)))


def test_sessions_ending_refuses(spark):
    known = calendar(spark, D(2024, 1, 1), 10)
    assert cal.sessions_ending(known, D(2024, 1, 5), 3).count() == 3
    with pytest.raises(Exception, match="is no session"):
        cal.sessions_ending(known, D(2024, 1, 6), 3).collect()
    with pytest.raises(Exception, match="fewer than 6"):
        cal.sessions_ending(known, D(2024, 1, 5), 6).collect()


def test_slots_follow_daylight_saving(spark):
    days = [(D(2024, 3, 8),), (D(2024, 3, 11),), (D(2024, 11, 1),), (D(2024, 11, 4),)]
    slots = cal.session_slots(cal.session_dimension(spark.createDataFrame(days, "date date")))
    opens = {r.date: r.slot_start_utc.hour for r in slots.where("slot_index = 0").collect()}
    assert opens == {D(2024, 3, 8): 14, D(2024, 3, 11): 13, D(2024, 11, 1): 13, D(2024, 11, 4): 14}


def test_previous_session_beyond_the_calendar(spark):
    known = calendar(spark, D(2024, 1, 1), 5)
    days = spark.createDataFrame([(D(2023, 12, 31),), (D(2024, 1, 1),), (D(2024, 1, 3),), (D(2024, 2, 1),)], "date date")
    found = {r.date: r.previous_session for r in cal.with_previous_session(days, known).collect()}
    assert found == {D(2023, 12, 31): None, D(2024, 1, 1): None, D(2024, 1, 3): D(2024, 1, 2), D(2024, 2, 1): D(2024, 1, 5)}


def test_only_members_in_force_are_ranked(spark):
    """Ten members and a stranger whose volume would come first; volume is the snapshot's."""
    snapshots = spark.createDataFrame(
        [(D(2024, 1, 2), f"S{i}", float(i)) for i in range(10)] + [(D(2024, 2, 1), f"S{i}", 100.0 - i) for i in range(10)],
        "rebalance_date date, security_key string, median_dollar_volume_60 double",
    )
    days = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 31),), (D(2024, 2, 1),)], "date date")
    members = un.members_in_force(days, snapshots)
    rows = [(d, f"S{i}", 1.0 + i, 10.0, 5.0, False) for d in (D(2024, 1, 1), D(2024, 1, 31), D(2024, 2, 1)) for i in range(11)]
    day = spark.createDataFrame(rows, "date date, security_key string, daily_atr double, close double, median_dollar_volume_60 double, is_candidate boolean")
    found = {(r.date, r.security_key): r.volume_decile for r in ct.attach_deciles(ct.among_members(day, members)).collect()}
    assert len(found) == 20 and not any(k[1] == "S10" or k[0] == D(2024, 1, 1) for k in found)
    assert found[D(2024, 1, 31), "S9"] == 9 and found[D(2024, 2, 1), "S9"] == 0


def test_verdict_starts_after_the_warm_up(spark):
    """Before the warm-up candidates move ten times as much: none of it may count."""
    known = calendar(spark, D(2024, 1, 1), 60)
    rows = []
    for r in known.collect():
        size = 10.0 if r.session_no < 20 else 1.0
        rows.append(("candidate", r.date, "A", 0, True, None, None, size + r.session_no % 3 / 10))
        rows.append(("control", r.date, "B", -1, False, "A", 0, 0.5))
    schema = "kind string, date date, security_key string, slot_index int, family_a boolean, matched_candidate_key string, matched_candidate_slot int, move_5d_atr double"
    found = sd.verdict(spark.createDataFrame(rows, schema), known, ("family_a",), D(2025, 1, 1), warmup=20).first()
    assert found.dates == 40 and found.edge == pytest.approx(0.6, abs=0.01)


def test_exits_with_many_slots_a_session(spark):
    """A stop in slot 150 comes before a target in the next session's slot 0."""
    known = calendar(spark, D(2024, 1, 1), 4)
    days = [r.date for r in known.orderBy("date").collect()]
    rows = [("A", days[1], i, 100.0, 100.5, 80.0 if i == 150 else 99.5, 100.0) for i in range(200)]
    rows += [("A", days[2], i, 100.0, 200.0 if i == 0 else 100.5, 99.5, 100.0) for i in range(200)]
    bars = spark.createDataFrame(rows, "security_key string, date date, slot_index int, open double, high double, low double, close double")
    signal = spark.createDataFrame([("A", days[0], 2.0)], "security_key string, date date, daily_atr double")
    found = ex.walk(signal, bars, known).first()
    assert (found.long_reason, found.long_sessions) == ("stop", 1)


def test_every_condition_explains_a_candidate(spark):
    """A bar is of a family exactly if all its rows but those of single levels pass."""
    base = {
        "security_key": "A", "date": D(2024, 1, 2), "slot_index": 0, "close": 10.0, "low": 9.9, "low_quality": False, "vol_pct_slot_60": 95.0,
        "spread_atr": 0.5, "ret_atr": 0.1, "resid_ret_atr": 0.1, "upper_wick_frac": 0.6, "close_loc": 0.2, "failed_new_high": True, "daily_atr": 1.0,
        **{level: 0.5 for level in {*pt.A_LEVELS, *pt.B_LEVELS}},
    }
    changed = [{}, {"failed_new_high": False}, {"low_quality": True}, {"vol_pct_slot_60": None}, {"spread_atr": 0.7}, {"close_loc": 0.9}]
    rows = [{**base, **c, "security_key": str(i)} for i, c in enumerate(changed)]
    rows.append({**base, "security_key": "tested", **{level: -0.5 for level in pt.B_LEVELS}})
    df = spark.createDataFrame(rows)
    marked = {r.security_key: (r.family_a, r.family_b) for r in pt.candidates(df).collect()}
    said = {}
    for r in pt.explain_conditions(df).collect():
        if r.condition not in {*pt.A_LEVELS, *pt.B_LEVELS}:
            said.setdefault(r.security_key, {}).setdefault(r.family, []).append(r.passed)
    assert {k: (all(v["A"]), all(v["B"])) for k, v in said.items()} == marked
    assert marked["tested"] == (True, True) and marked["0"] == (True, False) and marked["2"] == (False, False)


def test_runs_and_pace_across_pieces(spark):
    """Answers half an hour apart, some of them across the edges of pieces."""
    start = dt.datetime(2024, 1, 1)
    answers = "AABBBBBBBAAAAB"
    rows = [("x", a, start + dt.timedelta(minutes=29 * i)) for i, a in enumerate(answers)]
    rows += [("y", "A", start + dt.timedelta(seconds=3598 + 2 * i)) for i in range(5)]
    labels = spark.createDataFrame(rows, "who string, response string, answered_at timestamp_ntz")
    assert {r.who: r.longest_run for r in sp.longest_run(labels, per=("who",)).collect()} == {"x": 7, "y": 5}
    pace = {r.who: (r.gaps, r.typical_seconds, r.quick) for r in sp.label_pace(labels, per=("who",)).collect()}
    assert pace == {"y": (4, 2, 4)}
    assert sp.longest_run(labels.where("who = 'x'")).first().longest_run == 7


def test_first_by_digest_is_the_sorted_head(spark):
    rows = spark.range(3000).withColumn("_o", F.sha1(F.col("id").cast("string")))
    want = {r.id for r in rows.orderBy("_o").limit(700).collect()}
    found = first_by_digest(rows.drop("_o"), F.sha1(F.col("id").cast("string")), ["id"], spark.range(1).select(F.lit(700)))
    assert {r.id for r in found.collect()} == want
    with pytest.raises(ValueError, match="windowGroupLimitThreshold"):
        top_rows(rows, ["id"], [F.col("_o")], 5000)


def test_renames_are_joined_up_in_their_month(spark):
    known = calendar(spark, D(2024, 1, 1), 70)
    days = [r.date for r in known.orderBy("session_no").collect()]
    bars = [("NEW" if i >= 30 else "OLD", d, 10.0, 100.0) for i, d in enumerate(days)] + [("ALL", d, 10.0, 100.0) for d in days]
    bars += [("BOTH", d, 10.0, 100.0) for d in days[20:]] + [("WAS", d, 10.0, 100.0) for d in days[:25]]
    df = spark.createDataFrame(bars, "ticker string, date date, close double, volume double")
    listed = spark.createDataFrame([("NEW",), ("ALL",), ("BOTH",)], "ticker string")
    held = spark.createDataFrame(
        [("NEW", "OLD", D(2023, 1, 1), days[29], "ok"), ("BOTH", "WAS", D(2023, 1, 1), None, "ok"), ("NEW", "NEW", days[30], None, "ok")],
        "ticker_now string, ticker_then string, start date, end date, status string",
    )
    rebalances = spark.createDataFrame([(days[45], 44)], "rebalance_date date, as_of_no int")
    stitched, log = idn.stitched_windows(df, rebalances, known, listed, held, 40, 500.0)
    assert {(r.ticker_now, r.ticker_then, r.bars, r.outcome) for r in log.collect()} == {("NEW", "OLD", 25, "stitched"), ("BOTH", "WAS", 20, "clash")}
    counts = {r.ticker: r["count"] for r in stitched.groupBy("ticker").count().collect()}
    assert counts == {"NEW": 40, "ALL": 40, "BOTH": 25, "WAS": 20}


@pytest.mark.parametrize("name", ["reacting_sessions", "macro_flags", "earnings_flags", "event_table", "filing_coverage"])
def test_days_are_looked_up_by_equality(spark, small, name):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_interval_join_meets_only_its_own_year(spark):
    """One ticker has a third of the bars and a split a month for 30 years."""
    months = [D(1995 + i // 12, 1 + i % 12, 15) for i in range(360)]
    splits = spark.createDataFrame(
        [("HOT", m, 1.0, 2.0 if i % 2 else 0.5) for i, m in enumerate(months)] + [("B", D(2001, 3, 4), 1.0, 4.0)],
        "ticker string, execution_date date, split_from double, split_to double",
    )
    first = D(1985, 1, 3)
    bars = [("HOT", first + dt.timedelta(days=8 * i)) for i in range(2000)]
    bars += [(t, first + dt.timedelta(days=16 * i)) for t in "BC" for i in range(1000)]
    bars += [("HOT", D(2070, 1, 1)), ("HOT", None), (None, D(2000, 1, 1)), ("HOT", D(1999, 3, 15)), ("HOT", D(1999, 3, 15))]
    df = spark.createDataFrame([(t, d, 8.0, 8.0) for t, d in bars], "ticker string, date date, close double, volume double")
    spans = adjust.split_intervals(splits, D(2024, 12, 31))
    cut = iv.by_year(spans, "valid_from", "valid_to", "y")
    assert cut.count() <= spans.count() + 60 * 2
    # What the year leaves of a bar's spans: those of its own year, not the ticker's 360.
    per_year = cut.groupBy("ticker", "y").count().agg(F.max("count")).first()[0]
    assert per_year <= 13
    pairs = df.withColumn("y", F.greatest(F.lit(1990), F.least(F.lit(2050), F.year("date")))).join(cut, ["ticker", "y"]).count()
    assert pairs <= 13 * len(bars)
    known = [(r.ticker, r.execution_date, r.split_from / r.split_to) for r in splits.collect()]
    want = []
    for t, d in bars:
        factor = 1.0
        for ticker, day, ratio in known:
            factor *= ratio if t == ticker and d is not None and d < day else 1.0
        want.append((str(t), str(d), 8.0 * factor, 8.0 / factor))
    got = [(str(r.ticker), str(r.date), r.close, r.volume) for r in adjust.split_adjust(df, splits, D(2024, 12, 31)).collect()]
    assert sorted(got) == sorted(want)


def test_interval_join_of_overlapping_open_and_empty_spans(spark):
    rows = spark.createDataFrame([("A", D(1999, 12, 31), 1), ("A", D(2000, 1, 1), 2), ("Z", D(2000, 1, 1), 3)], "k string, d date, _year int")
    spans = spark.createDataFrame(
        [("A", None, D(1999, 12, 31), "to"), ("A", D(2000, 1, 1), None, "from"), ("A", D(1999, 12, 31), D(2000, 1, 1), "over"),
         ("A", D(2000, 1, 1), D(1999, 12, 31), "none")],
        "kk string, a date, b date, name string",
    )
    met = lambda how, closed: sorted(
        (r._year, str(r.name)) for r in iv.interval_join(rows, spans, ("k", "kk"), "d", "a", "b", how, closed).collect()
    )
    assert met("inner", True) == [(1, "over"), (1, "to"), (2, "from"), (2, "over")]
    assert met("left", False) == [(1, "over"), (2, "from"), (3, "None")]
