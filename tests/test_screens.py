"""Thresholds one at a time, the budget, and matching and exits on hand-made rows."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from barscreen.operators import calendar as cal
from barscreen.operators import controls as ct
from barscreen.operators import exits as ex
from barscreen.operators import patterns as pt
from barscreen.operators import sampling as sp
from barscreen.operators import study as sd

DAY = dt.date(2024, 5, 6)
PASSING = {
    "security_key": "A", "requested_ticker": "A", "date": DAY, "slot_index": 3, "low_quality": False,
    "close": 100.0, "low": 99.0, "daily_atr": 2.0, "vol_pct_slot_60": 90.0, "spread_atr": 0.6, "ret_atr": -0.25,
    "resid_ret_atr": 0.25, "upper_wick_frac": 0.5, "close_loc": 0.35, "failed_new_high": True,
    "dist_high_20": -1.5, "dist_low_20": 9.0, "dist_prior_week_high": 9.0, "dist_prior_week_low": 9.0,
    "dist_prior_month_high": 9.0, "dist_nearest_pivot_high": 9.0, "repeat_hv_narrow_5": 2.0,
    "cum_vol_pct_5": 90.0, "progress_5": 0.5,
}
SCHEMA = ", ".join(
    f"{k} " + ("string" if isinstance(v, str) else "boolean" if isinstance(v, bool) else "int" if isinstance(v, int)
               else "date" if isinstance(v, dt.date) else "double")
    for k, v in PASSING.items()
)


def mark(spark, *changes):
    rows = [tuple({**PASSING, "security_key": f"A{i}", **c}.values()) for i, c in enumerate(changes)]
    marked = pt.candidates(spark.createDataFrame(rows, SCHEMA))
    return {r.security_key: r for r in marked.collect()}


@pytest.mark.parametrize("family, change", [
    ("family_a", {"vol_pct_slot_60": 89.9}), ("family_a", {"spread_atr": 0.61}), ("family_a", {"ret_atr": -0.26}),
    ("family_a", {"resid_ret_atr": None}), ("family_a", {"low_quality": True}), ("family_a", {"dist_high_20": -1.51}),
    ("family_b", {"vol_pct_slot_60": None}), ("family_b", {"upper_wick_frac": 0.49}), ("family_b", {"close_loc": 0.36}),
    ("family_b", {"failed_new_high": None}), ("family_b", {"failed_new_high": False}), ("family_b", {"low_quality": True}),
    ("family_b", {"dist_high_20": 0.6}),
])
def test_each_condition_alone_decides(spark, family, change):
    found = mark(spark, {}, change)
    assert found["A0"][family] is True
    assert found["A1"][family] is False


def test_b_accepts_a_level_reached_earlier(spark):
    # The session low is (100 - 99) / 2 = half an ATR below the close: it reached 0.5, not 0.6.
    found = mark(spark, {"dist_high_20": 0.5}, {"dist_high_20": 0.51})
    assert found["A0"].family_b is True and found["A1"].family_b is False


def test_c_directions(spark):
    up = {"dist_low_20": 0.2, "close_loc": 0.6}
    down = {"dist_high_20": -0.2, "close_loc": 0.4}
    found = mark(spark, up, down, {**up, "repeat_hv_narrow_5": 1.0}, {**up, "close_loc": 0.59})
    assert [found[f"A{i}"].family_c_up for i in range(4)] == [True, False, False, False]
    assert [found[f"A{i}"].family_c_down for i in range(4)] == [False, True, False, False]


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="spread_atr"):
        pt.candidates(spark.createDataFrame([tuple(PASSING.values())], SCHEMA).drop("spread_atr"))


def test_cap_breaks_ties_by_ticker_then_slot(spark):
    rows = [(DAY, t, s, 100.0, True) for t in "CAB" for s in (2, 1)]
    df = spark.createDataFrame(rows, "date date, requested_ticker string, slot_index int, vol_pct_slot_60 double, is_candidate boolean")
    kept = {(r.requested_ticker, r.slot_index) for r in pt.apply_cap(df, 3).collect()}
    assert kept == {("A", 1), ("A", 2), ("B", 1)}
    assert tuple(pt.cap_report(df, 3).first())[1:] == (6, 3, 3, True)


def test_event_note_and_mask(spark):
    df = spark.createDataFrame([(True, None), (False, None), (None, None), (False, False)], "ex_dividend boolean, half_day boolean")
    notes = [r[0] for r in df.select(pt.event_note(("ex_dividend", "half_day"))).collect()]
    assert notes == ["ex dividend", "no known event", "no known event", "no known event"]
    flag = F.col("ex_dividend")
    assert [tuple(r) for r in df.select(pt.unflagged(flag), pt.unflagged(flag, strict=False)).collect()] == [
        (False, False), (True, True), (False, True), (True, True)]


# --- matching ------------------------------------------------------------------


def brute_match(day, firing, want=5, reach=3):
    out = set()
    cells = {k: (a, v) for k, a, v, c in day}
    for key, slot in firing:
        a, v = cells[key]
        if a is None or v is None:
            continue
        for w in range(reach + 1):
            near = [k for k, x, y, c in day if not c and x is not None and y is not None
                    and abs(x - a) <= w and abs(y - v) <= w]
            if len(near) >= want:
                seed = f"{DAY}|{key}|{slot}"
                near.sort(key=lambda k: hashlib.sha1(f"{seed}|{k}".encode()).hexdigest())
                out |= {(key, slot, k, w) for k in near[:want]}
                break
    return out


@pytest.mark.parametrize("part", [20_000, 7])
def test_match_against_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(ct, "CELL_PART", part)  # 7: the crowded cell is cut into many parts
    random.seed(11)
    day = []
    for i in range(400):
        cell = (3, 4) if i % 3 == 0 else (random.randint(0, 9), random.randint(0, 9))
        day.append((f"K{i}", *(cell if i % 41 else (None, 2)), i % 17 == 0))
    firing = [(k, s) for k, _, _, c in day if c for s in (1, 5)]
    frame = spark.createDataFrame([(DAY, *r) for r in day], "date date, security_key string, atr_decile int, volume_decile int, is_candidate boolean")
    fired = spark.createDataFrame([(DAY, *r) for r in firing], "date date, security_key string, slot_index int")
    found = {(r.candidate_key, r.candidate_slot, r.control_key, r.widening) for r in ct.match(frame.repartition(5), fired).collect()}
    assert found == brute_match(day, firing)


def test_deciles_are_equal_sized(spark):
    rows = [(DAY, f"K{i}", float(i // 3)) for i in range(95)] + [(dt.date(2024, 5, 7), f"K{i}", 1.0) for i in range(9)]
    df = spark.createDataFrame(rows, "date date, security_key string, v double")
    found = ct.with_decile(df, "v", "d").groupBy("date", "d").count().collect()
    sizes = [r["count"] for r in found if r.date == DAY]
    assert len(sizes) == 10 and max(sizes) - min(sizes) <= 1
    assert [r.d for r in found if r.date != DAY] == [None]


# --- exits ------------------------------------------------------------------------


def walk(spark, bars, atr=2.0, sessions=12):
    """Signal at session 0; `bars`: (session, slot, open, high, low, close)."""
    dates = [DAY + dt.timedelta(days=i) for i in range(sessions)]
    calendar = cal.session_dimension(spark.createDataFrame([(d,) for d in dates], "date date"))
    rows = [("A", dates[s], slot, *map(float, p)) for s, slot, *p in bars]
    frame = spark.createDataFrame(rows, "security_key string, date date, slot_index int, open double, high double, low double, close double")
    signals = spark.createDataFrame([("A", DAY, atr)], "security_key string, date date, daily_atr double")
    return ex.walk(signals, frame, calendar).first()


def test_entry_is_the_next_open_and_stop_comes_first(spark):
    found = walk(spark, [(0, 0, 1, 1, 1, 1), (1, 0, 100, 101, 99, 100), (2, 0, 100, 107, 96, 100)])
    assert found.entry == 100.0
    assert (found.long_reason, found.long_r, found.long_sessions) == ("stop", -1.0, 2)
    assert (found.short_reason, found.short_r) == ("stop", -1.0)


def test_gap_fills_at_the_open(spark):
    found = walk(spark, [(1, 0, 100, 101, 99, 100), (2, 0, 110, 111, 109, 110)])
    assert (found.long_reason, found.long_move_atr) == ("target", 5.0)
    assert (found.short_reason, found.short_move_atr) == ("stop", -5.0)


def test_timeout_and_delisting(spark):
    flat = [(s, 0, 100, 101, 99, 100.5) for s in range(1, 12)]
    full = walk(spark, flat)
    assert (full.long_reason, full.long_sessions, full.long_move_atr) == ("timeout", 10, 0.25)
    assert full.move_10d_atr == 0.25
    short = walk(spark, flat[:4])
    assert (short.long_reason, short.long_sessions, short.move_5d_atr) == ("delisted", 4, None)


def test_no_entry_and_no_bars(spark):
    assert walk(spark, [(1, 0, 100, 101, 99, 100)], atr=None).long_reason == "no_entry"
    assert walk(spark, [(0, 0, 100, 101, 99, 100)]).long_reason is None


# --- statistics and sampling ----------------------------------------------------------


def test_clustered_difference_by_hand(spark):
    schema = "kind string, date date, security_key string, slot_index int, family_a boolean, family_b boolean, matched_candidate_key string, matched_candidate_slot int, move_5d_atr double"
    rows, gaps = [], [0.5, 1.5, 1.0]
    for i, gap in enumerate(gaps):
        day = DAY + dt.timedelta(days=i)
        rows.append(("candidate", day, "A", 1, True, False, None, -1, -(1.0 + gap)))
        rows.append(("candidate", day, "Z", 1, False, False, None, -1, 50.0))
        rows.append(("control", day, "C", -1, False, False, "A", 1, 1.0))
        rows.append(("control", day, "C", -1, False, False, "Z", 1, 90.0))
    rows.append(("candidate", DAY + dt.timedelta(days=9), "A", 1, True, False, None, -1, 3.0))
    found = sd.clustered_difference(spark.createDataFrame(rows, schema), ("family_a",)).first()
    error = 0.5 / math.sqrt(3)
    assert (found.dates, found.candidates, found.controls) == (3, 3, 3)
    assert found.edge == pytest.approx(1.0) and found.standard_error == pytest.approx(error)
    assert found.p == pytest.approx(math.erfc(1.0 / error / math.sqrt(2)))


def test_folds_leave_purge_gaps(spark):
    days = spark.createDataFrame([(DAY + dt.timedelta(days=i),) for i in range(481)], "date date")
    found = {r.fold: r["count"] for r in sd.with_fold(days, days).groupBy("fold").count().collect()}
    assert found == {0: 100, 1: 100, 2: 100, None: 181}


def test_draw_is_reproducible_and_weighted(spark):
    rows = [("S%d" % (i % 50), DAY + dt.timedelta(days=i // 50), i % 7, i % 10 == 0) for i in range(600)]
    df = spark.createDataFrame(rows, "security_key string, date date, slot_index int, is_candidate boolean")
    one = [tuple(r) for r in sp.draw(df, 10, "x").orderBy("place").collect()]
    two = [tuple(r) for r in sp.draw(df.repartition(9).orderBy(F.rand(1)), 10, "x").orderBy("place").collect()]
    assert one == two and len(one) == 10
    assert sum(r[3] == "candidate" for r in one) == 3
    assert {r[3]: r[4] for r in one} == {"candidate": 20.0, "population": pytest.approx(540 / 7)}
    assert [tuple(r) for r in sp.draw(df, 10, "y").orderBy("place").collect()] != one


def test_large_draw_is_the_sorted_head(spark):
    """Far beyond what Spark keeps a group and task: the lowest digests, all of them."""
    rows = spark.range(160_000).select(
        F.concat(F.lit("K"), F.col("id") % 977).alias("security_key"), F.lit("2024-01-02").cast("date").alias("date"),
        F.col("id").cast("int").alias("slot_index"), (F.col("id") % 4 == 0).alias("is_candidate"),
    )
    drawn = sp.draw(rows, 90_000, "s")
    marked = rows.where("NOT is_candidate").withColumn("d", sp.digest("s|population"))
    head = {r.slot_index for r in marked.orderBy("d", *sp.BAR).limit(60_000).select("slot_index").collect()}
    assert {r.slot_index for r in drawn.where("stratum = 'population'").select("slot_index").collect()} == head
    assert drawn.where("stratum = 'candidate'").count() == 30_000
    assert drawn.agg(F.count_distinct("place"), F.max("place")).first() == (90_000, 90_000)
