"""Trailing windows, ranks and the averaged range against plain Python."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from barscreen.functions import ranks
from barscreen.functions import trailing as tr
from barscreen.functions.orders import day_order
from barscreen.operators import volatility as vt
from barscreen.operators.pivots import pivot_states, volume_nodes

START = dt.date(2020, 1, 1)


def series(spark, values, valid=None):
    valid = valid or [True] * len(values)
    rows = [("A", START + dt.timedelta(days=i), v, ok) for i, (v, ok) in enumerate(zip(values, valid))]
    return spark.createDataFrame(rows, "security_key string, date date, v double, ok boolean")


def column(df, expression):
    rows = df.select("date", expression.alias("x")).orderBy("date").collect()
    return [r.x for r in rows]


def test_min_valid():
    assert [tr.min_valid(n) for n in (20, 60, 120)] == [14, 40, 80]


def test_percentile_excludes_current_and_invalid(spark):
    df = series(spark, [1.0, 2.0, 3.0, 9.0, 2.0, None], [True, True, True, False, True, True])
    found = column(df, tr.trailing_percentile(F.col("v"), F.col("ok"), day_order(), 3, need=2))
    # The fourth value is invalid: it is ranked, but never ranked against.
    assert found == [None, None, 100.0, 100.0, 0.0, None]


def test_percentile_is_strictly_below(spark):
    df = series(spark, [5.0, 5.0, 5.0, 5.0])
    assert column(df, tr.trailing_percentile(F.col("v"), F.col("ok"), day_order(), 3, need=3))[-1] == 0.0


def test_robust_z_and_median(spark):
    values = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    found = column(series(spark, values), tr.trailing_robust_z(F.col("v"), F.col("ok"), day_order(), 6, need=6))
    past = values[1:7]
    middle = statistics.median(past)
    mad = statistics.median(abs(v - middle) for v in past)
    assert found[:6] == [None] * 6
    assert found[7] == pytest.approx((6.0 - middle) / (1.4826 * mad))
    flat = column(series(spark, [2.0] * 8), tr.trailing_robust_z(F.col("v"), F.col("ok"), day_order(), 6, need=6))
    assert flat == [None] * 8


def test_full_windows_only(spark):
    df = series(spark, [1.0, None, 3.0, 2.0, 5.0, 4.0])
    assert column(df, tr.highest_before(F.col("v"), day_order(), 2)) == [None, None, None, None, 3.0, 5.0]
    assert column(df, tr.span_total(F.col("v"), day_order(), 2)) == [None, None, None, 5.0, 7.0, 9.0]


def wilder(ranges, period):
    out, seen, running = [], [], None
    for value in ranges:
        out.append(running)
        if value is None:
            continue
        seen.append(value)
        if len(seen) == period:
            running = sum(seen) / period
        elif len(seen) > period:
            running = (running * (period - 1) + value) / period
    return out


def test_wilder_atr_over_block_edges(spark, monkeypatch):
    # A block decays by (1 - 1/period)^BLOCK, which the real block size makes nothing of; with
    # period 2 sixty rows do the same.
    monkeypatch.setattr(vt, "BLOCK", 60)
    random.seed(3)
    ranges = [None if random.random() < 0.1 else random.uniform(0.1, 5.0) for _ in range(400)]
    df = series(spark, ranges).withColumnRenamed("v", "true_range")
    rows = vt.with_wilder_atr(df, ["date"], "atr", period=2).orderBy("date").collect()
    for mine, theirs in zip([r.atr for r in rows], wilder(ranges, 2)):
        assert (mine is None) == (theirs is None)
        assert mine is None or mine == pytest.approx(theirs, rel=1e-12)


def test_wilder_atr_long_history(spark):
    random.seed(4)
    ranges = [random.uniform(0.1, 5.0) for _ in range(3000)]
    df = series(spark, ranges).withColumnRenamed("v", "true_range")
    rows = vt.with_wilder_atr(df, ["date"], "atr").orderBy("date").collect()
    theirs = wilder(ranges, 20)
    assert all(r.atr == pytest.approx(t, rel=1e-12) for r, t in zip(rows, theirs) if t is not None)
    assert [r.atr for r in rows[:20]] == [None] * 20


def test_true_range_of_an_untraded_bar(spark):
    rows = [("A", START, 5.0, 4.0, 4.5), ("A", START + dt.timedelta(1), None, None, None),
            ("A", START + dt.timedelta(2), 9.0, 8.0, 8.5), ("A", START + dt.timedelta(3), 9.0, 8.8, 9.0)]
    df = spark.createDataFrame(rows, "security_key string, date date, high double, low double, close double")
    found = [r.true_range for r in vt.with_true_range(df, day_order()).orderBy("date").collect()]
    assert found == [1.0, None, 1.0, pytest.approx(0.5)]


def test_group_rank_is_exact_under_ties_and_skew(spark):
    random.seed(5)
    rows = []
    for i in range(6000):
        group = "hot" if random.random() < 0.7 else "cold"
        value = 1.0 if random.random() < 0.35 else random.choice([random.random(), float(random.randint(0, 9)), None])
        rows.append((group, f"K{i}", value))
    df = spark.createDataFrame(rows, "g string, k string, v double").repartition(7)
    found = {r.k: r.n for r in ranks.group_rank(df, ["g"], "v", "k", "n").collect()}
    for group in ("hot", "cold"):
        mine = [(v, hashlib.md5(k.encode()).hexdigest(), k) for g, k, v in rows if g == group and v is not None]
        for place, (_, _, k) in enumerate(sorted(mine), 1):
            assert found[k] == place
    assert all(found[k] is None for _, k, v in rows if v is None)


def test_pivots_hand_worked():
    high = np.array([10.0, 12.0, 11.0, 8.0, 9.0, 12.0])
    low = np.array([9.0, 11.0, 9.0, 6.0, 8.0, 10.0])
    found = pivot_states(high, low, np.full(6, 3.0))
    # The fall from 12 to 9 confirms the high of session 1; the rise from 6 to 9 the low of 3.
    assert np.isnan(found[1, :4]).all()
    assert found[2, 0] == 12.0 and found[2, 1] == 1
    assert np.isnan(found[3, 2])
    assert found[4, 2] == 6.0 and found[4, 3] == 3


def test_pivot_search_goes_on_from_any_session():
    random.seed(8)
    walk = np.cumsum([random.uniform(-2, 2) for _ in range(300)])
    high, low, need = walk + 1, walk - 1, np.full(300, 2.5)
    high[40:43] = low[40:43] = np.nan
    whole = pivot_states(high, low, need)
    for cut in (1, 41, 42, 150, 299):
        rest = pivot_states(high[cut:], low[cut:], need[cut:], tuple(whole[cut - 1]), cut)
        np.testing.assert_array_equal(rest, whole[cut:])


def node_by_hand(bars, days, sessions, bins):
    """{day: node} of one security, bin by bin."""
    out = {}
    for i, day in enumerate(days):
        window = days[max(0, i - sessions) : i]
        held = [r for r in bars if r[0] in window]
        if len(window) < sessions or {r[0] for r in held} != set(window):
            continue
        lows, highs = [r[3] for r in held if r[3] is not None], [r[2] for r in held if r[2] is not None]
        if not lows or not highs or not max(highs) > min(lows):
            continue
        lo, width = min(lows), (max(highs) - min(lows)) / bins
        filled = [0.0] * bins
        for _, _, _, _, close, volume in held:
            if close is not None and volume is not None:
                filled[int(min(max(math.floor((close - lo) / width), 0), bins - 1))] += volume
        if sum(filled) > 0:
            out[day] = lo + (filled.index(max(filled)) + 0.5) * width
    return out


def test_node_needs_every_session(spark):
    """Against a histogram by hand: gaps, untraded bars, flat prices, ties."""
    random.seed(2)
    bars, days = [], []
    for key, held in (("A", range(40)), ("B", [d for d in range(40) if d % 9]), ("C", range(30))):
        for d in range(40):
            days.append((key, START + dt.timedelta(d)))
            for slot in range(3 if d in held else 0):
                price = 5.0 if key == "C" else random.randint(1, 40) / 2
                known = random.random() > 0.2
                row = (price + 1.0, price - 1.0, price, float(random.randint(0, 3))) if known else (None, None, None, 0.0)
                bars.append((key, START + dt.timedelta(d), slot, *row))
    hourly = spark.createDataFrame(bars, "security_key string, date date, slot_index int, high double, low double, close double, volume double")
    daily = spark.createDataFrame(days, "security_key string, date date")
    found = {(r.security_key, r.date): r.node for r in volume_nodes(daily, hourly, sessions=4, bins=7).collect()}
    want = {}
    for key in "ABC":
        mine = [r[1:] for r in bars if r[0] == key]
        want |= {(key, d): n for d, n in node_by_hand(mine, sorted(d for k, d in days if k == key), 4, 7).items()}
    assert set(found) == set(want) and len(want) > 40
    assert all(found[k] == pytest.approx(want[k]) for k in want)

