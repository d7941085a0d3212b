"""Flags at their edges, split adjustment, stored tables and the incremental rebuild."""

from __future__ import annotations

import datetime as dt
import glob
import hashlib
import os
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from barscreen.operators import adjust
from barscreen.operators import bars as bo
from barscreen.operators import calendar as cal
from barscreen.operators import flags as fl
from barscreen.operators import pivots as pv
from barscreen.plans import features as ft
from barscreen.schema import nan_to_null
from barscreen.sources import pages, store
from barscreen.streaming import carried, incremental

D = dt.date


def sessions(spark, days, half=()):
    return cal.session_dimension(spark.createDataFrame([(d, d in half) for d in days], "date date, is_half_day boolean"))


WEEK = [D(2025, 11, d) for d in (24, 25, 26, 28)] + [D(2025, 12, 1)]


def reacted(spark, day, minute):
    rows = spark.createDataFrame([(day, minute)], "date date, minute_et int")
    return fl.reacting_session(rows, sessions(spark, WEEK, {D(2025, 11, 28)}), "date", "minute_et").first().reacted_on


@pytest.mark.parametrize("day, minute, expected", [
    (D(2025, 11, 25), 959, D(2025, 11, 25)), (D(2025, 11, 25), 960, D(2025, 11, 26)), (D(2025, 11, 25), None, D(2025, 11, 25)),
    (D(2025, 11, 28), 779, D(2025, 11, 28)), (D(2025, 11, 28), 780, D(2025, 12, 1)), (D(2025, 11, 27), 600, D(2025, 11, 28)),
    (D(2025, 11, 30), 1000, D(2025, 12, 1)), (D(2025, 11, 23), 600, None), (D(2025, 11, 23), 1000, None),
    (D(2025, 11, 24), 1000, D(2025, 11, 25)), (D(2025, 12, 1), 1000, None),
])
def test_reacting_session(spark, day, minute, expected):
    assert reacted(spark, day, minute) == expected


def test_calendar_flags(spark):
    found = {r.date: r for r in fl.calendar_flags(sessions(spark, WEEK, {D(2025, 11, 28)})).collect()}
    assert found[D(2025, 11, 28)].half_day and found[D(2025, 11, 28)].month_end
    assert found[D(2025, 11, 28)].day_after_holiday and found[D(2025, 12, 1)].day_after_holiday is False
    assert found[D(2025, 11, 24)].day_after_holiday is None and found[D(2025, 12, 1)].quarter_end is None


def test_third_friday(spark):
    rows = spark.createDataFrame([(D(2024, 3, 1),), (D(2025, 8, 1),), (D(2024, 6, 1),)], "m date")
    assert [r[0] for r in rows.select(fl.third_friday(F.col("m"))).collect()] == [D(2024, 3, 15), D(2025, 8, 15), D(2024, 6, 21)]


def test_earnings_flag_has_three_states(spark):
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(300)]
    traded = sessions(spark, days).select(F.lit("A").alias("security_key"), "date", "session_no")
    told = spark.createDataFrame([("A", 100)], "security_key string, session_no int")
    found = {r.session_no: r.earnings for r in fl.earnings_flags(traded, told).collect()}
    assert [found[i] for i in (98, 99, 100, 101, 102)] == [False, True, True, True, False]
    assert found[226] is False and found[227] is None


def test_any_event_is_unknown_before_false(spark):
    rows = spark.createDataFrame([(True, None), (False, None), (False, False)], "a boolean, b boolean")
    assert [r[0] for r in rows.select(fl.any_event(("a", "b"))).collect()] == [True, None, False]


def test_unknown_macro_kind_is_an_error(spark):
    odd = spark.createDataFrame([(WEEK[0], "gdp", 510)], "date date, kind string, minute_et int")
    with pytest.raises(Exception, match="unknown macro kind"):
        fl.macro_flags(sessions(spark, WEEK), odd).collect()


def test_slots_of_a_normal_and_a_half_day(spark):
    found = cal.session_slots(sessions(spark, WEEK, {D(2025, 11, 28)})).collect()
    normal = [r.slot_minutes for r in found if r.date == D(2025, 11, 26)]
    half = [r.slot_minutes for r in found if r.date == D(2025, 11, 28)]
    assert sorted(normal) == [30, 60, 60, 60, 60, 60, 60] and sorted(half) == [30, 60, 60, 60]


def test_splits_apply_only_once_known(spark):
    bars = spark.createDataFrame([("A", D(2024, 1, d), 100.0, 10.0) for d in (1, 5, 9)], "ticker string, date date, close double, volume double")
    splits = spark.createDataFrame([("A", D(2024, 1, 5), 1.0, 2.0), ("A", D(2024, 1, 8), 1.0, 4.0)], "ticker string, execution_date date, split_from double, split_to double")

    def closes(as_of):
        return [r.close for r in adjust.split_adjust(bars, splits, as_of).orderBy("date").collect()]

    assert closes(D(2024, 1, 4)) == [100.0, 100.0, 100.0]
    assert closes(D(2024, 1, 5)) == [50.0, 100.0, 100.0]
    assert closes(D(2024, 1, 9)) == [12.5, 25.0, 100.0]
    with pytest.raises(Exception, match="not positive"):
        adjust.split_adjust(bars, splits.withColumn("split_to", F.lit(0.0)), D(2024, 1, 9)).collect()


def test_nan_becomes_null(spark):
    assert nan_to_null(spark.createDataFrame([(float("nan"),)], "x double")).first().x is None


def test_bars_of_a_hot_security(spark):
    """A third of all minutes in one security: same bars, whatever the partitions."""
    day = D(2025, 11, 26)
    start = dt.datetime(2025, 11, 26, 14, 30)
    rows = []
    for key, n in (("HOT", 390), ("X", 40), ("Y", 1)):
        for i in range(n):
            rows.append((key, key, key, start + dt.timedelta(minutes=i), 50.0 + i, 51.0 + i, 49.0 + i, 50.5 + i, 2.0, 1))
    rows.append(("PRE", "PRE", "PRE", start - dt.timedelta(minutes=30), 1.0, 1.0, 1.0, 1.0, 1.0, 1))
    schema = "security_key string, requested_ticker string, ticker string, timestamp_utc timestamp_ntz, open double, high double, low double, close double, volume double, transactions bigint"
    slotted = bo.with_slot(spark.createDataFrame(rows, schema).repartition(6), sessions(spark, [day]))
    parts = bo.session_parts(slotted, ("is_half_day", "open_utc", "slots"))
    hourly = {(r.security_key, r.slot_index): r for r in bo.hourly_bars(parts).collect()}
    daily = {r.security_key: r for r in bo.daily_bars(parts).collect()}
    assert len(hourly) == 28
    hot = hourly["HOT", 1]
    assert (hot.open, hot.high, hot.low, hot.close, hot.volume, hot.minutes_with_trades) == (110.0, 170.0, 109.0, 169.5, 120.0, 60)
    assert hourly["HOT", 6].minutes_with_trades == 30 and hourly["X", 1].close is None
    assert hourly["Y", 0].low_quality and not hourly["X", 0].low_quality
    assert daily["PRE"].close is None and daily["PRE"].volume == 0.0 and daily["HOT"].close == 439.5


def test_manifest_audit_sees_changes(spark, tmp_path):
    parts, manifests = f"{tmp_path}/parts", f"{tmp_path}/manifests"
    spark.range(100).repartition(3).write.parquet(parts)
    store.write_manifests(spark, parts, manifests, "r1")
    spark.range(5).coalesce(1).write.mode("append").parquet(parts)
    assert store.read_complete_parts(spark, parts, manifests).count() == 100
    states = [r.state for r in store.audit_manifests(spark, parts, manifests).collect()]
    assert sorted(states) == ["ok", "ok", "ok", "orphan"]
    known = {os.path.basename(r.file) for r in store.read_manifests(spark, manifests).collect()}
    files = [f for f in glob.glob(f"{parts}/part-*.parquet") if os.path.basename(f) in known]
    os.replace(files[0], files[1])
    # The local file system keeps its own checksum beside each file; it moves along.
    side = [os.path.join(parts, f".{os.path.basename(f)}.crc") for f in files[:2]]
    os.replace(side[0], side[1])
    again = [r.state for r in store.audit_manifests(spark, parts, manifests).collect()]
    assert sorted(again) == ["absent", "changed", "ok", "orphan"]
    with pytest.raises(Exception, match="a (listed part is absent|part has changed)"):
        store.read_complete_parts(spark, parts, manifests).collect()


def test_audit_reads_bytes_and_paths(spark, tmp_path):
    """A flipped byte of a footer, a part without rows, one name in two folders, parts too large
    to be taken whole."""
    made, parts, manifests = str(tmp_path / "made"), tmp_path / "parts", str(tmp_path / "manifests")
    spark.range(100).withColumn("gone", F.lit(None).cast("string")).coalesce(1).write.parquet(made)
    (source,) = glob.glob(f"{made}/part-*.parquet")
    body = open(source, "rb").read()
    spark.range(0).withColumn("gone", F.lit(None).cast("string")).write.parquet(str(tmp_path / "none"))
    (empty,) = glob.glob(f"{tmp_path}/none/part-*.parquet")
    for folder, name, content in (("a", "x", body), ("b", "x", body), ("b", "e", open(empty, "rb").read())):
        (parts / folder).mkdir(parents=True, exist_ok=True)
        (parts / folder / f"{name}.parquet").write_bytes(content)
    store.write_manifests(spark, str(parts), manifests, "r1")
    listed = {"/".join(r.file.split("/")[-2:]): (r.rows, r.digest) for r in store.read_manifests(spark, manifests).collect()}
    assert {k: v[0] for k, v in listed.items()} == {"a/x.parquet": 100, "b/x.parquet": 100, "b/e.parquet": 0}
    assert listed["a/x.parquet"][1] == hashlib.sha256(body).hexdigest()
    at = body.rindex(b"parquet-mr")  # the writer's name in the footer
    (parts / "b" / "x.parquet").write_bytes(body[:at] + b"P" + body[at + 1 :])
    states = {"/".join(r.file.split("/")[-2:]): r.state for r in store.audit_manifests(spark, str(parts), manifests).collect()}
    assert states == {"a/x.parquet": "ok", "b/x.parquet": "changed", "b/e.parquet": "ok"}
    by_rows = {"/".join(r.file.split("/")[-2:]): r for r in store.checksums(spark, str(parts), whole=800).collect()}
    assert by_rows["a/x.parquet"].digest == by_rows["b/x.parquet"].digest != listed["a/x.parquet"][1]


def test_batch_opens_its_buckets_only(spark, tmp_path):
    rows = spark.range(5000).select(F.concat(F.lit("S"), F.col("id") % 200).alias("security_key"), F.col("id").alias("v"))
    store.write_by_security(rows, str(tmp_path), "daily", 16)
    keys = ["S3", "S77", "absent"]
    batch = store.read_batch(spark, str(tmp_path), "daily", keys, 16)
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "PushedFilters: [In(security_key, [S3,S77,absent])]" in plan
    files = batch.withColumn("f", F.input_file_name()).select("f").distinct().count()
    assert files <= 3 < len(glob.glob(f"{tmp_path}/daily/bucket=*/*.parquet"))
    assert {r.v % 200 for r in batch.collect()} == {3, 77} and batch.count() == 50


def test_parts_may_have_any_name(spark, tmp_path):
    parts, manifests = f"{tmp_path}/parts", f"{tmp_path}/manifests"
    spark.range(10).coalesce(1).write.parquet(parts)
    (name,) = glob.glob(f"{parts}/part-*.parquet")
    os.replace(name, f"{parts}/minutes.parquet")
    store.write_manifests(spark, parts, manifests, "r1")
    assert store.read_complete_parts(spark, parts, manifests).count() == 10


def test_snapshot_is_written_once(spark, tmp_path):
    root = str(tmp_path / "u")
    month = lambda day, n: spark.range(n).withColumn("rebalance_date", F.lit(day).cast("date"))
    store.write_snapshots(month("2024-01-02", 3), root)
    store.write_snapshots(month("2024-02-01", 2), root)
    with pytest.raises(ValueError, match="written once"):
        store.write_snapshots(month("2024-01-02", 4).unionAll(month("2024-03-01", 1)), root)
    assert spark.read.parquet(root).count() == 5
    store.write_snapshots(month("2024-03-01", 1), root)  # the refused job left no claim
    # Two jobs at once: one wins, nothing is doubled.
    def attempt(_):
        try:
            store.write_snapshots(month("2024-04-01", 7), root)
        except ValueError:
            return 0
        return 1

    with ThreadPoolExecutor(4) as pool:
        assert sum(pool.map(attempt, range(4))) == 1
    assert spark.read.parquet(root).count() == 13
    broken = month("2024-05-01", 2).withColumn("id", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        store.write_snapshots(broken, root)
    store.write_snapshots(month("2024-05-01", 2), root)
    store.set_aside(spark, root, "2024-01-02", "run7")
    kept = spark.read.parquet(f"{root}_superseded/run_id=run7/rebalance_date=2024-01-02")
    assert kept.count() == 3


def test_late_files_rebuild_their_session_only(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "bars")
    schema = "date date, k string, v double"

    def land(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").partitionBy("date").parquet(raw)

    def run():
        build = lambda df: df.groupBy("date", "k").agg(F.sum("v").alias("v"))
        incremental.rebuild_on_arrival(spark, raw, schema, build, root, "daily", str(tmp_path / "check"))
        return {(r.date.day, r.k): r.v for r in spark.read.parquet(f"{root}/daily").collect()}

    land((D(2024, 1, 1), "A", 1.0), (D(2024, 1, 2), "A", 2.0))
    assert run() == {(1, "A"): 1.0, (2, "A"): 2.0}
    land((D(2024, 1, 2), "A", 5.0), (D(2024, 1, 3), "B", 1.0))
    assert run() == {(1, "A"): 1.0, (2, "A"): 7.0, (3, "B"): 1.0}
    batch = spark.createDataFrame([(D(2024, 1, 2), "A", 5.0)], schema)
    plan = spark.read.schema(schema).parquet(raw).join(incremental.sessions_of(batch), "date", "left_semi")
    assert "dynamicpruning" in plan._jdf.queryExecution().executedPlan().toString()


def test_release_names_must_match_in_full(spark):
    def row(day, clock, name):
        return f"<tr><td>{day}</td><td>{clock}</td><td>{name}</td></tr>"

    html = "".join([
        row("Friday, January 04, 2019", "08:30 AM", "Employment <b>Situation</b> for December 2018"),
        row("Friday, January 04, 2019", "10:00 AM", "Employment Situation of Veterans for Annual 2018"),
        row("no date", "08:30 AM", "Consumer Price Index for May 2019"),
    ])
    found = pages.statistics_releases(spark.createDataFrame([(html,)], "html string")).collect()
    assert [tuple(r) for r in found] == [(D(2019, 1, 4), "08:30", "payrolls")]


def _walk(spark, seed=7):
    """Daily bars of four securities: one trades every session, one rarely, one has untraded bars
    and one begins late."""
    rng = random.Random(seed)
    rows, market = [], []
    for i in range(420):
        day = D(2022, 1, 3) + dt.timedelta(i // 5 * 7 + i % 5)
        market.append((day, 100 + rng.random() * 3))
        for key in ("A", "B", "C", "D"):
            if (key == "B" and i % 3) or (key == "D" and i < 330):
                continue
            close = 20 + rng.random() * 6
            known = not (key == "C" and i % 4 == 1)
            prices = (close - 0.3, close + rng.random(), close - 0.7, close) if known else (None,) * 4
            stamp = dt.datetime.combine(day, dt.time(9, 30))
            rows.append((key, key, day, stamp, False, *prices, float(rng.randint(0, 900)), not known))
    schema = "security_key string, requested_ticker string, date date, timestamp_utc timestamp, is_half_day boolean, open double, high double, low double, close double, volume double, low_quality boolean"
    return spark.createDataFrame(rows, schema), spark.createDataFrame(market, "date date, close double")


def test_late_sessions_equal_the_whole_rebuild(spark, tmp_path):
    """From a snapshot and the bars after it, over two generations of snapshots, row by row."""
    bars, market = _walk(spark)
    root = str(tmp_path)
    day, taken = D(2023, 5, 10), D(2023, 4, 28)
    at = lambda *days: spark.createDataFrame([(d,) for d in days], "date date")
    store.write_sessions(bars, root, "daily")
    before = bars.where(F.col("date") <= F.lit(D(2023, 2, 3)))
    carried.write_snapshots(carried.states(before, market), at(D(2022, 12, 30), D(2023, 2, 3)), root)
    # The next snapshot follows from the one before.
    carried.refresh(spark, root, market, D(2023, 2, 6), at(D(2022, 6, 3), taken))
    assert {r.date for r in spark.read.parquet(f"{root}/states").select("date").distinct().collect()} == {D(2022, 12, 30), D(2023, 2, 3), taken}

    keep = ("close", "ranges_seen", "range_value")
    found = carried.late_features(spark, root, market, day, keep)
    whole = ft.daily_features(bars, market, keep=keep).where(F.col("date") >= F.lit(day))
    ordered = lambda df: df.orderBy("security_key", "date").collect()
    mine, theirs = ordered(found), ordered(whole)
    assert len(mine) == len(theirs) > 100
    for a, b in zip(mine, theirs, strict=True):
        for name, x, y in zip(found.columns, a, b, strict=True):
            assert x == (pytest.approx(y, rel=1e-9, abs=1e-12) if isinstance(y, float) else y), (name, a.security_key, a.date)
    search = [tuple(r) for r in ordered(carried.late_states(spark, root, market, day).select("security_key", "date", "sessions", *pv.STATE))]
    full = [tuple(r) for r in ordered(carried.states(bars, market).where(F.col("date") >= F.lit(day)).select("security_key", "date", "sessions", *pv.STATE))]
    assert search == full

    # Only bars after the snapshot, and its own partition, are read.
    needed = carried.resumed(spark, root, day)[0]
    states = [f for f in needed.inputFiles() if "/states/" in f]
    assert states and all(f"date={taken}" in f for f in states)
    plan = needed._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull(date#" in plan and f"> {taken})]" in plan
