"""What moves between tasks grows with the bars, not with the windows they lie in."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barscreen.functions import orders
from barscreen.operators import audits as au
from barscreen.operators import calendar as cal
from barscreen.operators import histories as hs
from barscreen.operators import identity as idn
from barscreen.operators import universe as un
from barscreen.plans import adapters as ad
from barscreen.plans import features as ft
from barscreen.plans.catalog import base as b
from barscreen.plans.catalog import features as cf
from barscreen.plans.catalog import sources as cso
from barscreen.plans.catalog import study as cst
from barscreen.plans.catalog import universe as cu
from barscreen.sources import store

D = dt.date


def shuffled_rows(spark, work) -> int:
    """Rows written to shuffles while `work` runs."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def total() -> int:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        stages = store.stageList(None, False, False, getattr(store, "stageList$default$4")(), getattr(store, "stageList$default$5")())
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = total()
    work()
    return total() - before


def weekly(spark, tickers: int, weeks: int):
    """(bars, sessions, rebalances): a bar a ticker and week, the volume telling them apart."""
    first = D(2015, 1, 5)
    bars = spark.range(tickers).crossJoin(spark.range(weeks).select(F.col("id").alias("w"))).select(
        F.concat(F.lit("S"), "id").alias("ticker"), F.date_add(F.lit(first), (F.col("w") * 7).cast("int")).alias("date"),
        F.lit(10.0).alias("close"), (100.0 + F.pmod(F.col("id") * 7 + F.col("w") * 13, F.lit(50))).alias("volume"),
    )
    sessions = cal.session_dimension(bars.select("date").distinct())
    return bars.localCheckpoint(), sessions.localCheckpoint(), cal.rebalance_dates(sessions).localCheckpoint()


def test_stitched_measure_moves_bars_once(spark):
    bars, sessions, rebalances = weekly(spark, 300, 200)
    old = F.when((F.substring("ticker", 2, 9).cast("int") % 10 == 0) & (F.col("date") < F.lit(D(2017, 1, 2))), F.concat(F.lit("O"), "ticker"))
    bars = bars.withColumn("ticker", F.coalesce(old, "ticker")).localCheckpoint()
    listed = spark.range(300).select(F.concat(F.lit("S"), "id").alias("ticker"))
    held = listed.select(
        F.col("ticker").alias("ticker_now"), F.concat(F.lit("O"), "ticker").alias("ticker_then"),
        F.lit(D(2010, 1, 1)).alias("start"), F.lit(D(2016, 12, 31)).alias("end"), F.lit("ok").alias("status"),
    )
    given = (bars, rebalances, sessions, listed, held, 60, 500.0)
    found = {}
    moved = shuffled_rows(spark, lambda: found.update(rows=idn.stitched_measure(*given).collect()))
    # A bar lies in some fourteen windows.
    windows = idn.stitched_windows(*given)[0].localCheckpoint()
    assert windows.count() > 10 * bars.count()
    assert moved < 2 * bars.count()
    expected = windows.groupBy("rebalance_date", "ticker").agg(F.count_distinct("date"), F.median(F.col("close") * F.col("volume"))).collect()
    assert {tuple(r) for r in found["rows"]} == {tuple(r) for r in expected} and len(found["rows"]) == len(expected)
    assert any(r.ticker == "S0" and r.days == 60 and r.rebalance_date < D(2018, 1, 1) for r in found["rows"])


def test_stitch_log_moves_bars_of_renamed_only(spark):
    """Against the rule written out: gaps, repeated days, unknown prices, days that are no sessions,
    open spans, an old symbol of two owners and spans of unlisted, unnamed and unseen symbols."""
    _, sessions, rebalances = weekly(spark, 1, 40)
    days = sorted(r.date for r in sessions.collect())
    off = days[3] + dt.timedelta(2)
    seen = {"A": days[20:], "OA": days[:20], "B": days[15:] + days[16:18], "OB": days[:18] + [days[2], off], "C": days[12:], "OC": days[:20],
            "D": days[::3], "E": days[22:], "F": days, "G": days[12:], "U": days[10:], "OU": days[:10]}
    named = [(t, d, None if (t, i) == ("A", 2) else 10.0, 100.0 + i) for t, ds in seen.items() for i, d in enumerate(ds)]
    others = spark.range(300).crossJoin(sessions.select("date")).select(F.concat(F.lit("X"), "id").alias("ticker"), "date", F.lit(10.0).alias("close"), F.lit(100.0).alias("volume"))
    bars = spark.createDataFrame(named, "ticker string, date date, close double, volume double").unionByName(others).repartition(40).localCheckpoint()
    spans = [("A", "OA", days[0], days[19], "ok"), ("B", "OB", days[1], None, "ok"), ("C", "OC", days[0], days[9], "no_events"),
             ("E", "OC", days[10], days[19], "ok"), ("D", "F", days[4], days[30], "ok"), ("G", "OA", None, days[9], "ok"),
             ("G", "OC", days[15], days[12], "ok"), ("F", "F", days[0], None, "ok"), ("U", "OU", days[0], None, "ok"), ("A", "gone", days[0], None, "ok")]
    held = spark.createDataFrame(spans, "ticker_now string, ticker_then string, start date, end date, status string")
    listed = spark.createDataFrame([(t,) for t in "ABCDEFG"] + [("A",)], "ticker string")
    given = (bars, rebalances, sessions, listed, held, 12, 1015.0)
    expected = set()
    for r in rebalances.collect():
        window = days[max(r.as_of_no - 11, 0) : r.as_of_no + 1]
        of = {t: [(d, c, v) for x, d, c, v in named if x == t and d in window] for t in seen}
        for now, then, start, end, status in spans:
            own = [d for d, _, _ in of.get(then, []) if start and start <= d and (end is None or d <= end)]
            mine = {d for d, _, _ in of[now]}
            values = sorted(c * v for _, c, v in of[now] if c is not None)
            half = len(values) // 2
            enough = values and (values[half] + values[-half - 1]) / 2 >= 1015.0
            if now != then and now != "U" and own and len(mine) < 12 and enough:
                outcome = "no history" if status != "ok" else "clash" if mine & set(own) else "stitched"
                expected.add((r.rebalance_date, now, then, start, len(own), outcome))
    found = {}
    moved = shuffled_rows(spark, lambda: found.update(log=[tuple(r) for r in idn.stitch_log(*given).collect()]))
    assert sorted(found["log"]) == sorted(expected) and {x[-1] for x in expected} == {"no history", "clash", "stitched"}
    assert {x[1] for x in expected} >= {"A", "B", "C", "D", "E"}
    assert sorted(tuple(r) for r in idn.stitched_windows(*given)[1].collect()) == sorted(expected)
    # The others, a row of each in each of the forty tasks, would be 12,000.
    assert moved < 2000


def test_monthly_stitches_bars_of_renamed_only(spark):
    """What is moved are the bars of a quarter of the suppliers, not of all."""
    hundred = "/root/testdata/sf0.01"
    bars, _ = cu.supplier_bars(spark, hundred).count(), cu.supplier_weeks(spark, hundred).count()
    found = {}
    moved = shuffled_rows(spark, lambda: found.update(rows=cu.monthly_stitches(spark, hundred).collect()))
    assert found["rows"] and moved < bars / 2


def test_day_bars_move_one_name(spark, small):
    """A security's key is its name: it is moved once a bar, not in three copies."""
    plan = ad.day_bars(spark, small, "supplier", "week")._jdf.queryExecution().optimizedPlan().toString()
    assert "requested_ticker" not in plan.split("Aggregate [")[1].split("]")[0]


def rules_of(spark, tickers: int, weeks: int):
    bars, sessions, rebalances = weekly(spark, tickers, weeks)
    splits = spark.createDataFrame(
        [("S1", D(2015, 3, 1), 1.0, 2.0), ("S1", D(2016, 3, 1), 1.0, 4.0)], "ticker string, execution_date date, split_from double, split_to double"
    )
    listed = spark.range(tickers).select(
        F.concat(F.lit("S"), "id").alias("ticker"), F.lit("XNYS").alias("primary_exchange"), F.lit("CS").alias("type"),
        F.lit(D(2000, 1, 1)).alias("list_date"), F.lit(None).cast("date").alias("first_event_date"),
        F.lit(1000.0).alias("share_class_shares"),
    ).localCheckpoint()
    rules = un.Rules(min_market_cap=1.0, max_market_cap=1e12, min_median_dollar_volume=1.0, min_close=1.0, min_history_sessions=2, top_n=5)
    return (rebalances, listed, bars, splits.localCheckpoint(), sessions, rules), bars


def test_rated_moves_bars_once(spark):
    given, bars = rules_of(spark, 300, 200)
    found = {}
    moved = shuffled_rows(spark, lambda: found.update(rows=un.rated(*given).collect()))
    assert moved < 2 * bars.count()
    assert len(found["rows"]) == 300 * given[0].count()
    one = {r.rebalance_date: r for r in found["rows"] if r.ticker == "S1"}
    values = {r.date: r.close * r.volume for r in bars.where("ticker = 'S1'").collect()}
    for day, r in one.items():
        past = sorted(([0.0] * 60 + [values[d] for d in sorted(values) if d < day])[-60:])
        assert r.median_dollar_volume_60 == (past[29] + past[30]) / 2
        grown = [n for d, n in ((D(2015, 3, 1), 2.0), (D(2016, 3, 1), 4.0)) if r.share_count_date < d <= day]
        late = [n for d, n in ((D(2015, 3, 1), 2.0), (D(2016, 3, 1), 4.0)) if r.as_of_session < d <= day]
        scale = 1.0
        for n in late:
            scale /= n
        assert r.close == 10.0 * scale
        for n in grown:
            scale *= n
        assert r.market_cap == 1000.0 * 10.0 * scale


def test_attrition_rates_once(spark):
    given, bars = rules_of(spark, 200, 150)
    moved = shuffled_rows(spark, lambda: un.attrition(un.rated(*given), given[1], given[0], given[5]).collect())
    assert moved < 2 * bars.count()


def test_study_reads_members_only(spark, small):
    """Outcomes, folds and the verdict read stage tables of members, not every trade again."""
    for df in (cst._outcomes(spark, small), cst._day_frame(spark, small), cst.walk_forward_folds(spark, small)):
        files = df.inputFiles()
        assert files and not any("lineitem" in f for f in files)
    ever = {r.ticker for r in cst.study_members(spark, small).collect()}
    assert {r.security_key for r in cst.study_bars(spark, small).select("security_key").distinct().collect()} == ever


def test_retest_draw_settles_ties(spark, tmp_path):
    """A hundred labels of one chart: ids 59,820 apart share date, slot and digest."""
    ids = spark.range(99, -1, -1, numPartitions=1).select((F.col("id") * 59_820).alias("doc_id"))
    ids.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    texts = ids.select("doc_id", F.lit("x").alias("text"), F.lit("en").alias("lang"), F.lit("web").alias("source"), F.lit(1).cast("bigint").alias("n_chars"))
    texts.write.parquet(f"{tmp_path}/documents.parquet")
    found = cst.label_retest(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in found) == [i * 59_820 for i in range(10)]


def partitions(df) -> int:
    """The partitions `df` comes in, none of them joined up by adaptive execution."""
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_daily_features_move_bars_once(spark, small):
    """Into as many partitions as there are bars for, none larger than a task can sort."""
    days = ad.day_bars(spark, small, "supplier", "day").localCheckpoint()
    market = ad.market_bars(spark, small, "day")[1].localCheckpoint()
    rows, some = days.count(), 6 * orders.BARS_A_TASK
    found = {}
    moved = shuffled_rows(spark, lambda: found.update(n=ft.daily_features(days, market, rows=some).select("*", F.spark_partition_id().alias("p")).collect()))
    # The benchmark's returns are shuffled as well: a row a session, for two windows.
    assert rows <= moved <= rows + 3 * market.count()
    wide = spark.range(3000).select(F.concat(F.lit("S"), "id").alias("security_key"))
    assert partitions(orders.by_security(wide, some)) == 6
    plain = {(r.security_key, r.date): r for r in ft.daily_features(days, market).collect()}
    assert len(found["n"]) == rows and all(plain[r.security_key, r.date] == r[:-1] for r in found["n"])


def test_new_rows_in_small_tasks(spark):
    day = F.date_add(F.lit(D(2020, 1, 1)), (F.col("id") % 50).cast("int")).alias("date_et")
    rows = spark.range(5000).select(F.concat(F.lit("S"), F.col("id") % 97).alias("security_key"), day, F.concat(F.lit("T"), F.col("id") % 3).alias("ticker"))
    covered = rows.where(F.col("ticker") == "T1")
    found = store.day_manifest(store.new_rows(rows, covered, 9 * store.ROWS_A_TASK))
    assert partitions(found) == 9
    assert sorted(found.collect()) == sorted(store.day_manifest(store.new_rows(rows, covered)).collect())


def test_windows_are_cut_out_of_ordered_bars(spark):
    """By halving: the plan has no filter over a whole history. Gaps, repeated days and windows
    before, between and after the bars are as a filter has them."""
    day = lambda n: D(2020, 1, 1) + dt.timedelta(n)
    held = {"A": [], "B": [7], "C": [3, 3, 3], "D": [9, 0, 4, 4, 30], "E": list(range(64)), "F": [2 * n for n in range(37)]}
    bars = spark.createDataFrame([(t, float(i), day(n)) for t, ns in held.items() for i, n in enumerate(ns)], "ticker string, close double, date date")
    sessions = bars.select("date")
    spans = [(a, z) for a in range(-2, 76, 3) for z in range(a - 1, 78, 4)]
    months = spark.createDataFrame([(day(a), day(z)) for a, z in spans], "_from date, _to date").agg(F.collect_list(F.struct("_from", "_to")).alias("_months"))
    lone = spark.createDataFrame([("A", [])], "ticker string, _bars array<struct<date:date,close:double>>")
    every = hs.histories(bars, sessions, ["close", "date"]).unionByName(lone)
    cut = hs.by_month(every, months, ["ticker"], lambda m: F.struct(m["_from"].alias("a"), m["_to"].alias("z"), hs.within("_bars", m).alias("w")))
    found = {(r.ticker, r.a, r.z): [(x.date, x.close) for x in r.w] for r in cut.collect()}
    assert len(found) == len(held) * len(spans)
    for (ticker, a, z), window in found.items():
        assert window == sorted((day(n), float(i)) for i, n in enumerate(held[ticker]) if a <= day(n) <= z)
    assert "filter(_bars" not in cut._jdf.queryExecution().optimizedPlan().toString()


def test_ticker_events_are_parsed_once(spark, small):
    gaps = au.history_gaps(cu.identities(spark, small)).select("requested", "status")
    assert gaps._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_audit_logs_make_bars_once(spark, small, monkeypatch):
    """The universe and the renames read one stage table, not the trades twice."""
    made = []
    monkeypatch.setattr(ad, "day_bars", lambda *given, make=ad.day_bars: made.append(given) or make(*given))
    b.forget_stored()
    assert {r.log for r in cso.audit_logs(spark, small).collect()} == set(store.LOGS)
    assert len(made) == 1


def test_daily_features_have_no_frames(spark, small):
    """What looks back over many bars is measured a partition at a time, not frame by frame; the
    result is that of the windows, which late sessions go on with."""
    days = ad.day_bars(spark, small, "nation", "week").localCheckpoint()
    market = ad.market_bars(spark, small, "week")[1].localCheckpoint()
    keep = ("ranges_seen", "range_value", "paired")
    found = ft.daily_features(days, market, keep=keep)
    assert "Window [" not in found._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]
    nobody = spark.createDataFrame([], "security_key string, close double, ranges_seen bigint, range_value double, beta_60 double, paired bigint")
    plain = {(r.security_key, r.date): r.asDict() for r in ft.daily_features(days, market, keep=keep, carried=nobody).collect()}
    rows = [r.asDict() for r in found.collect()]
    assert len(rows) == len(plain) > 1000
    for r in rows:
        for name, value in plain[r["security_key"], r["date"]].items():
            assert r[name] == pytest.approx(value, rel=1e-9, abs=1e-9) if isinstance(value, float) else r[name] == value, name


def test_many_doubles_are_rounded_apart(spark):
    """As the SQL rounds: halves away from zero; not through decimals, and in methods of their own."""
    values = [0.0078125, -0.0078125, 2.5, 1e300, -3e-7, 123456.7890125, None, float("inf")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    many = b.tidy(df.select("i", *[F.col("v").alias(f"v{k}") for k in range(12)]))
    found = [r.v3 for r in many.orderBy("i").collect()]
    assert found == [0.007813, -0.007813, 2.5, 1e300, 0.0, 123456.789013, None, float("inf")]
    assert "transform(array(i" in many._jdf.queryExecution().optimizedPlan().toString()


def test_slot_features_move_slots_once(spark):
    """A traded slot is moved when it is made up and once to its security: no bar of the grid, no
    session and no feature is moved after that, and nothing is written between."""
    hundred = "/root/testdata/sf0.01"
    slots = ad.trades(spark, hundred, "supplier", "month").select("security_key", "date", "slot_index").distinct().count()
    found = {}
    moved = shuffled_rows(spark, lambda: found.update(n=cf.supplier_features(spark, hundred).select(F.sum(F.hash("*"))).collect()))
    trades = spark.read.parquet(f"{hundred}/lineitem.parquet").count()
    assert slots < trades and moved < 2.2 * trades
    plan = cf.supplier_features(spark, hundred)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter, (security_key" not in plan and "LogicalRDD" not in plan
