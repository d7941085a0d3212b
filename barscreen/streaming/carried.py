"""Daily features of late sessions from carried state, without the years before them.

Most features look back over a bounded number of a security's own bars. The averaged range, the
held beta and the pivot search do not: each is a state that every session changes. A snapshot of
a session keeps, for every security seen by then, its last bars, as many as the windows read, and
the state as it stood before the first of these. Features of later sessions follow from the
snapshot and the bars after it; no other session is read. A snapshot a month costs about six
times the daily bars; a late session then reads a month of bars, not ten years.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barscreen.functions.orders import by_security, day_order
from barscreen.operators import market as mk
from barscreen.operators import pivots as pv
from barscreen.operators import volatility as vt
from barscreen.plans import features as ft
from barscreen.session import cut_lineage
from barscreen.sources import store

#: Bars of a security that the longest window reads (120), and what is taken off its ends.
RECENT = 130
CARRIED = ("sessions", "close", "ranges_seen", "range_value", "beta_60", "paired", *pv.STATE)


def states(daily: DataFrame, market_daily: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """Every column of the daily bars and the state after each (CARRIED, with the bar's own close).

    `carried` holds the state before each security's first bar here.
    """
    keys = ["security_key", "date"]
    own = by_security(daily)
    if carried is None:
        ranged = vt.daily_volatility(own, keep_state=True)
    else:
        before = carried.select("security_key", F.struct("close", "ranges_seen", "range_value").alias("_state"))
        ranged = vt.daily_volatility(own.join(before, "security_key", "left"), F.col("_state"), keep_state=True)
    ranged = ranged.select(*daily.columns, "ranges_seen", "range_value", F.col("atr20_day").alias("daily_atr"))
    betas = mk.beta_by_session(own, market_daily, carried=carried)
    out = ranged.drop("daily_atr").join(betas, keys).join(pv.confirmed_pivots(ranged, carried), keys)
    seen = F.row_number().over(day_order())
    if carried is None:
        return out.withColumn("sessions", seen)
    before = carried.select("security_key", F.col("sessions").alias("_before"))
    out = out.join(before, "security_key", "left").withColumn("sessions", seen + F.coalesce("_before", F.lit(0)))
    return out.drop("_before")


def snapshots(rows: DataFrame, at: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """(date, security_key, before, bars) for every session of `at` and security with a bar by then.

    `rows` as `states` gives them, `carried` as given to it. `bars` are the last RECENT ones, and
    more where the returns that a beta is fitted on reach further back; `before` is the state
    ahead of the first, null if there was none. A security's rows are as many as the calendar's.
    """
    rows = cut_lineage(rows)  # read by two branches
    bar = F.struct(*[c for c in rows.columns if c not in ("security_key", *CARRIED) or c == "close"])
    own = rows.select("security_key", F.row_number().over(day_order()).alias("_pos"), "date", "paired", bar.alias("_bar"), F.struct(*CARRIED).alias("_state"))
    # The first row from which on so many returns are paired as a fit reads.
    returns = Window.partitionBy("security_key").orderBy("paired").rangeBetween(-mk.BETA_WINDOW, 0)
    first = F.greatest(F.lit(1), F.least(F.min("_pos").over(returns) - 1, F.col("_pos") - RECENT + 1))
    following = F.lead("date").over(day_order())
    days = F.broadcast(at.agg(F.collect_set("date").alias("_at")))  # one row, bounded by the calendar
    taken = F.filter("_at", lambda d: (d >= F.col("date")) & (F.col("_next").isNull() | (d < F.col("_next"))))
    ends = (
        own.select("security_key", "date", first.alias("_first"), F.col("_pos").alias("_last"), following.alias("_next"))
        .crossJoin(days)
        .select("security_key", "_first", "_last", F.explode(taken).alias("date"))
    )
    inside = F.col("_pos").between(F.col("_first") - 1, F.col("_last"))
    held = own.drop("date", "paired").join(ends, "security_key").where(inside)
    out = held.groupBy("date", "security_key").agg(
        F.max(F.when(F.col("_pos") < F.col("_first"), F.col("_state"))).alias("before"),
        F.sort_array(F.collect_list(F.when(F.col("_pos") >= F.col("_first"), F.col("_bar")))).alias("bars"),  # by date
    )
    if carried is None:
        return out
    fields = [F.col(c).cast(rows.schema[c].dataType).alias(c) for c in CARRIED]
    start = carried.select("security_key", F.struct(*fields).alias("_start"))
    joined = out.join(start, "security_key", "left")
    return joined.select("date", "security_key", F.coalesce("before", "_start").alias("before"), "bars")


def newest_snapshot(spark: SparkSession, root: str, day) -> DataFrame:
    """The rows of the last snapshot before a session: only its partition is read."""
    stored = spark.read.parquet(f"{root}/states")
    last = stored.where(F.col("date") < F.lit(day)).agg(F.max("date")).first()[0]
    return spark.read.option("basePath", f"{root}/states").parquet(f"{root}/states/date={last}")


def resumed(spark: SparkSession, root: str, day, until=None) -> tuple[DataFrame, DataFrame]:
    """Bars that the sessions from `day` on need, and the state before them.

    Stored bars are read from the session after the newest snapshot before `day` on; the ones
    before come out of the snapshot.
    """
    snapshot = newest_snapshot(spark, root, day)
    recent = snapshot.select("security_key", F.inline("bars"))
    taken = snapshot.agg(F.max("date")).first()[0]
    later = store.read_dataset(spark, root, "daily").where(F.col("date") > F.lit(taken))
    if until is not None:
        later = later.where(F.col("date") <= F.lit(until))
    carried = snapshot.select("security_key", "before.*").where(F.col("sessions").isNotNull())
    return recent.unionByName(later.select(*recent.columns)), carried


def late_features(spark: SparkSession, root: str, market_daily: DataFrame, day, keep: tuple[str, ...] = ()) -> DataFrame:
    """`daily_features` of the sessions from `day` on."""
    bars, carried = resumed(spark, root, day)
    return ft.daily_features(bars, market_daily, keep=keep, carried=carried).where(F.col("date") >= F.lit(day))


def late_states(spark: SparkSession, root: str, market_daily: DataFrame, day) -> DataFrame:
    """`states` of the sessions from `day` on, the pivots among them."""
    bars, carried = resumed(spark, root, day)
    return states(bars, market_daily, carried).where(F.col("date") >= F.lit(day))


def write_snapshots(rows: DataFrame, at: DataFrame, root: str, carried: DataFrame | None = None) -> None:
    """Store the snapshots of the sessions of `at`, replacing these sessions' earlier ones."""
    store.write_sessions(snapshots(rows, at, carried), root, "states")


def refresh(spark: SparkSession, root: str, market_daily: DataFrame, day, at: DataFrame) -> None:
    """Store the snapshots of the sessions of `at` from `day` on anew, after a late session."""
    bars, carried = resumed(spark, root, day)
    write_snapshots(states(bars, market_daily, carried), at.where(F.col("date") >= F.lit(day)), root, carried)
