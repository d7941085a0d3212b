"""The monthly point-in-time universe."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barscreen.functions import trailing as tr
from barscreen.operators import calendar as cal
from barscreen.operators import histories as hs
from barscreen.schema import require
from barscreen.session import cut_lineage


@dataclass(frozen=True)
class Rules:
    """The selection thresholds."""

    exchanges: tuple[str, ...] = ("XNYS", "XNAS", "XASE")
    security_type: str = "CS"
    min_market_cap: float = 2_000_000_000
    max_market_cap: float = 50_000_000_000
    dollar_volume_sessions: int = 60
    min_median_dollar_volume: float = 15_000_000
    min_close: float = 10.0
    min_history_sessions: int = 250
    top_n: int = 400
    share_count_lag_days: int = 105


STEPS = ("exchange", "type", "close", "dollar_volume", "history", "market_cap", "top_n")


def padded_median(ordered: Column, size: int) -> Column:
    """The median of `size` values of which those not in the sorted array are zero (values are not
    negative).

    No grid of securities and sessions is built: the zeros are only counted.
    """
    zeros = F.lit(size) - F.size(ordered)

    def at(i: int) -> Column:
        return F.when(F.lit(i) < zeros, 0.0).otherwise(F.get(ordered, (F.lit(i) - zeros).cast("int")))

    return (at((size - 1) // 2) + at(size // 2)) / 2.0


def _product(splits: Column, after: Column, upto: Column, over: str, under: str) -> Column:
    """The product of the ratios executed after one day and up to another; 1 if none was."""
    between = F.filter(splits, lambda x: (x["execution_date"] > after) & (x["execution_date"] <= upto))
    ratio = lambda x: F.coalesce(x[over] / x[under], F.lit(1.0))
    found = F.aggregate(between, F.lit(1.0), lambda so_far, x: so_far * ratio(x))
    return F.coalesce(found, F.lit(1.0))


def _measured(
    rebalances: DataFrame, bars: DataFrame, splits: DataFrame, sessions: DataFrame, rules: Rules,
    rows: DataFrame | None = None,
) -> DataFrame:
    """`measure` with `share_factor`, how a share count of `share_count_date` grows to the
    rebalance, and the columns of `rows`, a row a ticker.

    A ticker's bars and splits move once, to its ticker; its months are measured where they lie.
    """
    require(bars, ["ticker", "date", "close", "volume"], "daily bars")
    n = rules.dollar_volume_sessions
    dated = rebalances.withColumn(
        "share_count_date", cal.share_count_date(F.col("as_of_session"), rules.share_count_lag_days)
    ).select("rebalance_date", "as_of_session", "as_of_no", "share_count_date")
    own = splits.groupBy("ticker").agg(
        F.collect_list(F.struct("execution_date", "split_from", "split_to")).alias("_splits")
    )
    # A bar without a dollar volume counts like a session without a bar.
    traded = bars.withColumn("_dollars", F.coalesce(F.col("close") * F.col("volume"), F.lit(0.0)))
    every = hs.histories(traded, sessions, ["date", "close", "_dollars"]).join(own, "ticker", "left")
    keep = ["ticker"]
    if rows is not None:
        every, keep = every.join(rows, "ticker"), [*keep, *[c for c in rows.columns if c != "ticker"]]

    def of(m: Column) -> Column:
        def fields(window: Column) -> Column:
            close = F.array_max(hs.between(window, m["as_of_session"], m["as_of_session"])["close"])
            late = _product(F.col("_splits"), m["as_of_session"], m["rebalance_date"], "split_from", "split_to")
            grown = _product(F.col("_splits"), m["share_count_date"], m["rebalance_date"], "split_to", "split_from")
            return F.struct(
                m["rebalance_date"].alias("rebalance_date"), m["as_of_session"].alias("as_of_session"),
                m["share_count_date"].alias("share_count_date"), F.size(window).alias("_seen"),
                # At most one value a session of the window.
                tr.let(F.sort_array(window["_dollars"]), lambda v: padded_median(v, n)).alias("median_dollar_volume_60"),
                (close * late).alias("close"), grown.alias("share_factor"),
            )

        return tr.let(hs.within("_bars", m), fields)

    return hs.by_month(every, hs.month_windows(dated, sessions, n), keep, of).where("_seen > 0").drop("_seen")


def measure(
    rebalances: DataFrame, bars: DataFrame, splits: DataFrame, sessions: DataFrame, rules: Rules
) -> DataFrame:
    """Per rebalance and ticker: close at the as-of session, and median dollar volume.

    Only bars of the trailing window take part. Dollar volume is the same before and after a
    split adjustment (prices and volume move oppositely), so only the as-of close is adjusted: a
    split executed between the as-of session and the rebalance.
    """
    return _measured(rebalances, bars, splits, sessions, rules).select(
        "rebalance_date", "ticker", "as_of_session", "median_dollar_volume_60", "close"
    )


def listing_date() -> Column:
    """The earlier of the listing date and the first ticker event; either may be missing."""
    return F.least("list_date", "first_event_date")


def static_step(rules: Rules) -> Column:
    """The first step a security fails whatever the month: exchange (0), type (1), or - having no
    bar to be measured by - close (2)."""
    listed = F.coalesce(F.col("primary_exchange").isin(*rules.exchanges), F.lit(False))
    common = F.coalesce(F.col("type") == rules.security_type, F.lit(False))
    return F.when(~listed, 0).when(~common, 1).otherwise(2)


def rated(
    rebalances: DataFrame,
    securities: DataFrame,
    bars: DataFrame,
    splits: DataFrame,
    sessions: DataFrame,
    rules: Rules,
) -> DataFrame:
    """The securities with bars in a rebalance's window, measured, with the first step each fails.

    `failed_step` is the position of that step in `STEPS`, or null. A security without bars has
    no row: it cannot pass, and `attrition` only has to count it.
    """
    numbers = sessions.select(F.col("date").alias("_history_from"), F.col("session_no").alias("_h"))
    calendar = rebalances.join(
        F.broadcast(numbers), F.col("_h") == F.col("as_of_no") - rules.min_history_sessions + 1, "left"
    ).select("rebalance_date", "_history_from")
    out = (
        _measured(rebalances, bars, splits, sessions, rules, securities)
        .join(F.broadcast(calendar), "rebalance_date")
        .withColumn("listing_date", listing_date())
        .withColumn("market_cap", F.col("share_class_shares") * F.col("share_factor") * F.col("close"))
    )
    passes = [
        F.col("primary_exchange").isin(*rules.exchanges),
        F.col("type") == rules.security_type,
        F.col("close") >= rules.min_close,
        F.col("median_dollar_volume_60") >= rules.min_median_dollar_volume,
        F.col("listing_date") <= F.col("_history_from"),
        F.col("market_cap").between(rules.min_market_cap, rules.max_market_cap),
    ]
    failed = F.coalesce(
        *[F.when(~F.coalesce(ok, F.lit(False)), F.lit(i)) for i, ok in enumerate(passes)]
    )
    return out.withColumn("failed_step", failed).drop("share_factor", "_history_from")


def prescreen(rated_securities: DataFrame) -> DataFrame:
    """Those passing the cheap steps: exchange, type, close, dollar volume."""
    return rated_securities.where(F.col("failed_step").isNull() | (F.col("failed_step") >= 4))


def select_universe(rated_securities: DataFrame, rules: Rules) -> DataFrame:
    """The top of the qualifying securities by dollar volume, ranked, per rebalance.

    `row_number() <= top_n` is cut down inside every task before the shuffle.
    """
    order = Window.partitionBy("rebalance_date").orderBy(
        F.desc("median_dollar_volume_60"), "ticker"
    )
    return (
        rated_securities.where(F.col("failed_step").isNull())
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= rules.top_n)
        .drop("failed_step")
    )


def attrition(
    rated_securities: DataFrame, securities: DataFrame, rebalances: DataFrame, rules: Rules
) -> DataFrame:
    """How many securities each step removed, in order, per rebalance; one row a step.

    Those without bars are counted, not listed: the totals of the three static steps less those
    that have a row.
    """
    count, total = F.count(F.lit(1)), F.sum("n")
    # A few counts a month: made once, read by all that follows.
    counts = cut_lineage(
        rated_securities.groupBy("rebalance_date", "failed_step", static_step(rules).alias("step_no")).agg(count.alias("n"))
    )
    measured = counts.groupBy("rebalance_date", "failed_step").agg(total.alias("n"))
    present = counts.groupBy("rebalance_date", "step_no").agg(total.alias("present"))
    # Three totals for each month of the calendar.
    totals = securities.groupBy(static_step(rules).alias("step_no")).agg(count.alias("total"))
    absent = (
        rebalances.select("rebalance_date")
        .crossJoin(F.broadcast(totals))
        .join(present, ["rebalance_date", "step_no"], "left")
        .select(
            "rebalance_date", "step_no",
            (F.col("total") - F.coalesce("present", F.lit(0))).alias("n"),
        )
    )
    failed = measured.where(F.col("failed_step").isNotNull())
    removed = (
        failed.select("rebalance_date", F.col("failed_step").alias("step_no"), "n")
        .unionByName(absent)
        .groupBy("rebalance_date", "step_no")
        .agg(F.sum("n").alias("removed"))
        .where(F.col("removed") > 0)
        .select(
            "rebalance_date",
            F.element_at(F.array(*map(F.lit, STEPS)), F.col("step_no") + 1).alias("step"),
            "removed",
        )
    )
    beyond = measured.where(F.col("failed_step").isNull()).select(
        "rebalance_date", F.lit("top_n").alias("step"),
        F.greatest(F.col("n") - rules.top_n, F.lit(0)).alias("removed"),
    )
    return removed.unionByName(beyond)


def snapshot_in_force(days: DataFrame, snapshots: DataFrame) -> DataFrame:
    """For each day the latest rebalance on or before it. Both sides are calendar tables."""
    starts = snapshots.select("rebalance_date").distinct()
    both = days.withColumn("rebalance_date", F.lit(None).cast("date")).unionByName(
        starts.withColumn("date", F.col("rebalance_date")).select(*[
            F.col(c) if c in ("date", "rebalance_date") else F.lit(None).cast(t).alias(c)
            for c, t in days.dtypes + [("rebalance_date", "date")]
        ]).withColumn("_start", F.lit(True)),
        allowMissingColumns=True,
    )
    # One order over the calendar; a start sorts before the day it falls on.
    w = Window.partitionBy(F.lit(0)).orderBy("date", F.col("_start").desc_nulls_last())
    held = F.last("rebalance_date", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("rebalance_date", held).where("_start is null and rebalance_date is not null")
    return found.drop("_start")


def members_in_force(days: DataFrame, snapshots: DataFrame, key: str = "security_key") -> DataFrame:
    """(date, security_key, median_dollar_volume_60) of the snapshot governing each day."""
    members = snapshots.select("rebalance_date", F.col(key).alias("security_key"), "median_dollar_volume_60")
    in_force = snapshot_in_force(days.select("date").distinct(), snapshots)
    return members.join(F.broadcast(in_force), "rebalance_date").drop("rebalance_date")


def latest_per_security(snapshots: DataFrame) -> DataFrame:
    """Each security ever selected, with the last session its ticker was valid on."""
    return snapshots.groupBy("security_key").agg(
        F.max_by("ticker", "as_of_session").alias("ticker"), F.max("as_of_session").alias("as_of")
    )


def unlisted_repeats(securities: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that break uniqueness: a ticker listed twice, or two bars on one day."""
    return securities.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
