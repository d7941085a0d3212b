"""Blind-label sampling, the chart history behind a label, and checks on the labels given."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barscreen.functions.ranks import first_by_digest, top_rows
from barscreen.operators import bars as bo
from barscreen.schema import require

CANDIDATE_SHARE = 1 / 3
RETEST_SHARE = 0.10
RETEST_GAP_DAYS = 28
TARGET_LABELS = 300
HISTORY_BARS = 60
WARMUP_SESSIONS = 120
QUICK_SECONDS = 3
PAUSE_SECONDS = 600
BAR = ["security_key", "date", "slot_index"]


def digest(seed: Column | str) -> Column:
    """sha1 of "seed|security|date|slot": the order every draw is made in."""
    seed = F.lit(seed) if isinstance(seed, str) else seed
    return F.sha1(
        F.concat_ws(
            "|", seed, "security_key", F.col("date").cast("string"),
            F.col("slot_index").cast("string"),
        )
    )


def with_stratum(bars: DataFrame) -> DataFrame:
    """Two disjoint strata: the bars that fired and all others."""
    require(bars, [*BAR, "is_candidate"], "bars")
    stratum = F.when(F.col("is_candidate"), "candidate").otherwise("population")
    return bars.withColumn("stratum", stratum)


def draw(bars: DataFrame, count: int, seed: str) -> DataFrame:
    """`count` bars, a third of them candidates, each with its weight and place in the order.

    The lowest digests of each stratum, found by counting digests by their first digits, so that
    a draw of any size moves the bars drawn and few more. The weight is how many bars of the
    stratum each drawn one stands for.
    """
    wanted = {"candidate": round(count * CANDIDATE_SHARE)}
    wanted["population"] = count - wanted["candidate"]
    pool = with_stratum(bars)
    sizes = pool.groupBy("stratum").agg(F.count(F.lit(1)).alias("_size"))
    drawn = None
    for stratum, n in wanted.items():
        mine = pool.where(F.col("stratum") == stratum)
        one = pool.sparkSession.range(1).select(F.lit(n).alias("_wanted"))
        taken = first_by_digest(mine, digest(f"{seed}|{stratum}"), BAR, one)
        drawn = taken if drawn is None else drawn.unionByName(taken)
    # Two rows of sizes, and at most `count` rows drawn.
    taken = F.least(
        F.col("_size"), F.when(F.col("stratum") == "candidate", wanted["candidate"]).otherwise(
            wanted["population"])
    )
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_o", *BAR))
    return (
        drawn.join(F.broadcast(sizes), "stratum")
        .withColumn("weight", F.col("_size") / taken)
        .withColumn("_o", digest(f"{seed}|order"))
        .select(*BAR, "stratum", "weight", place.alias("place"))
    )


def due_for_retest(shown: DataFrame, today, seed: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """A tenth of everything shown, from first showings at least 28 days old, by digest.

    Showings of one chart share its digest; `ties` names the columns that tell them apart, so that
    the draw does not depend on the order rows arrive in.
    """
    require(shown, [*BAR, "shown_on", "is_retest"], "shown")
    ripe = shown.where(
        (F.col("shown_on") <= F.date_sub(F.lit(today), RETEST_GAP_DAYS))
        & ~F.coalesce("is_retest", F.lit(False))
    )
    total = shown.agg(F.bround(F.count(F.lit(1)) * F.lit(RETEST_SHARE)).alias("_wanted"))
    return first_by_digest(ripe, digest(f"{seed}|retest"), [*BAR, *ties], total)


def unlabelled(pool: DataFrame, labels: DataFrame) -> DataFrame:
    """The pool less every bar labelled already."""
    return pool.join(labels.select(*BAR).distinct(), BAR, "left_anti")


def session_pool(sessions: DataFrame, sample: int = 40, warmup: int = WARMUP_SESSIONS) -> DataFrame:
    """Every k-th session after the warm-up, the last `sample` of them."""
    usable = sessions.where(F.col("session_no") >= warmup)
    whole = Window.partitionBy(F.lit(0))
    at = F.row_number().over(whole.orderBy("session_no")) - 1
    step = F.greatest(F.expr(f"count(1) over () div {sample}"), F.lit(1))
    spaced = usable.withColumn("_p", at).withColumn("_k", step).where("_p % _k = 0")
    back = F.row_number().over(whole.orderBy(F.desc("session_no")))
    return spaced.withColumn("_b", back).where(F.col("_b") <= sample).drop("_p", "_k", "_b")


def plan_session(
    bars: DataFrame, sessions: DataFrame, labels: DataFrame, count: int, seed: str,
    sample: int = 40, warmup: int = WARMUP_SESSIONS,
) -> DataFrame:
    """The charts of one labelling session."""
    pool = bars.join(F.broadcast(session_pool(sessions, sample, warmup)).select("date"), "date")
    return draw(unlabelled(pool, labels), count, seed)


def chart_history(
    hourly: DataFrame, judged: DataFrame, sessions: DataFrame, n: int = HISTORY_BARS
) -> DataFrame:
    """The last `n` hourly bars up to each judged bar, from its session and the n/6 before.

    `judged`: (security_key, date, judged_slot). Each is repeated once a session looked at, so
    the join is an equality on (security, session).
    """
    numbers = F.broadcast(sessions.select("date", "session_no"))
    back = n // 6
    wanted = (
        judged.join(numbers, "date")
        .withColumn("_at", F.explode(F.sequence(F.col("session_no") - back, F.col("session_no"))))
        .withColumnRenamed("date", "judged_date")
    )
    seen = (
        hourly.join(numbers.withColumnRenamed("session_no", "_at"), "date")
        .join(wanted, ["security_key", "_at"])
        .where((F.col("_at") < F.col("session_no")) | (F.col("slot_index") <= F.col("judged_slot")))
        .drop("_at", "session_no")
    )
    return top_rows(
        seen, ["security_key", "judged_date", "judged_slot"],
        [F.desc("date"), F.desc("slot_index")], n,
    )


def daily_history(
    daily: DataFrame, hourly: DataFrame, judged: DataFrame, sessions: DataFrame, n: int = 60
) -> DataFrame:
    """The `n` sessions before each judged bar as daily bars, then its own session so far.

    The stored daily bar of the judged session is never used: it holds hours yet to come.
    """
    numbers = F.broadcast(sessions.select("date", "session_no"))
    wanted = (
        judged.join(numbers, "date")
        .withColumn("_at", F.explode(F.sequence(F.col("session_no") - n, F.col("session_no") - 1)))
        .withColumnRenamed("date", "judged_date")
        .drop("session_no")
    )
    keep = ["security_key", "judged_date", "judged_slot", "date", "open", "high", "low", "close",
            "volume"]
    past = (
        daily.join(numbers.withColumnRenamed("session_no", "_at"), "date")
        .join(wanted, ["security_key", "_at"])
        .select(*keep)
    )
    today = bo.partial_day(hourly, judged).withColumn("judged_date", F.col("date"))
    return past.unionByName(today.select(*keep))


# --- checks on the labels -----------------------------------------------------


def label_summary(labels: DataFrame) -> DataFrame:
    """Totals, rate, notes and planned retests; one row."""
    total = F.count(F.lit(1))
    hits = F.count_if(F.col("response") == "interesting")
    return labels.agg(
        total.alias("labels"),
        F.greatest(F.lit(TARGET_LABELS) - total, F.lit(0)).alias("still_to_do"),
        hits.alias("interesting"),
        F.count_if(F.col("response") == "not_interesting").alias("not_interesting"),
        (hits / total).alias("rate"),
        (hits / total).between(0.08, 0.60).alias("rate_in_range"),
        F.sum((F.trim(F.coalesce("note", F.lit(""))) != "").cast("bigint")).alias("notes"),
        F.sum(F.coalesce("is_retest", F.lit(False)).cast("bigint")).alias("planned_retests"),
    )


#: Sequences of answers are cut at this many seconds, and the pieces' edges are put together.
PIECE_SECONDS = 3600


def _in_pieces(labels: DataFrame, per: tuple[str, ...], order: str) -> tuple[DataFrame, list[str]]:
    """Answered labels with `_per` (one value if nothing sets labellers apart) and `_piece`."""
    seconds = F.unix_seconds(F.col(order).cast("timestamp"))
    known = labels.where(F.col(order).isNotNull()).withColumn("_piece", F.floor(seconds / PIECE_SECONDS))
    return known, [*per, "_piece"]


def longest_run(labels: DataFrame, order: str = "answered_at", per: tuple[str, ...] = ()) -> DataFrame:
    """The longest stretch of identical answers, by gaps and islands.

    `per` names the labeller (and session) a sequence belongs to. Islands are found within
    pieces of time; a stretch can go on only from a piece's last island to the next piece's
    first, so just these two rows a piece are ordered over the whole sequence.
    """
    known, piece = _in_pieces(labels, per, order)
    w = Window.partitionBy(*piece).orderBy(order)
    turned = F.coalesce(~F.lag("response").over(w).eqNullSafe(F.col("response")), F.lit(True))
    islands = (
        known.withColumn("_turned", turned.cast("int"))
        .withColumn("_island", F.sum("_turned").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*piece, "_island")
        .agg(F.count(F.lit(1)).alias("_run"), F.first("response").alias("response"))
        .withColumn("_last", F.max("_island").over(Window.partitionBy(*piece)))
    )
    edges = islands.where((F.col("_island") == 1) | (F.col("_island") == F.col("_last")))
    along = Window.partitionBy(*(per or [F.lit(0)])).orderBy("_piece", "_island")
    goes_on = (F.col("_island") == 1) & F.lag("response").over(along).eqNullSafe(F.col("response"))
    goes_on = goes_on & F.lag(F.lit(1)).over(along).isNotNull()
    joined = (
        edges.withColumn("_new", (~goes_on).cast("int"))
        .withColumn("_stretch", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*per, "_stretch")
        .agg(F.sum("_run").alias("_run"))
        .drop("_stretch")
    )
    both = joined.unionByName(islands.select(*per, "_run"))
    return both.groupBy(*per).agg(F.max("_run").alias("longest_run"))


def label_pace(labels: DataFrame, per: tuple[str, ...] = ()) -> DataFrame:
    """The middle gap between answers under ten minutes apart, and how many were too quick.

    Gaps within a piece of time come from the piece, those between pieces from its ends.
    """
    known, piece = _in_pieces(labels, per, "answered_at")
    w = Window.partitionBy(*piece).orderBy("answered_at")
    since = lambda before, after: F.timestamp_diff("SECOND", before, after)
    inside = known.withColumn("gap", since(F.lag("answered_at").over(w), F.col("answered_at")))
    ends = known.groupBy(*piece).agg(F.min("answered_at").alias("_from"), F.max("answered_at").alias("_to"))
    along = Window.partitionBy(*(per or [F.lit(0)])).orderBy("_piece")
    between = ends.withColumn("gap", since(F.lag("_to").over(along), F.col("_from")))
    gaps = inside.select(*per, "gap").unionByName(between.select(*per, "gap"))
    gaps = gaps.where(F.col("gap") < PAUSE_SECONDS)
    return gaps.groupBy(*per).agg(
        F.count(F.lit(1)).alias("gaps"),
        # The upper middle element, as an exact order statistic of whole seconds.
        F.expr("percentile_disc(0.5) within group (order by gap desc)").alias("typical_seconds"),
        F.sum((F.col("gap") < QUICK_SECONDS).cast("bigint")).alias("quick"),
        (F.sum((F.col("gap") < QUICK_SECONDS).cast("bigint")) > F.count(F.lit(1)) * 0.2).alias(
            "too_quick"
        ),
    )


def pattern_guesses(labels: DataFrame) -> DataFrame:
    named = labels.where(F.coalesce("pattern_guess", F.lit("")) != "")
    return named.groupBy("pattern_guess").agg(F.count(F.lit(1)).alias("labels"))


def repeated_charts(labels: DataFrame) -> DataFrame:
    """Charts labelled more than once against planned retests; one row."""
    per = labels.groupBy(*BAR).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.coalesce("is_retest", F.lit(False)).cast("bigint")).alias("_planned"),
    )
    repeated = F.count_if(F.col("_n") > 1)
    return per.agg(
        repeated.alias("repeated"), F.sum("_planned").alias("planned"),
        ((repeated > 0) & (repeated > F.sum("_planned"))).alias("unplanned"),
    )


def stratum_rates(labels: DataFrame, target: int = TARGET_LABELS) -> DataFrame:
    """Hits per stratum; no rows at all before the target is reached."""
    total = F.broadcast(labels.agg(F.count(F.lit(1)).alias("_total")))
    hits = F.count_if(F.col("response") == "interesting")
    return (
        labels.groupBy("stratum")
        .agg(hits.alias("hits"), F.count(F.lit(1)).alias("labels"))
        .crossJoin(total)
        .where(F.col("_total") >= target)
        .select("stratum", "hits", "labels", (F.col("hits") / F.col("labels")).alias("rate"))
    )
