"""Matched controls: same day, similar volatility and dollar volume, drawn by digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barscreen.functions.ranks import group_rank, top_rows
from barscreen.schema import require

PER_CANDIDATE = 5
DECILES = 10
MAX_WIDENING = 3
#: Members and candidates of one decile cell handled by one task; a larger cell is split.
CELL_PART, CANDIDATE_PART = 20_000, 200


def relative_atr(daily_atr: Column, close: Column) -> Column:
    """ATR as a share of price: how volatile, not how expensive."""
    return F.when(close > 0, F.try_divide(daily_atr, close))


def with_decile(day: DataFrame, value: str, into: str, group: tuple[str, ...] = ("date",)) -> DataFrame:
    """Cross-sectional deciles 0 to 9 per date, ties in digest order.

    Equal-sized cells by rank r of n: `ceil(10 (r-1) / (n-1)) - 1`, the first row in 0. Fewer
    than ten usable values give none.
    """
    usable = day.groupBy(*group).agg(F.count(value).alias("_n"))
    ranked = group_rank(day, list(group), value, "security_key", "_r").join(
        usable, list(group), "left"
    )
    # Whole numbers throughout: ceil(10 (r-1) / (n-1)) without a fraction.
    cell = F.expr("(10 * (_r - 1) + _n - 2) div (_n - 1)") - 1
    decile = F.when(
        (F.col("_n") >= DECILES) & F.col("_r").isNotNull(), F.greatest(cell, F.lit(0))
    ).cast("int")
    return ranked.withColumn(into, decile).drop("_r", "_n")


def attach_deciles(day: DataFrame) -> DataFrame:
    """`atr_decile` and `volume_decile` over each date's universe."""
    require(day, ["date", "security_key", "daily_atr", "close", "median_dollar_volume_60"], "day")
    keys = ["date", "security_key"]
    relative = relative_atr(F.col("daily_atr"), F.col("close")).alias("_rel")
    # Each axis is ranked on three columns of its own; the wide rows move once, to join both.
    atr = with_decile(day.select(*keys, relative), "_rel", "atr_decile").select(*keys, "atr_decile")
    volume = day.select(*keys, "median_dollar_volume_60")
    volume = with_decile(volume, "median_dollar_volume_60", "volume_decile").select(*keys, "volume_decile")
    return day.join(atr.join(volume, keys), keys)


def among_members(day: DataFrame, members: DataFrame) -> DataFrame:
    """The rows of securities that belonged to the universe in force on their date, with that
    snapshot's dollar volume. Run it before the deciles: they rank members only.

    `members`: date, security_key, median_dollar_volume_60.
    """
    kept = [c for c in day.columns if c != "median_dollar_volume_60"]
    return day.select(*kept).join(members, ["date", "security_key"])


def cell_sizes(day: DataFrame) -> DataFrame:
    """Eligible securities per decile cell and date: at most a hundred rows a date."""
    return (
        day.where(~F.col("is_candidate"))
        .where(F.col("atr_decile").isNotNull() & F.col("volume_decile").isNotNull())
        .groupBy("date", "atr_decile", "volume_decile")
        .agg(F.count(F.lit(1)).alias("eligible"))
    )


def widening_by_cell(sizes: DataFrame, per_candidate: int = PER_CANDIDATE, reach: int = MAX_WIDENING) -> DataFrame:
    """For each cell a candidate could sit in, how far the match has to widen.

    Every cell adds its count to the cells around it, by distance; the running total over
    distance says where enough are found. This decides the widening from counts alone, before
    any candidate meets a control.
    """
    steps = F.sequence(F.lit(-reach), F.lit(reach))
    around = (
        sizes.withColumn("_da", F.explode(steps))
        .withColumn("_dv", F.explode(steps))
        .select(
            "date",
            (F.col("atr_decile") + F.col("_da")).alias("atr_decile"),
            (F.col("volume_decile") + F.col("_dv")).alias("volume_decile"),
            F.greatest(F.abs("_da"), F.abs("_dv")).alias("_w"),
            "eligible",
        )
        .where(F.col("atr_decile").between(0, 9) & F.col("volume_decile").between(0, 9))
    )
    enough = [
        F.sum(F.when(F.col("_w") <= w, F.col("eligible")).otherwise(0)) >= per_candidate
        for w in range(reach + 1)
    ]
    width = F.coalesce(*[F.when(ok, F.lit(w)) for w, ok in enumerate(enough)])
    return (
        around.groupBy("date", "atr_decile", "volume_decile")
        .agg(width.alias("widening"))
        .where(F.col("widening").isNotNull())
    )


def match(
    day: DataFrame,
    firing: DataFrame,
    per_candidate: int = PER_CANDIDATE,
    reach: int = MAX_WIDENING,
) -> DataFrame:
    """One row per (candidate bar, control).

    `day`: one row per date and security with deciles and `is_candidate`; `firing`: the
    candidate bars (`date, security_key, slot_index`). Controls are the lowest digests of
    "date|candidate|slot|control" in the narrowest block of cells holding enough. A candidate
    meets only its own block; a cell with very many members is spread over several tasks, and
    each task keeps only the first `per_candidate` of a candidate before anything is shuffled.
    """
    require(day, ["date", "security_key", "atr_decile", "volume_decile", "is_candidate"], "day")
    sizes = cell_sizes(day)
    width = widening_by_cell(sizes, per_candidate, reach)
    cells = day.select("date", "security_key", "atr_decile", "volume_decile")
    candidate = (
        firing.select("date", "security_key", "slot_index")
        .join(cells, ["date", "security_key"])
        .join(width, ["date", "atr_decile", "volume_decile"])
        .withColumnRenamed("security_key", "candidate_key")
        .withColumnRenamed("slot_index", "candidate_slot")
    )
    offsets = F.sequence(-F.col("widening"), F.col("widening"))
    cell = ["date", "atr_decile", "volume_decile"]
    placed = (
        candidate.withColumn("_da", F.explode(offsets))
        .withColumn("_dv", F.explode(offsets))
        .withColumn("atr_decile", F.col("atr_decile") + F.col("_da"))
        .withColumn("volume_decile", F.col("volume_decile") + F.col("_dv"))
        .drop("_da", "_dv")
    )
    # How many parts each side of a cell is cut into follows from its counts; ordinary cells stay
    # whole. A candidate goes to one of its parts and meets every part of the eligible.
    asking = placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("_asking"))
    spread = sizes.join(asking, cell).select(
        *cell, F.ceil(F.col("eligible") / CELL_PART).cast("int").alias("_parts"),
        F.ceil(F.col("_asking") / CANDIDATE_PART).cast("int").alias("_groups"),
    )
    own = F.pmod(F.hash("candidate_key", "candidate_slot"), F.col("_groups"))
    wanted = (
        placed.join(spread, cell)
        .withColumn("_group", own)
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .drop("_parts", "_groups")
    )
    eligible = (
        day.where(~F.col("is_candidate"))
        .select("date", "atr_decile", "volume_decile", F.col("security_key").alias("control_key"))
        .join(spread, cell)
        .withColumn("_part", F.pmod(F.hash("control_key"), F.col("_parts")))
        .withColumn("_group", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)))
        .drop("_parts", "_groups")
    )
    seed = F.concat_ws(
        "|", F.col("date").cast("string"), "candidate_key",
        F.col("candidate_slot").cast("string"), "control_key",
    )
    pairs = wanted.join(eligible, [*cell, "_part", "_group"]).select(
        "date", "candidate_key", "candidate_slot", "control_key", "widening",
        F.sha1(seed).alias("_digest"),
    )
    chosen = top_rows(
        pairs, ["date", "candidate_key", "candidate_slot"],
        [F.col("_digest"), F.col("control_key")], per_candidate,
    )
    return chosen.drop("_digest")


def match_summary(matched: DataFrame, firing: DataFrame, per_candidate: int = PER_CANDIDATE) -> DataFrame:
    """Candidates, matched, unmatched, exact, widened and mean widening, over everything."""
    per = matched.groupBy("date", "candidate_key", "candidate_slot").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("widening") == 0).cast("bigint")).alias("exact"),
        F.sum("widening").alias("w"),
    )
    found = per.agg(
        F.sum((F.col("n") >= per_candidate).cast("bigint")).alias("matched"),
        F.count(F.lit(1)).alias("_any"),
        F.sum("exact").alias("exact"),
        F.sum(F.col("n") - F.col("exact")).alias("widened"),
        F.try_divide(F.sum("w"), F.sum("n")).alias("mean_widening"),
    )
    total = firing.agg(F.count(F.lit(1)).alias("candidates"))
    return total.crossJoin(found).select(
        "candidates",
        F.coalesce("matched", F.lit(0)).alias("matched"),
        (F.col("candidates") - F.col("_any")).alias("unmatched"),
        F.coalesce("exact", F.lit(0)).alias("exact"),
        F.coalesce("widened", F.lit(0)).alias("widened"),
        "mean_widening",
    )


def mean_cell_occupancy(sizes: DataFrame) -> DataFrame:
    """Per date: eligible securities and how many a cell holds on average by arithmetic."""
    return sizes.groupBy("date").agg(
        F.sum("eligible").alias("eligible"),
        (F.sum("eligible") / (DECILES * DECILES)).alias("per_cell"),
        F.count(F.lit(1)).alias("cells"),
    )
