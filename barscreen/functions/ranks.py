"""Exact ranks within a group that may be too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barscreen.session import cut_lineage

#: Value ranges a group is cut into, and how many parts a range of one repeated value is cut
#: into. They decide only how evenly work is spread; the ranks are exact whatever they are.
RANGES = 32
TIE_PARTS = 16


def group_rank(
    df: DataFrame, group: Sequence[str], value: str, key: str, into: str
) -> DataFrame:
    """`into` = 1, 2, 3 ... within `group` by (`value`, md5(`key`), `key`); null values unranked.

    A plain `row_number` sorts a whole group in one task. Here each group is cut into value
    ranges by approximate quantiles, a value frequent enough to be a cut point is cut further by
    the digest that breaks its ties, every piece is counted, and each piece is numbered on its
    own from the count of the pieces before it.
    """
    cuts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*group)
        .agg(
            F.array_distinct(
                F.percentile_approx(value, [i / RANGES for i in range(1, RANGES)], 1000)
            ).alias("_cuts")
        )
    )
    # Two branches read the cuts and must see the same ones, also after a retry: approximate
    # quantiles depend on the order blocks arrive in. One short array a group.
    cuts = cut_lineage(cuts)
    digest = F.md5(F.col(key).cast("string"))
    tied = F.array_contains("_cuts", F.col(value))
    below = F.size(F.filter("_cuts", lambda c: c < F.col(value)))
    part = F.conv(F.substring(digest, 1, 1), 16, 10).cast("int")
    placed = (
        df.join(cuts, list(group), "left")
        .withColumn("_digest", digest)
        .withColumn(
            "_piece",
            F.when(
                F.col(value).isNotNull(),
                (below * 2 + tied.cast("int")) * TIE_PARTS + F.when(tied, part).otherwise(0),
            ),
        )
        .drop("_cuts")
    )
    pieces = (
        placed.where(F.col("_piece").isNotNull())
        .groupBy(*group, "_piece")
        .agg(F.count(F.lit(1)).alias("_here"))
    )
    # At most (2 x RANGES + 1) x TIE_PARTS rows a group, whatever the size of the data.
    offset = F.sum("_here").over(
        Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    )
    pieces = pieces.select(*group, "_piece", F.coalesce(offset, F.lit(0)).alias("_before"))
    local = F.row_number().over(
        Window.partitionBy(*group, "_piece").orderBy(value, "_digest", key)
    )
    return (
        placed.join(pieces, [*group, "_piece"], "left")
        .withColumn(into, F.when(F.col("_piece").isNotNull(), F.col("_before") + local))
        .drop("_piece", "_before", "_digest")
    )


def top_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first `k` rows of each group.

    `row_number() <= k` lets Spark keep only k rows a group in every task before the shuffle, so
    a group of any size arrives as k rows a task. Spark does so up to a limit; a larger k, which
    would sort a whole group in one task, is refused.
    """
    most = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > most:
        raise ValueError(f"top {k} of a group is more than spark.sql.optimizer.windowGroupLimitThreshold ({most})")
    return (
        df.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
        .where(F.col("_n") <= k)
        .drop("_n")
    )


def first_by_digest(df: DataFrame, digest: Column, ties: Sequence[str], wanted: DataFrame) -> DataFrame:
    """The first n rows of a whole table by (`digest`, `ties`), n from the one-row, one-column
    `wanted`.

    Rows are counted by the digest's first four hex digits: at most 65,536 counts say which
    buckets are wanted whole and which one partly, and only rows within a bucket are ordered.
    """
    marked = df.withColumn("_d", digest).withColumn("_bucket", F.substring("_d", 1, 4))
    counts = marked.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_here"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    limit = F.broadcast(wanted.toDF("_wanted"))
    starts = counts.withColumn("_before", F.coalesce(F.sum("_here").over(earlier), F.lit(0))).crossJoin(limit)
    starts = F.broadcast(starts.where("_before < _wanted").drop("_here"))
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_bucket").orderBy("_d", *ties))
    return (
        marked.join(starts, "_bucket").withColumn("_place", place).where("_place <= _wanted")
        .select(*df.columns)
    )
