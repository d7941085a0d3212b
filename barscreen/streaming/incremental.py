"""Rebuild exactly the sessions whose raw parts changed.

Bars are a batch result per session. A late minute file changes the set of parts of its session,
and the whole session is built again; nothing else is touched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barscreen.sources import store


def part_sets(parts: DataFrame) -> DataFrame:
    """Per session how many parts it has and a digest of their names, in any order: the sum of
    52 bits of each name's SHA-1. `parts`: date, file."""
    bits = F.conv(F.substring(F.sha1("file"), 1, 13), 16, 10).cast("decimal(38,0)")
    return parts.select("date", "file").distinct().groupBy("date").agg(
        F.concat_ws("-", F.count(F.lit(1)), F.sum(bits)).alias("parts_digest")
    )


def stale_sessions(parts: DataFrame, built: DataFrame) -> DataFrame:
    """Sessions never built from the parts they have now. `built`: date, parts_digest."""
    return part_sets(parts).join(built, ["date", "parts_digest"], "left_anti")


def sessions_of(batch: DataFrame) -> DataFrame:
    """The sessions of a batch, at most one row a calendar day. The comparison lets the planner
    prune the folders of raw sessions by them while the query runs."""
    return F.broadcast(batch.select("date").distinct().where(F.col("date") > F.lit("0001-01-01").cast("date")))


def rebuild_on_arrival(
    spark: SparkSession,
    raw: str,
    schema: str,
    build: Callable[[DataFrame], DataFrame],
    root: str,
    kind: str,
    checkpoint: str,
) -> None:
    """Process files that arrived since the last run, then stop.

    Each new file names its sessions; those are read whole from the raw folder, which is
    partitioned by date, built, and replace their partitions. Writing a session twice gives the same session, so a batch
    repeated after a failure does no harm.
    """

    def replace(batch: DataFrame, _: int) -> None:
        whole = spark.read.schema(schema).parquet(raw).join(sessions_of(batch), "date", "left_semi")
        store.write_sessions(build(whole), root, kind)

    query = (
        spark.readStream.schema(schema)
        .parquet(raw)
        .writeStream.foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
