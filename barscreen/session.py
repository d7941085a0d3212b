"""Spark session defaults, and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Settings every job wants. Shuffle partitions are left to AQE: it coalesces small ones and
#: splits skewed ones, so one setting serves a laptop and a cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Bars stay partitioned by security through windows, so a join on (security, date) can use
    # that partitioning instead of shuffling both sides again.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "barscreen", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in `spark.checkpoint.dir`, and must: a folder of one machine is made only
    where all tasks run in this process (tests, a laptop).
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: what follows restarts from files, not from the whole plan.

    For results several branches read, so that they are computed once and survive the loss of
    an executor.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
