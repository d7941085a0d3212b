"""Stored tables: session partitions, write-once parts and snapshots, audit logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barscreen.operators.adjust import split_adjust
from barscreen.schema import nan_to_null

#: Parts up to this size are digested byte by byte.
WHOLE_BYTES = 1 << 30
#: Partitions that securities are dealt out to by hash.
BUCKETS = 64
MANIFEST = "file string, rows bigint, digest string, run_id string"
#: The audit logs and their columns.
LOGS = {
    "ticker_history_gaps": "rebalance_date date, ticker string, composite_figi string, name string, status string, vendor_list_date date",
    "listing_date_discrepancies": "rebalance_date date, ticker string, composite_figi string, name string, vendor_list_date date, first_ticker_event date, listing_date_used date",
    "share_count_problems": "rebalance_date date, shares_date date, ticker string, status string, share_class_shares double, weighted_shares double",
    "multi_class_securities": "rebalance_date date, shares_date date, ticker string, share_class_shares double, weighted_shares double, share_class_fraction double",
    "market_cap_audit": "rebalance_date date, ticker string, our_market_cap double, vendor_market_cap double, ratio double",
    "ticker_stitches": "run_id string, requested_ticker string, composite_figi string, name string, start date, end date, fetched_as string",
}
MACRO_CSV = "date date, kind string, time_et string, source string, note string"
LABELS_JSON = (
    "security_key string, date date, slot_index int, stratum string, weight double, "
    "shown_on date, is_retest boolean, response string, note string, pattern_guess string, "
    "answered_at timestamp"
)


def read_manifests(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(folder)


def _parts(spark: SparkSession, folder: str) -> DataFrame:
    read = spark.read.option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    return read.parquet(folder).select("*", F.col("_metadata.file_path").alias("_file"))


def _row_digests(rows: DataFrame) -> DataFrame:
    """(file, digest) from the rows of a part, whatever its size: two 60-bit pieces of the SHA-256
    of each row added up, so it needs no order and sums up where rows are read."""
    row = F.sha2(F.to_json(F.struct(*[c for c in rows.columns if c != "_file"]), {"ignoreNullFields": "false"}), 256)
    piece = lambda at: F.sum(F.conv(F.substring(row, at, 15), 16, 10).cast("decimal(38,0)"))
    return rows.groupBy(F.col("_file").alias("file")).agg(F.concat_ws("-", F.lit("rows"), piece(1), piece(16)).alias("digest"))


def checksums(spark: SparkSession, folder: str, whole: int = WHOLE_BYTES) -> DataFrame:
    """(file, rows, digest) of every part by its full path: the SHA-256 of its bytes.

    A file is one value of a task here, which Spark bounds at 2 GB: parts of more than `whole`
    bytes get a digest of their rows instead, which tells as much but for bytes outside rows.
    Folders below are read too; parts without rows are listed.
    """
    rows = _parts(spark, folder)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(folder)
    path = F.col("_metadata.file_path").alias("file")
    small = files.where(F.col("length") <= whole).select(path, F.sha2("content", 256).alias("digest"))
    large = files.where(F.col("length") > whole).select(path)
    of_rows = _row_digests(rows.join(F.broadcast(large), F.col("_file") == F.col("file"), "left_semi")) if not large.isEmpty() else None
    digests = small if of_rows is None else small.unionByName(of_rows)
    counts = rows.groupBy(F.col("_file").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    return digests.join(counts, "file", "left").select("file", F.coalesce("rows", F.lit(0)).alias("rows"), "digest")


def write_manifests(spark: SparkSession, parts: str, manifests: str, run_id: str) -> None:
    """Record the rows and checksum of every part."""
    (
        checksums(spark, parts)
        .withColumn("run_id", F.lit(run_id))
        .write.mode("append")
        .json(manifests)
    )


def read_complete_parts(spark: SparkSession, parts: str, manifests: str) -> DataFrame:
    """All parts of a partition that have a manifest; the others are unfinished.

    The query fails if a listed part is absent or differs from its manifest: that costs one more
    pass over the parts.
    """
    rows = _parts(spark, parts)
    listed = read_manifests(spark, manifests).select("file", F.col("digest").alias("_listed"))
    now = checksums(spark, parts).select("file", "digest")
    refused = lambda why: F.raise_error(F.concat(F.lit(why), F.col("file"))).cast("string")
    checked = listed.join(now, "file", "left").select(
        F.when(F.col("digest").isNull(), refused("a listed part is absent: "))
        .when(F.col("digest") != F.col("_listed"), refused("a part has changed: "))
        .otherwise(F.col("file")).alias("_file")
    )
    return nan_to_null(rows.join(checked, "_file", "left_semi").drop("_file"))


def audit_manifests(spark: SparkSession, parts: str, manifests: str) -> DataFrame:
    """Every part against its manifest: ok, changed, orphan (no manifest) or absent (no part).

    Only names and digests are shuffled.
    """
    state = (
        F.when(F.col("digest").isNull(), "orphan")
        .when(F.col("_now").isNull(), "absent")
        .when(F.col("_now") == F.col("digest"), "ok")
        .otherwise("changed")
    )
    known = read_manifests(spark, manifests)
    now = checksums(spark, parts).select("file", F.col("rows").alias("_rows"), F.col("digest").alias("_now"))
    return now.join(known, "file", "full_outer").select(
        "file", F.coalesce("rows", "_rows").alias("rows"), state.alias("state")
    )


def read_dataset(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(f"{root}/{dataset}"))


def read_bars(
    spark: SparkSession, root: str, kind: str, start=None, end=None, splits: DataFrame | None = None,
    as_of=None,
) -> DataFrame:
    """Bars of the sessions wanted: only their partitions are read. Adjusted if asked."""
    bars = read_dataset(spark, root, kind)
    if start is not None:
        bars = bars.where(F.col("date").between(F.lit(start), F.lit(end)))
    return bars if as_of is None else split_adjust(bars, splits, as_of, "requested_ticker")


def write_sessions(df: DataFrame, root: str, kind: str) -> None:
    """Replace exactly the sessions in `df`, leaving the others.

    Rows go to their date first, so a session is written by few tasks; `rebalance` splits a date
    too large for one.
    """
    (
        df.hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(f"{root}/{kind}")
    )


def write_by_security(df: DataFrame, root: str, kind: str, buckets: int = BUCKETS) -> None:
    """Store rows by a hash of their security: a folder a bucket, sorted by security within."""
    bucket = _bucket(F.col("security_key"), buckets)
    rows = df.withColumn("bucket", bucket).repartition(buckets, "bucket").sortWithinPartitions("bucket", "security_key")
    rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/{kind}")


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_batch(spark: SparkSession, root: str, kind: str, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Rows of some securities, stored by `write_by_security` with as many buckets: only the
    folders of their buckets are opened, and row groups without their keys are passed over."""
    wanted = [_bucket(F.lit(k), buckets) for k in keys]
    rows = spark.read.parquet(f"{root}/{kind}")
    return rows.where(F.col("bucket").isin(wanted) & F.col("security_key").isin(keys)).drop("bucket")


def write_snapshots(df: DataFrame, root: str) -> None:
    """Store rebalances, each once; a rebalance that is there already, or that another job is
    writing, is an error and none of `df` is written.

    A rebalance is claimed by creating a file that must not exist: of two jobs the file system
    lets one through. Claims of a job that fails are taken back.
    """
    spark = df.sparkSession
    days = sorted(r[0] for r in df.select(F.col("rebalance_date").cast("string")).distinct().collect())  # one a month
    claimed: list[str] = []
    try:
        for day in days:
            if not _claim(spark, f"{root}/_claims/{day}"):
                raise ValueError(f"snapshots are written once; there already: {day}")
            claimed.append(day)
        df.hint("rebalance", "rebalance_date").write.mode("append").partitionBy("rebalance_date").parquet(root)
    except Exception:
        for day in claimed:
            path, files = _hadoop(spark, f"{root}/_claims/{day}")
            files.delete(path, False)
        raise


def _hadoop(spark: SparkSession, name: str):
    """A path and its file system."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(context._jsc.hadoopConfiguration())


def _claim(spark: SparkSession, name: str) -> bool:
    """Create an empty file; false if it exists."""
    path, files = _hadoop(spark, name)
    files.mkdirs(path.getParent())
    try:
        return files.createNewFile(path)
    except Exception as error:  # some file systems refuse instead of returning false
        if files.exists(path):
            return False
        raise error


def write_actions(df: DataFrame, root: str, kind: str) -> None:
    """Add a fetch of splits, dividends or ticker events under its day; a fetch repeated the
    same day replaces its own partition only."""
    out = df.hint("rebalance", "fetched").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy("fetched").parquet(f"{root}/{kind}")


def set_aside(spark: SparkSession, root: str, rebalance_date: str, run_id: str) -> None:
    """Keep a superseded snapshot under its run before it is rebuilt."""
    old = spark.read.parquet(f"{root}/rebalance_date={rebalance_date}")
    old.write.mode("errorifexists").parquet(
        f"{root}_superseded/run_id={run_id}/rebalance_date={rebalance_date}"
    )


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", True).csv(path)


def append_audit(df: DataFrame, root: str, kind: str) -> None:
    """Add rows to one of the LOGS; columns the rows lack are empty, others are left out."""
    fields = StructType.fromDDL(LOGS[kind])
    rows = df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields
    ])
    append_log(rows, f"{root}/logs/{kind}")


def read_audit(spark: SparkSession, root: str, kind: str) -> DataFrame:
    return spark.read.schema(LOGS[kind]).option("header", True).csv(f"{root}/logs/{kind}")


def read_macro_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MACRO_CSV).option("header", True).csv(path)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LABELS_JSON).json(path)


def append_labels(labels: DataFrame, path: str) -> None:
    labels.write.mode("append").json(path)


def with_prices(features: DataFrame, bars: DataFrame) -> DataFrame:
    """Stored features with the bar prices screens and exits need."""
    prices = bars.select("security_key", "date", "slot_index", "open", "high", "low", "close")
    return features.join(prices, ["security_key", "date", "slot_index"], "left")


#: Rows of one partition of a comparison with what is stored.
ROWS_A_TASK = 500_000


def new_rows(fetched: DataFrame, covered: DataFrame, rows: int | None = None) -> DataFrame:
    """Fetched minute rows of securities not yet stored for their day.

    `rows`, the number fetched, sets the number of partitions, so that a task holds no more of a
    larger table; a manifest of the result reuses them.
    """
    keys = ["security_key", "date_et"]
    stored = covered.select(*keys)
    if rows is not None:
        parts = -(-rows // ROWS_A_TASK) or 1
        fetched, stored = fetched.repartition(parts, *keys), stored.repartition(parts, *keys)
    return fetched.join(stored.distinct(), keys, "left_anti")


def day_manifest(rows: DataFrame) -> DataFrame:
    """Per day and security: bars and the tickers they came under."""
    per = rows.groupBy("date_et", "security_key", "ticker").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("date_et", "security_key").agg(
        F.sum("n").alias("bars"),
        F.concat_ws(",", F.sort_array(F.collect_list("ticker"))).alias("tickers_used"),
    )


def with_provenance(rows: DataFrame, **stamps: str) -> DataFrame:
    """Rows of a scan report, each carrying where it came from."""
    return rows.withColumns({name: F.lit(value) for name, value in stamps.items()})


def write_report(rows: DataFrame, path: str, **stamps: str) -> None:
    with_provenance(rows, **stamps).write.mode("overwrite").json(path)
