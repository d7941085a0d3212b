"""Vendor and filing JSON already landed on shared storage, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barscreen.operators.calendar import EASTERN
from barscreen.schema import nan_to_null

MINUTES_JSON = (
    "ticker string, requested_ticker string, security_key string, t bigint, o double, h double, "
    "l double, c double, v double, vw double, n bigint"
)
#: The vendor's `t` and `otc` are left out of the schema, and so never read.
GROUPED_JSON = "T string, o double, h double, l double, c double, v double, vw double, n bigint"
SHORT_NAMES = {
    "o": "open", "h": "high", "l": "low", "c": "close", "v": "volume", "vw": "vwap",
    "n": "transactions",
}
DIVIDENDS_JSON = (
    "ticker string, ex_dividend_date date, cash_amount double, dividend_type string, frequency int"
)
FILINGS_JSON = (
    "struct<form:array<string>,accessionNumber:array<string>,filingDate:array<string>,"
    "acceptanceDateTime:array<string>,items:array<string>>"
)


def millis_to_utc(column: str) -> Column:
    return F.timestamp_add(
        "MILLISECOND", F.col(column), F.lit("1970-01-01").cast("timestamp_ntz")
    )


def minute_rows(raw: DataFrame, start=None, end=None) -> DataFrame:
    """Short vendor names to minute rows, with the Eastern date; other dates are dropped."""
    stamp = millis_to_utc("t")
    day = F.convert_timezone(F.lit("UTC"), F.lit(EASTERN), F.col("timestamp_utc")).cast("date")
    named = [F.col(short).alias(name) for short, name in SHORT_NAMES.items()]
    rows = raw.select(
        "ticker", "requested_ticker", "security_key", stamp.alias("timestamp_utc"), *named
    ).withColumn("date_et", day)
    if start is not None:
        rows = rows.where(F.col("date_et").between(F.lit(start), F.lit(end)))
    return nan_to_null(rows)


def read_minutes(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    return minute_rows(spark.read.schema(MINUTES_JSON).json(path), start, end)


def grouped_daily(raw: DataFrame, day) -> DataFrame:
    """One day's whole-market rows, named and stamped with the date."""
    named = [F.col(short).alias(name) for short, name in SHORT_NAMES.items()]
    return nan_to_null(
        raw.select(F.col("T").alias("ticker"), F.lit(day).cast("date").alias("date"), *named)
    )


def read_grouped_daily(spark: SparkSession, path: str, day) -> DataFrame:
    return grouped_daily(spark.read.schema(GROUPED_JSON).json(path), day)


def listed_once(lists: DataFrame) -> DataFrame:
    """A day's ticker list with each ticker once."""
    rest = [c for c in lists.columns if c not in ("ticker", "date")]
    return lists.groupBy("date", "ticker").agg(*[F.min(c).alias(c) for c in rest])


def eight_k_filings(pages: DataFrame, column: str = "filings_json") -> DataFrame:
    """Columnar filing arrays to one row per 8-K. The arrays are one company's own filings."""
    parsed = pages.withColumn("_f", F.from_json(column, FILINGS_JSON))
    keep = [c for c in pages.columns if c != column]
    zipped = F.arrays_zip(
        "_f.form", "_f.accessionNumber", "_f.filingDate", "_f.acceptanceDateTime", "_f.items"
    )
    return (
        parsed.select(*keep, F.explode(zipped).alias("_r"))
        .where(F.col("_r.form") == "8-K")
        .select(
            *keep,
            F.col("_r.accessionNumber").alias("accession_number"),
            F.col("_r.filingDate").cast("date").alias("filing_date"),
            F.col("_r.acceptanceDateTime").alias("accepted_utc"),
            F.coalesce("_r.items", F.lit("")).alias("items"),
        )
    )


def earnings_filings(filings: DataFrame, item: str = "2.02") -> DataFrame:
    return filings.where(F.array_contains(F.split("items", ","), item))


def eastern_clock(accepted_utc: Column) -> tuple[Column, Column]:
    """Eastern date and minute of the day of an ISO instant in UTC."""
    plain = F.regexp_replace(F.regexp_replace(accepted_utc, "T", " "), "Z$", "")
    eastern = F.convert_timezone(F.lit("UTC"), F.lit(EASTERN), plain.cast("timestamp_ntz"))
    return eastern.cast("date"), F.hour(eastern) * 60 + F.minute(eastern)


def corporate_actions(splits: DataFrame, fetched) -> DataFrame:
    """Splits with the price factor derived from the ratio itself.

    The vendor's cumulative factor runs up to today, so it is kept but never used.
    """
    return splits.withColumn(
        "price_factor", F.try_divide(F.col("split_from"), F.col("split_to"))
    ).withColumn("fetched", F.lit(fetched).cast("date"))


def read_dividends(spark: SparkSession, path: str, fetched) -> DataFrame:
    """Landed dividends with the day of the fetch."""
    rows = spark.read.schema(DIVIDENDS_JSON).json(path)
    return nan_to_null(rows.withColumn("fetched", F.lit(fetched).cast("date")))


def changes_table(identities: DataFrame) -> DataFrame:
    """Ticker changes in long form, for storing."""
    return identities.select("requested", "composite_figi", F.inline("changes"))
