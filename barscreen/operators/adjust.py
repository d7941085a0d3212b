"""Split adjustment as of a date, applied when bars are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barscreen.operators.intervals import interval_join
from barscreen.schema import require

SPLIT_COLUMNS = ("ticker", "execution_date", "split_from", "split_to")
PRICES = ("open", "high", "low", "close", "vwap")


def newest_fetch(splits: DataFrame) -> DataFrame:
    """Each split once, as the newest fetch recorded it."""
    keys = ["requested_ticker", "execution_date", "split_from", "split_to"]
    rest = [c for c in splits.columns if c not in keys]
    return splits.groupBy(*keys).agg(*[F.max_by(c, "fetched").alias(c) for c in rest])


def split_intervals(splits: DataFrame, as_of) -> DataFrame:
    """Splits known at `as_of`, turned into date intervals with one price factor each.

    A bar dated in [valid_from, valid_to) is multiplied by the product of every ratio executed
    from `valid_to` on. Each bar then matches one interval instead of every later split.
    """
    require(splits, SPLIT_COLUMNS, "splits")
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    positive = (F.col("split_from") > 0) & (F.col("split_to") > 0)
    refused = F.raise_error(F.lit("a split ratio is not positive")).cast("double")
    known = (
        splits.where(F.col("execution_date") <= as_of)
        .withColumn(
            "_one", F.when(positive, F.col("split_from") / F.col("split_to")).otherwise(refused)
        )
        .groupBy("ticker", F.col("execution_date").alias("valid_to"))
        .agg(F.product("_one").alias("_ratio"))
    )
    w = Window.partitionBy("ticker").orderBy("valid_to")
    onward = Window.partitionBy("ticker").orderBy(F.desc("valid_to"))
    factor = F.product("_ratio").over(onward.rowsBetween(Window.unboundedPreceding, 0))
    return known.select(
        "ticker", F.lag("valid_to").over(w).alias("valid_from"), "valid_to",
        factor.alias("price_factor"),
    )


def split_adjust(
    bars: DataFrame, splits: DataFrame, as_of, ticker_column: str = "ticker"
) -> DataFrame:
    """Prices times, and volume divided by, each bar's factor. Dividends are never applied."""
    spans = split_intervals(splits, as_of).withColumnRenamed("ticker", "_split_ticker")
    factor = F.coalesce("price_factor", F.lit(1.0))
    adjusted = {p: F.col(p) * factor for p in PRICES if p in bars.columns}
    adjusted["volume"] = F.col("volume") / factor
    return (
        interval_join(
            bars, spans, (ticker_column, "_split_ticker"), "date", "valid_from", "valid_to", closed=False
        )
        .withColumns(adjusted)
        .drop("_split_ticker", "valid_from", "valid_to", "price_factor")
    )

