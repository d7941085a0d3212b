"""Column checks and null hygiene shared by every operator."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require(df: DataFrame, columns: Iterable[str], what: str = "table") -> DataFrame:
    """Fail at plan time, naming the columns that are absent."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks columns: {missing}")
    return df


def nan_to_null(df: DataFrame) -> DataFrame:
    """Every floating NaN becomes null.

    In Spark NaN compares greater than any number, so a missing price left as NaN would pass
    "at least" tests. Called at each scan.
    """
    floating = {
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.select(
        *[
            F.when(~F.isnan(name), F.col(name)).alias(name) if name in floating else F.col(name)
            for name in df.columns
        ]
    )


def decided(condition: Column) -> Column:
    """A plain true or false: unknown is not a pass."""
    return F.coalesce(condition, F.lit(False))


def at_least(value: Column, limit) -> Column:
    return decided(value >= limit)


def at_most(value: Column, limit) -> Column:
    return decided(value <= limit)


def ratio(part: Column, whole: Column) -> Column:
    """`part / whole` where the whole is positive, else unknown."""
    return F.when(whole > 0, F.try_divide(part, whole))


def security_key(figi: Column, ticker: Column) -> Column:
    """The permanent identifier, or `TICKER:<symbol>` where there is none."""
    return F.coalesce(F.nullif(figi, F.lit("")), F.concat(F.lit("TICKER:"), ticker))


def alone(column: str) -> Column:
    """The column, by a lambda over one element. Spark puts the steps of a stage into one method,
    and the JVM never compiles one of more than 8,000 bytes; a projection with a lambda is compiled
    by itself, in small methods."""
    return F.get(F.transform(F.array(column), lambda v: v), F.lit(0)).alias(column)
