"""Joins of dated rows with date intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Days outside these years share the first or last one's bucket.
YEARS = (1990, 2050)


def _year(day: Column) -> Column:
    return F.when(day.isNotNull(), F.greatest(F.least(F.year(day), F.lit(YEARS[1])), F.lit(YEARS[0])))


def _unused(name: str, *tables: DataFrame) -> str:
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name


def by_year(spans: DataFrame, start: str, end: str, year: str) -> DataFrame:
    """A row of a span for each year it touches: at most one a bucket of YEARS. A null start or
    end is open; a span that ends before it starts holds no day."""
    first = F.coalesce(_year(F.col(start)), F.lit(YEARS[0]))
    last = F.coalesce(_year(F.col(end)), F.lit(YEARS[1]))
    return spans.where(first <= last).withColumn(year, F.explode(F.sequence(first, last)))


def interval_join(
    rows: DataFrame, spans: DataFrame, on: tuple[str, str], day: str, start: str, end: str,
    how: str = "left", closed: bool = True,
) -> DataFrame:
    """Rows and the spans of their key that hold their day, by a join on (key, year).

    `on` names the key in `rows` and in `spans`; the day lies in [start, end], or in
    [start, end) if not `closed`. A row meets the spans of its key that touch its own year, not
    all the key ever had, and a key with many rows is spread over its years. Every span that
    holds the day gives a row; a row without one stays with nulls in a left join. A null key or
    day matches nothing.
    """
    year = _unused("_year", rows, spans)
    span_year = _unused("_span_year", rows, spans)
    dated = rows.withColumn(year, _year(F.col(day)))
    cut = by_year(spans, start, end, span_year)
    last = F.col(day) <= F.col(end) if closed else F.col(day) < F.col(end)
    met = (
        (F.col(on[0]) == F.col(on[1]))
        & (F.col(year) == F.col(span_year))
        & (F.col(start).isNull() | (F.col(day) >= F.col(start)))
        & (F.col(end).isNull() | last)
    )
    return dated.join(cut, met, how).drop(year, span_year)
