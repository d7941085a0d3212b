"""One row a ticker with its bars, for measures over many overlapping windows.

A bar lies in the windows of many rebalances. Repeating it once a window multiplies the rows that
are shuffled; here each bar moves once, to its ticker, and the windows are cut out of the ticker's
array where it lies. An array holds at most a bar a session: as long as the calendar. It is in
order of date, so that a window is found by halving and read by itself, not with all the rest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barscreen.functions import trailing as tr


def histories(bars: DataFrame, sessions: DataFrame, fields: list[str]) -> DataFrame:
    """(ticker, _bars): the `fields` (`date` among them) of each ticker's bars on `sessions`, in
    order of date."""
    inner = ["date", *[c for c in fields if c != "date"]]
    known = bars.join(F.broadcast(sessions.select("date").distinct()), "date", "left_semi")
    return known.groupBy("ticker").agg(F.sort_array(F.collect_list(F.struct(*inner))).alias("_bars"))


def month_windows(rebalances: DataFrame, sessions: DataFrame, n: int) -> DataFrame:
    """One row, `_months`: every rebalance with the dates `_from` and `_to` of its last `n`
    sessions. An entry a month of the calendar."""
    numbers = F.broadcast(sessions.select("date", "session_no"))
    inside = F.col("session_no").between(F.col("as_of_no") - n + 1, F.col("as_of_no"))
    spans = rebalances.join(numbers, inside).groupBy(*rebalances.columns).agg(
        F.min("date").alias("_from"), F.max("date").alias("_to")
    )
    return spans.agg(F.collect_list(F.struct(*spans.columns)).alias("_months"))


def by_month(
    rows: DataFrame, months: DataFrame, keep: list[str], of: Callable[[Column], Column],
    only: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """`keep` and the fields of the struct `of(month)` for each row and month (of `only(month)`)."""
    each = rows.crossJoin(F.broadcast(months))
    chosen = F.col("_months") if only is None else F.filter("_months", only)
    return each.select(*keep, F.inline(F.transform(chosen, of)))


def reaches(bars: str, month: Column) -> Column:
    """Whether some of the bars, in order of date, may lie in a month's window: by the first and the last."""
    first, last = F.get(bars, F.lit(0))["date"], F.get(bars, F.size(bars) - 1)["date"]
    return (first <= month["_to"]) & (last >= month["_from"])


def _before(bars: Column, day: Column) -> Column:
    """How many of the bars, in order of date, lie before a day: found by halving steps."""
    steps = F.sequence(F.floor(F.log2(F.size(bars) + 1)).cast("int"), F.lit(0), F.lit(-1))

    def forward(found: Column, step: Column) -> Column:
        further = found + F.call_function("shiftleft", F.lit(1), step)
        # Beyond the last bar there is none, which is not before any day.
        return F.when(F.get(bars, further - 1)["date"] < day, further).otherwise(found)

    return F.aggregate(steps, F.lit(0), forward)


def between(bars: Column | str, first: Column, last: Column) -> Column:
    """Those of the bars, in order of date, that lie in [first, last]."""
    bars = F.col(bars) if isinstance(bars, str) else bars
    ends = F.struct(_before(bars, first).alias("a"), _before(bars, F.date_add(last, 1)).alias("z"))
    return tr.let(ends, lambda e: F.slice(bars, e["a"] + 1, F.greatest(e["z"] - e["a"], F.lit(0))))


def within(bars: Column | str, month: Column) -> Column:
    """The bars of a month's window."""
    return between(bars, month["_from"], month["_to"])


def held_on(day: Column, start: Column, end: Column) -> Column:
    """Whether a day lies in [start, end]; no end is an open one."""
    return (day >= start) & (end.isNull() | (day <= end))


def dates(bars: Column) -> Column:
    return F.array_distinct(bars["date"])


def ordered(bars: Column, value: Callable[[Column], Column]) -> Column:
    """The known values of some bars, sorted."""
    return F.sort_array(F.filter(F.transform(bars, value), lambda v: v.isNotNull()))
