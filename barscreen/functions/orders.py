"""The orders a security's bars are read in.

A partition holds one bar a session (and slot): bars come out of an aggregate on exactly that
key. It is therefore as long as the calendar and cannot grow with the data. Specs are made on
call because they need a running session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def bar_order() -> WindowSpec:
    return Window.partitionBy("security_key").orderBy("date", "slot_index")


def slot_order() -> WindowSpec:
    """The same slot across sessions."""
    return Window.partitionBy("security_key", "slot_index").orderBy("date")


def day_order() -> WindowSpec:
    return Window.partitionBy("security_key").orderBy("date")


def calendar_order(*columns: str) -> WindowSpec:
    """One sequence over the whole table: only for tables bounded by the calendar."""
    return Window.partitionBy(F.lit(0)).orderBy(*columns)


#: Bars of one partition. A task sorts its partition some ten times on end, so what it holds is
#: many times the bars; this many fit the memory of a core.
BARS_A_TASK = 100_000


def by_security(bars: DataFrame, rows: int | None = None) -> DataFrame:
    """Bars shuffled to their security once; every window and grouped map after it reuses this.

    `rows`, the number of bars, sets the number of partitions, so that they stay as small however
    many bars there are. Without it adaptive execution chooses, by the bytes shuffled.
    """
    if rows is None:
        return bars.repartition("security_key")
    cores = bars.sparkSession.sparkContext.defaultParallelism
    return bars.repartition(max(cores, -(-rows // BARS_A_TASK)), "security_key")
