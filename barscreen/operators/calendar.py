"""The session dimension and the questions asked of it.

One row a session: `date, session_no, is_half_day`. Its size is the length of the calendar (a
few thousand rows a decade) whatever the data holds, so it may be broadcast.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values, in minutes of the day, Eastern time.
OPEN_MINUTE = 9 * 60 + 30
CLOSE_MINUTE = 16 * 60
HALF_DAY_CLOSE_MINUTE = 13 * 60
SLOT_MINUTES = 60
EASTERN = "America/New_York"


def session_dimension(dates: DataFrame) -> DataFrame:
    """Number the distinct sessions in `dates` (`date`, optional `is_half_day`) in order.

    The single-task sort is over distinct dates only, so it stays as long as the calendar.
    """
    half = F.max("is_half_day") if "is_half_day" in dates.columns else F.lit(False)
    distinct = dates.groupBy("date").agg(F.coalesce(half, F.lit(False)).alias("is_half_day"))
    number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("date"))
    return distinct.select("date", (number - 1).alias("session_no"), "is_half_day")


def in_order() -> Window:
    return Window.partitionBy(F.lit(0)).orderBy("session_no")


def sessions_between(sessions: DataFrame, start, end) -> DataFrame:
    return sessions.where(F.col("date").between(F.lit(start), F.lit(end)))


def with_is_session(days: DataFrame, sessions: DataFrame, column: str = "date") -> DataFrame:
    marks = F.broadcast(sessions.select(F.col("date").alias(column), F.lit(True).alias("_s")))
    return days.join(marks, column, "left").select(
        *days.columns, F.coalesce("_s", F.lit(False)).alias("is_session")
    )


def gaps_to_next(sessions: DataFrame) -> DataFrame:
    """Each session with the next one: the calendar cut into [date, next_date) intervals."""
    return sessions.withColumn("next_date", F.lead("date").over(in_order()))


def with_previous_session(
    days: DataFrame, sessions: DataFrame, column: str = "date", into: str = "previous_session"
) -> DataFrame:
    """The last session strictly before each day, whether or not the day is a session."""
    spans = gaps_to_next(sessions).where("next_date is not null")
    known = spans.select(
        F.explode(F.sequence(F.date_add("date", 1), F.col("next_date"))).alias(column),
        F.col("date").alias("_on"),
    )
    last = F.broadcast(sessions.agg(F.max("date").alias("_last")))  # one row
    found = F.coalesce("_on", F.when(F.col(column) > F.col("_last"), F.col("_last")))
    return (
        days.join(F.broadcast(known), column, "left").crossJoin(last)
        .select(*days.columns, found.alias(into))
    )


def session_days(sessions: DataFrame) -> DataFrame:
    """Every day up to the last session with the session that first trades on or after it:
    `day, on, session_no, is_first`. At most one row a calendar day; days before the first
    session are left out."""
    previous = F.lag("date").over(in_order())
    start = F.coalesce(F.date_add(previous, 1), F.col("date"))
    return sessions.withColumn("_from", start).withColumn("is_first", previous.isNull()).select(
        F.explode(F.sequence("_from", "date")).alias("day"), F.col("date").alias("on"), "session_no", "is_first"
    )


def sessions_ending(sessions: DataFrame, day, count: int) -> DataFrame:
    """The `count` sessions up to and including `day`. The query fails if `day` is no session or
    fewer sessions precede it."""
    found = sessions.where(F.col("date") == F.lit(day)).agg(F.max("session_no").alias("_last"))
    checked = (
        F.when(F.col("_last").isNull(), F.raise_error(F.lit(f"{day} is no session")).cast("int"))
        .when(F.col("_last") < count - 1, F.raise_error(F.lit(f"fewer than {count} sessions up to {day}")).cast("int"))
        .otherwise(F.col("_last"))
    )
    last = F.broadcast(found.select(checked.alias("_last")))  # one row
    number = F.col("session_no")
    inside = number.between(F.col("_last") - count + 1, F.col("_last"))
    return sessions.join(last, inside, "inner").drop("_last")


def close_minute(is_half_day: Column) -> Column:
    return F.when(is_half_day, HALF_DAY_CLOSE_MINUTE).otherwise(CLOSE_MINUTE)


def at_minute(date: Column, minute: Column) -> Column:
    """The UTC wall clock of an Eastern minute of the day."""
    eastern = F.timestamp_add("MINUTE", minute, date.cast("timestamp_ntz"))
    return F.convert_timezone(F.lit(EASTERN), F.lit("UTC"), eastern)


def with_bounds(sessions: DataFrame) -> DataFrame:
    """Each session's open and close in UTC, and how many slots it has."""
    close = close_minute(F.col("is_half_day"))
    slots = F.ceil((close - OPEN_MINUTE) / SLOT_MINUTES).cast("int")
    return sessions.select(
        *sessions.columns,
        at_minute(F.col("date"), F.lit(OPEN_MINUTE)).alias("open_utc"),
        at_minute(F.col("date"), close).alias("close_utc"),
        slots.alias("slots"),
    )


def session_slots(sessions: DataFrame) -> DataFrame:
    """One row a slot: 60-minute slots from the open, the last one a stub."""
    close = close_minute(F.col("is_half_day"))
    start = F.col("slot_index") * SLOT_MINUTES + OPEN_MINUTE
    return (
        with_bounds(sessions)
        .withColumn("slot_index", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
        .withColumn(
            "slot_minutes", F.least(F.lit(SLOT_MINUTES), close - start).cast("int")
        )
        .withColumn("slot_start_utc", at_minute(F.col("date"), start))
        .drop("slots")
    )


def rebalance_dates(sessions: DataFrame) -> DataFrame:
    """The first session of each month, with the session before it.

    A first session with nothing before it cannot be known to be one, and is left out.
    """
    previous = F.lag("date").over(in_order())
    return (
        sessions.withColumn("as_of_session", previous)
        .withColumn("as_of_no", F.col("session_no") - 1)
        .where(F.trunc("as_of_session", "month") != F.trunc("date", "month"))
        .withColumnRenamed("date", "rebalance_date")
        .drop("is_half_day")
    )


def months_in(spark, first: dt.date, last: dt.date) -> DataFrame:
    """The first day of each month from `first` to `last`."""
    months = F.sequence(
        F.trunc(F.lit(first), "month"), F.trunc(F.lit(last), "month"), F.expr("interval 1 month")
    )
    return spark.range(1).select(F.explode(months).alias("month"))


def month_ends(months: DataFrame, sessions: DataFrame, today) -> DataFrame:
    """The last session before each month and before the one after, where already past."""
    starts = months.select("month").union(months.select(F.add_months("month", 1))).distinct()
    return (
        with_previous_session(starts, sessions, "month", "month_end")
        .where(F.col("month_end") < F.lit(today))
        .select("month_end")
        .distinct()
    )


def share_count_date(as_of: Column, lag_days: int = 105) -> Column:
    """The date share counts are asked for: a fixed lag before the as-of session."""
    return F.date_sub(as_of, lag_days)


def every_nth(sessions: DataFrame, n: int) -> DataFrame:
    """Every n-th session, from the first."""
    position = F.row_number().over(in_order()) - 1
    return sessions.withColumn("_p", position).where(F.col("_p") % n == 0).drop("_p")


def evenly_spaced(df: DataFrame, group: list[str], order: list, count: int) -> DataFrame:
    """`count` rows of each group spread evenly through its order; all if there are fewer.

    For groups bounded by the calendar or an audit log.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    whole = Window.partitionBy(*group)
    marked = df.withColumn("_p", F.row_number().over(w) - 1).withColumn(
        "_n", F.count(F.lit(1)).over(whole)
    )
    # Row p is kept where floor(i * n / count) = p for some i.
    step = F.col("_n") / F.lit(float(count))
    nearest = F.ceil(F.col("_p") / step)
    wanted = (nearest < count) & (F.floor(nearest * step) == F.col("_p"))
    return marked.where((F.col("_n") <= count) | wanted).drop("_p", "_n")


def stored_sessions(bars: DataFrame) -> DataFrame:
    """The dates that have bars. On a `date=` partitioned table only partition names are read."""
    return bars.select("date").distinct()


def latest_session(bars: DataFrame) -> DataFrame:
    return bars.agg(F.max("date").alias("date"))


def half_days_in(bars: DataFrame) -> DataFrame:
    return (
        bars.groupBy("date")
        .agg(F.max("is_half_day").alias("is_half_day"))
        .where("is_half_day")
        .select("date")
    )
