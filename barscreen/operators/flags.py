"""Event flags with three states: true, false, and not known.

Unknown never becomes false on its own. SQL's AND and OR are exactly this logic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barscreen.operators import calendar as cal

EARNINGS_REACH = 1
STALE_AFTER = 126
COMPANY = ("earnings", "ex_dividend", "split", "index_change", "halt")
CALENDAR = (
    "option_expiry", "triple_witching", "month_end", "quarter_end", "half_day",
    "day_after_holiday",
)
MACRO = ("fomc", "cpi", "payrolls")
UNAVAILABLE = ("index_change", "halt")
ALL = (*COMPANY, *CALENDAR, *MACRO)
OBSERVABLE = tuple(f for f in ALL if f not in UNAVAILABLE)
QUARTER_MONTHS = (3, 6, 9, 12)


def reacting_session(announced: DataFrame, sessions: DataFrame, day: str, minute: str) -> DataFrame:
    """`reacted_on`/`reacted_no`: the session that first traded on each announcement.

    `day` is the Eastern date and `minute` the Eastern minute of the day (null: during the
    session). Released before the close, the first session on or after the day reacts, else the
    first after it. News before the first or after the last session reacts nowhere.

    Every day has its session in a table as long as the calendar; an announcement at or after
    the close is moved on by a day first, which makes both cases one lookup by day.
    """
    days = cal.session_days(sessions).toDF("_day", "_on", "_no", "_first")
    half = sessions.where("is_half_day").select(F.col("date").alias(day), F.lit(True).alias("_half"))
    close = cal.close_minute(F.coalesce("_half", F.lit(False)))
    late = F.coalesce(F.col(minute) >= close, F.lit(False))
    moved = F.when(late, F.date_add(day, 1)).otherwise(F.col(day))
    # A late release moved onto the first session came before the calendar begins.
    known = F.col("_on").isNotNull() & ~(F.col("_first") & F.col("_late"))
    return (
        announced.join(F.broadcast(half), day, "left")
        .withColumn("_late", late)
        .withColumn("_day", moved)
        .join(F.broadcast(days), "_day", "left")
        .withColumn("reacted_on", F.when(known, F.col("_on")))
        .withColumn("reacted_no", F.when(known, F.col("_no")))
        .drop("_half", "_late", "_day", "_on", "_no", "_first")
    )


def macro_flags(sessions: DataFrame, releases: DataFrame) -> DataFrame:
    """`fomc, cpi, payrolls` per session: plain true or false, the release calendar being
    complete. `releases`: date, kind, minute_et. An unknown kind is an error."""
    known = F.when(F.col("kind").isin(*MACRO), F.col("kind")).otherwise(
        F.raise_error(F.concat(F.lit("unknown macro kind "), "kind")).cast("string")
    )
    checked = releases.withColumn("kind", known)
    reacted = reacting_session(checked, sessions, "date", "minute_et").where("reacted_on is not null")
    flags = reacted.groupBy(F.col("reacted_on").alias("date")).agg(
        *[F.max(F.col("kind") == kind).alias(kind) for kind in MACRO]
    )
    return sessions.select("date").join(flags, "date", "left").select(
        "date", *[F.coalesce(kind, F.lit(False)).alias(kind) for kind in MACRO]
    )


def _last_session_on_or_before(days: DataFrame, sessions: DataFrame) -> DataFrame:
    """`_on` for days up to the end of the last session's month."""
    until = F.coalesce(F.date_sub("next_date", 1), F.last_day("date"))
    known = cal.gaps_to_next(sessions).select(
        F.explode(F.sequence("date", until)).alias("day"), F.col("date").alias("_on")
    )
    return days.join(F.broadcast(known), "day")


def third_friday(month_start: Column) -> Column:
    """The third Friday of the month that starts here."""
    return F.date_add(month_start, F.pmod(F.lit(4) - F.weekday(month_start), F.lit(7)) + 14)


def option_expiries(sessions: DataFrame) -> DataFrame:
    """The third Friday of each month, or the last session before it within the month."""
    months = sessions.select(F.trunc("date", "month").alias("_month")).distinct()
    fridays = months.withColumn("day", third_friday(F.col("_month")))
    return (
        _last_session_on_or_before(fridays, sessions)
        .where(F.col("_on") >= F.col("_month"))
        .select(F.col("_on").alias("date"))
    )


def weekdays_between(previous: Column, day: Column) -> Column:
    """Weekdays strictly between two dates."""
    days = F.sequence(F.date_add(previous, 1), F.date_sub(day, 1))
    between = F.size(F.filter(days, lambda d: F.weekday(d) < 5))
    return F.when(F.datediff(day, previous) > 1, between).otherwise(0)


def calendar_flags(sessions: DataFrame) -> DataFrame:
    """The calendar's own events per session; unknown at the edge a neighbour is missing at."""
    following = F.lead("date").over(cal.in_order())
    previous = F.lag("date").over(cal.in_order())
    expiry = option_expiries(sessions).withColumn("_expiry", F.lit(True))
    turns = F.month("_following") != F.month("date")
    quarter = F.month("date").isin(*QUARTER_MONTHS)
    return (
        sessions.withColumn("_following", following)
        .withColumn("_previous", previous)
        .join(expiry, "date", "left")
        .select(
            "date",
            F.coalesce("_expiry", F.lit(False)).alias("option_expiry"),
            (F.coalesce("_expiry", F.lit(False)) & quarter).alias("triple_witching"),
            turns.alias("month_end"),
            # Not SQL's AND: an unknown turn stays unknown outside quarter months too.
            F.when(turns.isNotNull(), turns & quarter).alias("quarter_end"),
            F.col("is_half_day").alias("half_day"),
            F.when(
                F.col("_previous").isNotNull(), weekdays_between(F.col("_previous"), F.col("date")) > 0
            ).alias("day_after_holiday"),
        )
    )


def earnings_flags(
    traded: DataFrame, announcements: DataFrame, reach: int = EARNINGS_REACH, stale: int = STALE_AFTER
) -> DataFrame:
    """`earnings` per traded session: within `reach` sessions of an announcement.

    A plain false is asserted only within `stale` sessions of one, on either side; elsewhere
    the record may have stopped and the flag is unknown. Both questions are about the distance
    to the nearest announcement before and after, carried along the security's sessions; nothing
    is multiplied out. `traded`: security_key, date, session_no; `announcements`: security_key,
    session_no (of the reacting session).
    """
    marks = announcements.select("security_key", "session_no").distinct().select(
        "security_key", "session_no", F.lit(None).cast("date").alias("date"),
        F.col("session_no").alias("_mark"),
    )
    rows = traded.select(
        "security_key", "session_no", "date", F.lit(None).cast("int").alias("_mark")
    ).unionByName(marks)
    w = Window.partitionBy("security_key").orderBy("session_no")
    past = F.last("_mark", ignorenulls=True).over(
        w.rangeBetween(Window.unboundedPreceding, 0)
    )
    ahead = F.first("_mark", ignorenulls=True).over(w.rangeBetween(0, Window.unboundedFollowing))
    gap = F.least(F.col("session_no") - F.col("_past"), F.col("_ahead") - F.col("session_no"))
    return (
        rows.withColumn("_past", past)
        .withColumn("_ahead", ahead)
        .where(F.col("date").isNotNull())
        .withColumn("_gap", gap)
        .select(
            "security_key", "date", "session_no",
            F.when(F.col("_gap") <= stale, F.col("_gap") <= reach).alias("earnings"),
        )
    )


def dated_flag(rows: DataFrame, table: DataFrame, column: str, into: str) -> DataFrame:
    """True on a ticker's dated events, false elsewhere."""
    marks = (
        table.where(F.col(column).isNotNull())
        .select("requested_ticker", F.col(column).alias("date"))
        .distinct()
        .withColumn(into, F.lit(True))
    )
    return rows.join(marks, ["requested_ticker", "date"], "left").withColumn(
        into, F.coalesce(into, F.lit(False))
    )


def any_event(flags: tuple[str, ...] = OBSERVABLE) -> Column:
    """True if any is, unknown if any is unknown, else false: a plain SQL OR."""
    return reduce(lambda a, b: a | b, [F.col(f) for f in flags])


def event_table(
    traded: DataFrame,
    sessions: DataFrame,
    announcements: DataFrame,
    dividends: DataFrame,
    splits: DataFrame,
    releases: DataFrame,
) -> DataFrame:
    """One row per security and session with every flag.

    `announcements`: security_key, date, minute_et. Calendar and macro flags are per session and
    broadcast; they are as long as the calendar.
    """
    reacted = reacting_session(announcements, sessions, "date", "minute_et")
    reacted = reacted.where("reacted_no is not null").select(
        "security_key", F.col("reacted_no").alias("session_no")
    )
    numbered = traded.select("security_key", "requested_ticker", "date").join(
        F.broadcast(sessions.select("date", "session_no")), "date"
    )
    earnings = earnings_flags(numbered, reacted).select("security_key", "date", "earnings")
    rows = numbered.drop("session_no").join(earnings, ["security_key", "date"])
    rows = dated_flag(rows, dividends, "ex_dividend_date", "ex_dividend")
    rows = dated_flag(rows, splits, "execution_date", "split")
    shared = calendar_flags(sessions).join(macro_flags(sessions, releases), "date")
    unknown = {f: F.lit(None).cast("boolean") for f in UNAVAILABLE}
    return (
        rows.join(F.broadcast(shared), "date")
        .withColumns(unknown)
        .withColumn("any_event", any_event())
        .select("security_key", "requested_ticker", "date", *ALL, "any_event")
    )
