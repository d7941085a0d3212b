"""Minutes to session-anchored bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barscreen.operators import calendar as cal
from barscreen.schema import require

MINUTE_COLUMNS = (
    "security_key", "requested_ticker", "ticker", "timestamp_utc",
    "open", "high", "low", "close", "volume", "transactions",
)
BAR_COLUMNS = (
    "security_key", "requested_ticker", "ticker", "date", "timestamp_utc", "is_half_day",
    "open", "high", "low", "close", "volume", "transactions", "minutes_with_trades",
    "low_quality",
)
MIN_MINUTES = 5
IDENTITY = ("security_key", "requested_ticker", "ticker")


def first_per_minute(minutes: DataFrame, part_order: str) -> DataFrame:
    """One row per security and minute: the one that comes first in part order.

    `min_by` is combined before the shuffle, so repeated copies of a hot minute shrink to one
    row a task, unlike a window or `dropDuplicates` (which would keep any copy).
    """
    require(minutes, (*MINUTE_COLUMNS, part_order), "minutes")
    keys = ["security_key", "timestamp_utc"]
    rest = [c for c in minutes.columns if c not in keys]
    return minutes.groupBy(*keys).agg(*[F.min_by(c, part_order).alias(c) for c in rest])


def with_slot(minutes: DataFrame, sessions: DataFrame) -> DataFrame:
    """Add the session `date` and `slot_index`; the slot is null outside regular hours.

    The join is against the calendar, which is bounded and broadcast.
    """
    require(minutes, MINUTE_COLUMNS, "minutes")
    bounds = F.broadcast(
        cal.with_bounds(sessions).select("date", "is_half_day", "open_utc", "close_utc", "slots")
    )
    eastern = F.convert_timezone(F.lit("UTC"), F.lit(cal.EASTERN), F.col("timestamp_utc"))
    ts = F.col("timestamp_utc")
    elapsed = F.timestamp_diff("SECOND", F.col("open_utc"), ts)
    slot = F.floor(elapsed / (cal.SLOT_MINUTES * 60)).cast("int")
    regular = (ts >= F.col("open_utc")) & (ts < F.col("close_utc"))
    return (
        minutes.withColumn("date", eastern.cast("date"))
        .join(bounds, "date", "inner")
        .withColumn("slot_index", F.when(regular, slot))
        .drop("close_utc")
    )


def identities(slotted: DataFrame) -> DataFrame:
    """(security, symbol, session) of all minutes, inside and outside trading hours alike."""
    return slotted.select(*IDENTITY, "date").distinct()


def ohlcv() -> list[Column]:
    """Open/high/low/close/volume of a group of minutes.

    `min_by`/`max_by` on a primitive time keep the hash aggregate with map-side combine; a null
    price is skipped, as its order is null.
    """
    return [
        F.min_by("open", F.when(F.col("open").isNotNull(), F.col("timestamp_utc"))).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", F.when(F.col("close").isNotNull(), F.col("timestamp_utc"))).alias(
            "close"
        ),
        F.sum("volume").alias("volume"),
        F.sum("transactions").alias("transactions"),
        F.count(F.lit(1)).alias("minutes_with_trades"),
    ]


def session_parts(slotted: DataFrame, per_session: tuple[str, ...] = ()) -> DataFrame:
    """One row per security and session holding its slots' aggregates.

    The minutes are read and shuffled once: the hot step is a hash aggregate to (security,
    symbol, session, slot), already reduced in each task. What is collected after it is at most
    one entry a slot and symbol, so a security with a third of all minutes is no larger here
    than any other.
    """
    keys = [*IDENTITY, "date", *per_session]
    slots = slotted.groupBy(*keys, "slot_index").agg(
        *ohlcv(),
        F.min(F.when(F.col("open").isNotNull(), F.col("timestamp_utc"))).alias("open_at"),
        F.max(F.when(F.col("close").isNotNull(), F.col("timestamp_utc"))).alias("close_at"),
    )
    part = F.struct(
        "slot_index", "open_at", "open", "high", "low", "close_at", "close", "volume",
        "transactions", "minutes_with_trades",
    )
    return slots.groupBy("security_key", "date", *per_session).agg(
        F.collect_set(F.struct("requested_ticker", "ticker")).alias("names"),
        F.collect_list(F.when(F.col("slot_index").isNotNull(), part)).alias("parts"),
    )


def _merged(parts: Column) -> list[Column]:
    """One bar from slot aggregates; nulls and zeros where there are none."""

    def known(field: str) -> Column:
        return F.filter(parts, lambda p: p[field].isNotNull())

    def total(field: str, kind: str) -> Column:
        return F.aggregate(
            parts, F.lit(0).cast(kind), lambda a, p: a + F.coalesce(p[field], F.lit(0).cast(kind))
        )

    first = F.array_min(F.transform(known("open"), lambda p: F.struct(p["open_at"], p["open"])))
    last = F.array_max(F.transform(known("close"), lambda p: F.struct(p["close_at"], p["close"])))
    return [
        first["open"].alias("open"),
        F.array_max(F.transform(parts, lambda p: p["high"])).alias("high"),
        F.array_min(F.transform(parts, lambda p: p["low"])).alias("low"),
        last["close"].alias("close"),
        total("volume", "double").alias("volume"),
        total("transactions", "bigint").alias("transactions"),
        total("minutes_with_trades", "bigint").alias("minutes_with_trades"),
    ]


def _named(parts: DataFrame) -> DataFrame:
    return parts.withColumn("_name", F.explode("names")).select(
        "*", "_name.requested_ticker", "_name.ticker"
    )


def hourly_bars(parts: DataFrame, min_minutes: int = MIN_MINUTES) -> DataFrame:
    """The complete grid: every security of a session gets every slot, traded or not.

    `parts` needs `slots`, `is_half_day` and `open_utc` per session.
    """
    grid = (
        _named(parts)
        .withColumn("slot_index", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
        .withColumn(
            "_mine", F.filter("parts", lambda p: p["slot_index"] == F.col("slot_index"))
        )
    )
    start = F.col("slot_index") * cal.SLOT_MINUTES + cal.OPEN_MINUTE
    minutes = F.least(
        F.lit(cal.SLOT_MINUTES), cal.close_minute(F.col("is_half_day")) - start
    ).cast("int")
    stamp = F.timestamp_add("MINUTE", F.col("slot_index") * cal.SLOT_MINUTES, F.col("open_utc"))
    bars = grid.select(
        *IDENTITY, "date", stamp.alias("timestamp_utc"), "is_half_day", "slot_index",
        minutes.alias("slot_minutes"), *_merged(F.col("_mine")),
    )
    return with_quality(bars, min_minutes).select(*BAR_COLUMNS, "slot_index", "slot_minutes")


def daily_bars(parts: DataFrame, min_minutes: int = MIN_MINUTES) -> DataFrame:
    """One bar per security and session from regular hours only."""
    bars = _named(parts).select(
        *IDENTITY, "date", F.col("open_utc").alias("timestamp_utc"), "is_half_day",
        *_merged(F.col("parts")),
    )
    return with_quality(bars, min_minutes).select(*BAR_COLUMNS)


def with_quality(bars: DataFrame, min_minutes: int = MIN_MINUTES) -> DataFrame:
    """Missing counts become zero; few minutes with trades marks a bar low quality."""
    filled = bars.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(0))
            for name in ("volume", "transactions", "minutes_with_trades")
        }
    )
    return filled.withColumn("low_quality", F.col("minutes_with_trades") < min_minutes)


def partial_day(hourly: DataFrame, judged: DataFrame) -> DataFrame:
    """The session so far as one bar, up to each judged bar's slot.

    `judged` holds (security_key, date, judged_slot). At most a session's slots per judged bar.
    """
    far = hourly.join(judged, ["security_key", "date"]).where(
        F.col("slot_index") <= F.col("judged_slot")
    )
    return far.groupBy("security_key", "date", "judged_slot").agg(
        F.min_by("open", "slot_index").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "slot_index").alias("close"),
        F.sum("volume").alias("volume"),
    )
