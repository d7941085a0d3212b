"""Market-shaped inputs derived from the star-schema tables.

The tables hold no prices. A trade is a line item: its price is `l_extendedprice / l_quantity`,
its slot is the line number, its session the week or month it shipped in, and its security the
supplier or the supplier's nation. The formulas are the ones the comparison SQL uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barscreen.functions.orders import by_security
from barscreen.operators import bars as bo
from barscreen.operators import calendar as cal
from barscreen.operators import hourly as hr
from barscreen.schema import nan_to_null

SLOTS = 7


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(f"{sf}/{name}.parquet"))


def trades(spark: SparkSession, sf: str, security: str = "nation", session: str = "week") -> DataFrame:
    """Line items as minute rows with their session and slot.

    `security` is "nation" (25 names) or "supplier" (as many as the data has). The time stamp is
    the ship day plus a clock made of the order and part keys, so that it orders the trades of
    a slot.
    """
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_shipdate",
    )
    if security == "nation":
        # No hint: the planner broadcasts suppliers while they are small and shuffles past that.
        supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
        nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
        names = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        items = items.join(names, F.col("l_suppkey") == F.col("s_suppkey"))
        key = F.col("n_name")
    else:
        key = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    price = F.col("l_extendedprice") / F.col("l_quantity")
    clock = F.pmod(
        F.col("l_orderkey") * 1000 + F.pmod(F.col("l_partkey"), F.lit(1000)),
        F.lit(86_400_000_000),
    )
    # Whole numbers all the way: a micros count is a time stamp as it stands, with no calendar
    # arithmetic per row.
    day = F.col("l_shipdate").cast("date")
    micros = F.unix_date(day).cast("bigint") * 86_400_000_000 + clock
    return items.select(
        key.alias("security_key"),
        key.alias("requested_ticker"),
        key.alias("ticker"),
        F.timestamp_micros(micros).alias("timestamp_utc"),
        (day if session == "day" else F.trunc(day, session)).alias("date"),
        (F.col("l_linenumber") - 1).alias("slot_index"),
        price.alias("open"),
        price.alias("high"),
        price.alias("low"),
        price.alias("close"),
        F.col("l_quantity").alias("volume"),
        F.lit(1).cast("bigint").alias("transactions"),
    )


def trade_count(spark: SparkSession, sf: str) -> int:
    """How many trades there are, from the files' footers: there are at most as many bars with
    trades."""
    return spark.read.parquet(f"{sf}/lineitem.parquet").count()


def is_half_day(date) -> object:
    """Sessions that start in the last week of a year stand in for half days."""
    return (F.month(date) == 12) & (F.dayofmonth(date) >= 24)


def bar_parts(
    spark: SparkSession, sf: str, security: str = "nation", session: str = "week"
) -> DataFrame:
    slotted = (
        trades(spark, sf, security, session)
        .withColumn("is_half_day", is_half_day(F.col("date")))
        .withColumn("open_utc", F.col("date").cast("timestamp_ntz"))
        .withColumn("slots", F.lit(SLOTS))
    )
    return bo.session_parts(slotted, ("is_half_day", "open_utc", "slots"))


def slot_bars(
    spark: SparkSession, sf: str, security: str = "nation", session: str = "week"
) -> DataFrame:
    return bo.hourly_bars(bar_parts(spark, sf, security, session), min_minutes=1)


def day_bars(
    spark: SparkSession, sf: str, security: str = "nation", session: str = "week"
) -> DataFrame:
    """Daily bars straight from the trades: one hash aggregate, one shuffle.

    A security has one name here, so the key alone is grouped by and moved, not three copies.
    """
    bars = (
        trades(spark, sf, security, session)
        .groupBy("security_key", "date")
        .agg(*bo.ohlcv())
        .withColumns({name: F.col("security_key") for name in bo.IDENTITY[1:]})
        .withColumn("is_half_day", is_half_day(F.col("date")))
        .withColumn("timestamp_utc", F.col("date").cast("timestamp_ntz"))
    )
    return bo.with_quality(bars, 1).select(*bo.BAR_COLUMNS)


def bars_with_sessions(spark: SparkSession, sf: str, security: str = "nation", session: str = "week") -> DataFrame:
    """`slot_bars` and, before those of each session, its `day_bars` as a row of `hr.with_sessions`, at
    their security. Trades become slots in each task; the slots move to their security, and the
    grid and the sessions are made there.
    """
    slots = trades(spark, sf, security, session).groupBy("security_key", "date", "slot_index").agg(
        *bo.ohlcv(), F.max(F.when(F.col("close").isNotNull(), F.col("timestamp_utc"))).alias("close_at")
    )
    slots = by_security(slots.drop("transactions"), trade_count(spark, sf) if security == "supplier" else None)
    part = F.struct("slot_index", "open", "high", "low", "close", "volume", "minutes_with_trades")
    sessions = slots.groupBy("security_key", "date").agg(
        F.collect_list(part).alias("_parts"), F.max("high").alias("_high"), F.min("low").alias("_low"),
        F.max_by("close", "close_at").alias("_close"),
    )
    grid = sessions.withColumn("_slots", F.col("_parts")["slot_index"]).withColumn(
        "slot_index", F.explode(F.sequence(F.lit(hr.SESSION), F.lit(SLOTS - 1)))
    )
    # A slot not found has place 0, and there is nothing before the first.
    mine = F.get("_parts", F.array_position("_slots", F.col("slot_index")).cast("int") - 1)
    whole = F.col("slot_index") == hr.SESSION
    stamp = F.timestamp_add("MINUTE", F.col("slot_index") * cal.SLOT_MINUTES, F.col("date").cast("timestamp_ntz"))
    minutes = F.coalesce(F.col("_mine.minutes_with_trades"), F.lit(0))
    return grid.withColumn("_mine", mine).select(
        "security_key", F.col("security_key").alias("requested_ticker"), "date", "slot_index",
        F.when(~whole, stamp).alias("timestamp_utc"), is_half_day(F.col("date")).alias("is_half_day"),
        F.when(~whole, minutes < 1).alias("low_quality"), F.col("_mine.open").alias("open"),
        *[F.when(whole, F.col(f"_{c}")).otherwise(F.col(f"_mine.{c}")).alias(c) for c in ("high", "low", "close")],
        F.when(~whole, F.coalesce(F.col("_mine.volume"), F.lit(0.0))).alias("volume"),
    )


def market_bars(spark: SparkSession, sf: str, session: str = "week") -> tuple[DataFrame, DataFrame]:
    """A benchmark over all securities: the volume-weighted price per slot and per session.

    At most one row a session and slot: bounded by the calendar.
    """
    every = trades(spark, sf, "supplier", session)
    value = F.sum(F.col("close") * F.col("volume")) / F.sum("volume")
    hourly = every.groupBy("date", "slot_index").agg(value.alias("close"))
    daily = every.groupBy("date").agg(value.alias("close"))
    return hourly, daily


def sessions_of(bars: DataFrame) -> DataFrame:
    return cal.session_dimension(bars.select("date", "is_half_day").distinct())


def trade_sessions(spark: SparkSession, sf: str, session: str = "week") -> DataFrame:
    """The sessions with trades, of all suppliers, from the dates alone: no bars are made."""
    day = F.col("l_shipdate").cast("date")
    dates = table(spark, sf, "lineitem").select((day if session == "day" else F.trunc(day, session)).alias("date"))
    return cal.session_dimension(dates.distinct().withColumn("is_half_day", is_half_day(F.col("date"))))


def event_minutes(spark: SparkSession, sf: str) -> DataFrame:
    """The event stream as minute rows: one security a user, stamped to the minute."""
    events = table(spark, sf, "events")
    user = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    return events.select(
        user.alias("security_key"), user.alias("requested_ticker"), user.alias("ticker"),
        F.date_trunc("minute", F.col("ts").cast("timestamp_ntz")).cast("timestamp_ntz").alias(
            "timestamp_utc"
        ),
        F.col("value").alias("open"), F.col("value").alias("high"),
        F.col("value").alias("low"), F.col("value").alias("close"),
        F.lit(1.0).alias("volume"), F.lit(1).cast("bigint").alias("transactions"),
        F.col("event_id").alias("part_order"),
    )


def event_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """The Eastern weekdays with events; Fridays close early."""
    stamp = F.col("ts").cast("timestamp_ntz")
    day = F.convert_timezone(F.lit("UTC"), F.lit(cal.EASTERN), stamp).cast("date")
    dates = table(spark, sf, "events").select(day.alias("date")).distinct()
    dates = dates.where(F.weekday("date") < 5)
    return cal.session_dimension(dates.withColumn("is_half_day", F.weekday("date") == 4))


def order_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Weekday order dates as the market calendar; 24 December and 3 July close early."""
    dates = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    early = ((F.month("date") == 12) & (F.dayofmonth("date") == 24)) | (
        (F.month("date") == 7) & (F.dayofmonth("date") == 3)
    )
    weekdays = dates.distinct().where(F.weekday("date") < 5)
    return cal.session_dimension(weekdays.withColumn("is_half_day", early))


def splits(spark: SparkSession, sf: str) -> DataFrame:
    """Three splits for each supplier with a positive balance, dated from its key."""
    return (
        table(spark, sf, "supplier")
        .where(F.col("s_acctbal") > 0)
        .withColumn("k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
        .select(
            F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker"),
            F.date_add(
                F.lit("1995-06-01").cast("date"), (F.col("k") * 700 + F.col("s_suppkey") % 500).cast("int")
            ).alias("execution_date"),
            (1 + F.col("s_nationkey") % 2).cast("double").alias("split_from"),
            F.pow(F.lit(2.0), F.col("k") + 1).alias("split_to"),
        )
    )
