"""Calendar, bar and adjustment queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from barscreen.operators import adjust
from barscreen.operators import bars as bo
from barscreen.operators import calendar as cal
from barscreen.plans import adapters as ad
from barscreen.plans.catalog import base as b
from barscreen.plans.catalog.base import query, select, tidy

# --- the calendar -------------------------------------------------------------


@query(select(b.SESSIONS, "sessions", "date session_no is_half_day"))
def sessions(spark, sf):
    return ad.order_sessions(spark, sf)


@query(
    select(
        b.SESSIONS + """, shipped AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem)""",
        """(SELECT h.date, s.date IS NOT NULL AS is_session,
             (SELECT max(p.date) FROM sessions p WHERE p.date < h.date) AS previous_session
           FROM shipped h LEFT JOIN sessions s USING (date))""",
        "date is_session previous_session",
    )
)
def session_lookup(spark, sf):
    days = ad.table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("date"))
    known = ad.order_sessions(spark, sf)
    return cal.with_previous_session(cal.with_is_session(days.distinct(), known), known)


@query(select(b.SESSIONS, "sessions", "date session_no", tail="WHERE date BETWEEN DATE '1996-03-01' AND DATE '1997-02-28'"))
def sessions_in_range(spark, sf):
    known = cal.sessions_between(ad.order_sessions(spark, sf), dt.date(1996, 3, 1), dt.date(1997, 2, 28))
    return known.select("date", "session_no")


@query("SELECT max(CAST(date_trunc('week', l_shipdate) AS DATE)) AS date FROM lineitem")
def latest_session(spark, sf):
    return cal.latest_session(ad.trades(spark, sf, "supplier", "week"))


EVENT_SESSIONS = """esessions AS (SELECT date, CAST(row_number() OVER (ORDER BY date) - 1 AS INTEGER)
    AS session_no, isodow(date) = 5 AS is_half_day
  FROM (SELECT DISTINCT CAST(ts - INTERVAL 5 HOUR AS DATE) AS date FROM events) WHERE isodow(date) < 6),
eslots AS (SELECT date, session_no, is_half_day, CAST(i AS INTEGER) AS slot_index,
    CAST(least(60, (CASE WHEN is_half_day THEN 780 ELSE 960 END) - 570 - 60 * i) AS INTEGER) AS slot_minutes,
    CAST(date AS TIMESTAMP) + to_minutes(570 + 60 * i) + INTERVAL 5 HOUR AS slot_start_utc,
    CAST(date AS TIMESTAMP) + to_minutes(570) + INTERVAL 5 HOUR AS open_utc,
    CAST(date AS TIMESTAMP) + to_minutes(CASE WHEN is_half_day THEN 780 ELSE 960 END) + INTERVAL 5 HOUR AS close_utc
  FROM esessions, (SELECT unnest([0, 1, 2, 3, 4, 5, 6]) AS i) WHERE NOT is_half_day OR i < 4)"""


@query(select(EVENT_SESSIONS, "eslots", "date is_half_day slot_index slot_minutes slot_start_utc open_utc close_utc"))
def session_slots(spark, sf):
    return cal.session_slots(ad.event_sessions(spark, sf)).drop("session_no")


@query(
    select(
        b.SESSIONS,
        """(SELECT date AS rebalance_date, p AS as_of_session, session_no - 1 AS as_of_no,
             p - 105 AS share_count_date
           FROM (SELECT *, lag(date) OVER (ORDER BY date) AS p FROM sessions)
           WHERE month(p) <> month(date) OR year(p) <> year(date))""",
        "rebalance_date as_of_session as_of_no share_count_date",
    )
)
def rebalance_dates(spark, sf):
    found = cal.rebalance_dates(ad.order_sessions(spark, sf)).drop("session_no")
    return found.withColumn("share_count_date", cal.share_count_date(F.col("as_of_session")))


@query(
    select(
        b.SESSIONS,
        """(SELECT DISTINCT (SELECT max(date) FROM sessions s WHERE s.date < m) AS month_end
           FROM (SELECT CAST(unnest(generate_series(DATE '1996-01-01', DATE '1999-01-01', INTERVAL 1 MONTH)) AS DATE) AS m))""",
        "month_end",
        tail="WHERE month_end < DATE '1998-11-15'",
    )
)
def month_ends(spark, sf):
    months = cal.months_in(spark, dt.date(1996, 1, 1), dt.date(1998, 12, 1))
    return cal.month_ends(months, ad.order_sessions(spark, sf), dt.date(1998, 11, 15))


@query(
    select(
        b.SESSIONS,
        """sessions, (SELECT session_no AS n FROM sessions WHERE date = DATE '1998-06-15')""",
        "date session_no",
        tail="WHERE session_no BETWEEN n - 59 AND n",
    )
)
def sessions_ending(spark, sf):
    return cal.sessions_ending(ad.order_sessions(spark, sf), dt.date(1998, 6, 15), 60).drop("is_half_day")


@query(
    f"""WITH {b.SESSIONS},
picked AS (SELECT 'every_25th' AS rule, date FROM sessions WHERE session_no % 25 = 0),
nation_orders AS (SELECT DISTINCT c_nationkey, CAST(o_orderdate AS DATE) AS date
  FROM orders JOIN customer ON o_custkey = c_custkey),
placed AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY date) - 1 AS p,
  count(*) OVER (PARTITION BY c_nationkey) AS n FROM nation_orders),
spaced AS (SELECT c_nationkey, date FROM placed WHERE n <= 15 OR p IN (
  SELECT CAST(floor(i * (n / 15.0)) AS BIGINT) FROM (SELECT unnest(range(15)) AS i)))
SELECT rule, CAST(NULL AS INTEGER) AS c_nationkey, date FROM picked
UNION ALL SELECT 'fifteen_each', c_nationkey, date FROM spaced"""
)
def even_sampling(spark, sf):
    every = cal.every_nth(ad.order_sessions(spark, sf), 25).select(
        F.lit("every_25th").alias("rule"), F.lit(None).cast("int").alias("c_nationkey"), "date"
    )
    orders = ad.table(spark, sf, "orders").join(
        ad.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    days = orders.select("c_nationkey", F.col("o_orderdate").cast("date").alias("date")).distinct()
    spaced = cal.evenly_spaced(days, ["c_nationkey"], ["date"], 15)
    return every.unionByName(
        spaced.select(F.lit("fifteen_each").alias("rule"), "c_nationkey", "date")
    )


@query(
    f"""WITH {b.days('supplier', 'day')}
SELECT count(DISTINCT date) AS sessions, max(date) AS latest,
  count(DISTINCT CASE WHEN is_half_day THEN date END) AS half_days FROM days"""
)
def stored_sessions(spark, sf):
    bars = ad.day_bars(spark, sf, "supplier", "day").select("date", "is_half_day")
    half = cal.half_days_in(bars).agg(F.count(F.lit(1)).alias("half_days"))
    return (
        cal.stored_sessions(bars)
        .agg(F.count(F.lit(1)).alias("sessions"), F.max("date").alias("latest"))
        .crossJoin(half)
    )


# --- minutes to bars ----------------------------------------------------------

MINUTES = """minutes AS (SELECT 'U' || user_id AS security_key, date_trunc('minute', ts) AS timestamp_utc,
    arg_min(value, event_id) AS value FROM events GROUP BY 1, 2)"""
SLOTTED = """slotted AS (SELECT m.*, s.date, s.is_half_day,
    CASE WHEN m.timestamp_utc >= open_utc AND m.timestamp_utc < close_utc
      THEN CAST(floor(date_diff('second', open_utc, m.timestamp_utc) / 3600.0) AS INTEGER) END AS slot_index
  FROM minutes m JOIN (SELECT DISTINCT date, is_half_day, open_utc, close_utc FROM eslots) s
  ON CAST(m.timestamp_utc - INTERVAL 5 HOUR AS DATE) = s.date)"""
EVENT_OHLC = """arg_min(value, timestamp_utc) AS open, max(value) AS high, min(value) AS low,
    arg_max(value, timestamp_utc) AS close, CAST(count(*) AS DOUBLE) AS volume, count(*) AS minutes_with_trades"""


def _slotted(spark, sf):
    minutes = bo.first_per_minute(ad.event_minutes(spark, sf), "part_order")
    return bo.with_slot(minutes, ad.event_sessions(spark, sf))


@query(select(MINUTES, "minutes", "security_key timestamp_utc", "value"))
def minute_dedup(spark, sf):
    kept = bo.first_per_minute(ad.event_minutes(spark, sf), "part_order")
    return tidy(kept.select("security_key", "timestamp_utc", F.col("close").alias("value")))


@query(select(b.chain(EVENT_SESSIONS, MINUTES, SLOTTED), "(SELECT DISTINCT security_key, date FROM slotted)", "security_key date"))
def session_identities(spark, sf):
    return bo.identities(_slotted(spark, sf)).select("security_key", "date")


@query(
    select(
        b.chain(EVENT_SESSIONS, MINUTES, SLOTTED),
        f"""(SELECT i.security_key, i.date, e.slot_index, e.slot_minutes, e.slot_start_utc AS timestamp_utc,
              e.is_half_day, open, high, low, close, coalesce(volume, 0) AS volume,
              coalesce(minutes_with_trades, 0) AS minutes_with_trades,
              coalesce(minutes_with_trades, 0) < 2 AS low_quality
            FROM (SELECT DISTINCT security_key, date FROM slotted) i JOIN eslots e USING (date)
            LEFT JOIN (SELECT security_key, date, slot_index, {EVENT_OHLC} FROM slotted
              WHERE slot_index IS NOT NULL GROUP BY ALL) a USING (security_key, date, slot_index))""",
        "security_key date slot_index slot_minutes timestamp_utc is_half_day minutes_with_trades low_quality",
        "open high low close volume",
    )
)
def session_hourly_bars(spark, sf):
    parts = bo.session_parts(_slotted(spark, sf), ("is_half_day", "open_utc", "slots"))
    return tidy(bo.hourly_bars(parts, min_minutes=2)).drop("requested_ticker", "ticker", "transactions")


@query(
    select(
        b.chain(EVENT_SESSIONS, MINUTES, SLOTTED),
        f"""(SELECT i.security_key, i.date, open, high, low, close, coalesce(volume, 0) AS volume,
              coalesce(minutes_with_trades, 0) AS minutes_with_trades,
              coalesce(minutes_with_trades, 0) < 5 AS low_quality
            FROM (SELECT DISTINCT security_key, date FROM slotted) i
            LEFT JOIN (SELECT security_key, date, {EVENT_OHLC} FROM slotted
              WHERE slot_index IS NOT NULL GROUP BY ALL) a USING (security_key, date))""",
        "security_key date minutes_with_trades low_quality",
        "open high low close volume",
    )
)
def session_daily_bars(spark, sf):
    parts = bo.session_parts(_slotted(spark, sf), ("is_half_day", "open_utc", "slots"))
    return tidy(
        bo.daily_bars(parts), "security_key", "date", "minutes_with_trades", "low_quality",
        "open", "high", "low", "close", "volume",
    )


@query(
    select(
        b.bars(),
        "bars",
        "security_key date slot_index is_half_day low_quality transactions open high low close volume",
    )
)
def slot_bars(spark, sf):
    return ad.slot_bars(spark, sf).select(
        "security_key", "date", "slot_index", "is_half_day",
        "low_quality", "transactions", "open", "high", "low", "close", "volume",
    )


@query(
    select(
        b.days("supplier", "week"),
        "days",
        "security_key date is_half_day low_quality transactions open high low close volume",
    )
)
def day_bars(spark, sf):
    return ad.day_bars(spark, sf, "supplier", "week").select(
        "security_key", "date", "is_half_day",
        "low_quality", "transactions", "open", "high", "low", "close", "volume",
    )


@query(
    select(
        b.bars(),
        """(SELECT security_key, date, slot_index AS judged_slot,
             first_value(open) OVER w AS open, max(high) OVER w AS high, min(low) OVER w AS low, close,
             sum(volume) OVER w AS volume FROM bars
           WINDOW w AS (PARTITION BY security_key, date ORDER BY slot_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
        "security_key date judged_slot open high low close volume",
    )
)
def partial_day(spark, sf):
    hourly = ad.slot_bars(spark, sf)
    judged = hourly.select("security_key", "date", F.col("slot_index").alias("judged_slot"))
    return bo.partial_day(hourly, judged)


# --- splits -------------------------------------------------------------------

SPLITS = """splits AS (SELECT 'S' || s_suppkey AS ticker,
    DATE '1995-06-01' + CAST(k * 700 + s_suppkey % 500 AS INTEGER) AS execution_date,
    CAST(1 + s_nationkey % 2 AS DOUBLE) AS split_from, CAST(2 << k AS DOUBLE) AS split_to
  FROM supplier, (SELECT unnest([0, 1, 2]) AS k) WHERE s_acctbal > 0)"""


@query(
    select(
        b.chain(b.days("supplier", "week"), SPLITS),
        """(SELECT d.security_key, d.date, open * f AS open, high * f AS high, low * f AS low,
             close * f AS close, volume / f AS volume
           FROM (SELECT d.*, coalesce((SELECT product(split_from / split_to) FROM splits s
               WHERE s.ticker = d.security_key AND d.date < s.execution_date
                 AND s.execution_date <= DATE '1999-12-31'), 1.0) AS f FROM days d) d)""",
        "security_key date open high low close volume",
    )
)
def split_adjusted_bars(spark, sf):
    adjusted = adjust.split_adjust(
        ad.day_bars(spark, sf, "supplier", "week"), ad.splits(spark, sf), dt.date(1999, 12, 31)
    )
    return adjusted.select("security_key", "date", "open", "high", "low", "close", "volume")


@query(
    f"""WITH {SPLITS}, fetched AS (SELECT ticker AS requested_ticker, execution_date, split_from, split_to,
    execution_date + CAST(30 * unnest(range(1 + CAST(substr(ticker, 2) AS INTEGER) % 4)) AS INTEGER) AS fetched FROM splits)
SELECT requested_ticker, execution_date, split_from, split_to, max(fetched) AS fetched
FROM fetched GROUP BY ALL"""
)
def newest_splits(spark, sf):
    """Every split was fetched one to four times, a month apart."""
    times = F.sequence(F.lit(0), (F.substring("ticker", 2, 20).cast("bigint") % 4).cast("int"))
    fetched = ad.splits(spark, sf).withColumn("_n", F.explode(times)).select(
        F.col("ticker").alias("requested_ticker"), "execution_date", "split_from", "split_to",
        F.date_add("execution_date", 30 * F.col("_n")).alias("fetched"),
    )
    return adjust.newest_fetch(fetched)
