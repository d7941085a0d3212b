"""What is left of a move once the market's own is taken out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barscreen.functions.orders import calendar_order, day_order
from barscreen.functions import trailing as tr
from barscreen.schema import ratio

BETA_WINDOW = 60


def market_series(market: DataFrame, hourly: bool) -> DataFrame:
    """The benchmark's return per bar. One security's bars: bounded by the calendar."""
    if hourly:
        change = tr.fractional_change(F.col("close"), calendar_order("date", "slot_index"))
        return market.select("date", "slot_index", change.alias("market_return"))
    change = tr.fractional_change(F.col("close"), calendar_order("date"))
    return market.select("date", change.alias("market_return"))


def market_day_return(market: DataFrame, hourly: bool) -> DataFrame:
    """The benchmark's return per session, from its last known close."""
    if hourly:
        known = F.when(F.col("close").isNotNull(), F.col("slot_index"))
        closes = market.groupBy("date").agg(F.max_by("close", known).alias("close"))
    else:
        closes = market.select("date", "close")
    change = tr.fractional_change(F.col("close"), calendar_order("date"))
    return closes.select("date", change.alias("market_ret_day"))


def with_beta(
    daily: DataFrame, market_daily: DataFrame, n: int = BETA_WINDOW, carried: DataFrame | None = None
) -> DataFrame:
    """Adds `beta_60`, fitted on the previous n paired returns and held weekly, and `paired`, the
    returns paired so far. `carried` (security_key, beta_60, paired) holds what stood before a
    security's first session here.

    The fit runs over rows where both returns are known. Splitting the window by "known" lets
    those rows see one another as neighbours without filtering and joining back.
    """
    returns = F.broadcast(
        market_series(market_daily, hourly=False).withColumnRenamed("market_return", "_m")
    )
    paired = (
        daily.join(returns, "date", "left")
        .withColumn("_s", tr.fractional_change(F.col("close"), day_order()))
        .withColumn("_both", F.col("_s").isNotNull() & F.col("_m").isNotNull())
    )
    neighbours = tr.before(Window.partitionBy("security_key", "_both").orderBy("date"), n)
    # Zero market variance has no slope; `regr_slope` gives null there.
    slope = F.when(
        F.col("_both") & (F.count(F.lit(1)).over(neighbours) == n),
        F.regr_slope("_s", "_m").over(neighbours),
    )
    enough = tr.trailing_count(F.col("_both"), day_order(), n) >= tr.min_valid(n)
    week = F.date_trunc("week", "date")
    opens_week = F.coalesce(F.lag(week).over(day_order()) != week, F.lit(True))
    held = tr.forward_fill(F.col("_held"), day_order())
    so_far = F.count(F.when(F.col("_both"), 1)).over(day_order().rowsBetween(Window.unboundedPreceding, 0))
    out = paired.withColumn("_fit", slope).withColumn("_held", F.when(opens_week & enough, F.col("_fit")))
    out = out.withColumns({"beta_60": held, "paired": so_far}).drop("_m", "_s", "_both", "_fit", "_held")
    if carried is None:
        return out
    before = carried.select("security_key", F.col("beta_60").alias("_beta"), F.col("paired").alias("_paired"))
    return out.join(before, "security_key", "left").withColumns({
        "beta_60": F.coalesce("beta_60", "_beta"), "paired": F.col("paired") + F.coalesce("_paired", F.lit(0)),
    }).drop("_beta", "_paired")


def beta_by_session(
    daily: DataFrame, market_daily: DataFrame, n: int = BETA_WINDOW, carried: DataFrame | None = None
) -> DataFrame:
    """`(security_key, date, beta_60, paired)`."""
    found = with_beta(daily.select("security_key", "date", "close"), market_daily, n, carried)
    return found.select("security_key", "date", "beta_60", "paired")


def market_features(bars: DataFrame, market: DataFrame, hourly: bool) -> DataFrame:
    """`resid_ret_atr, market_ret_day`; the sector columns have no source and are null.

    `bars` carries `beta_60` of its session and `_pc`, its previous close. The market joins are
    against one security's bars, bounded by the calendar and broadcast.
    """
    atr = F.col("atr20_bar" if hourly else "atr20_day")
    keys = ["date", "slot_index"] if hourly else ["date"]
    explained = F.col("beta_60") * F.col("market_return") * F.col("_pc")
    return (
        bars.join(F.broadcast(market_series(market, hourly)), keys, "left")
        .join(F.broadcast(market_day_return(market, hourly)), "date", "left")
        .withColumn("resid_ret_atr", ratio(F.col("close") - F.col("_pc") - explained, atr))
        .withColumn("sector_resid_ret_atr", F.lit(None).cast("double"))
        .withColumn("sector_ret_day", F.lit(None).cast("double"))
        .drop("_pc", "market_return")
    )
