"""Prior extremes and how far a bar stands from them, in daily ATR."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barscreen.functions.orders import day_order
from barscreen.functions import trailing as tr
from barscreen.schema import ratio, require

LEVELS = (
    "prior_day_high", "prior_day_low", "prior_week_high", "prior_week_low",
    "prior_month_high", "prior_month_low", "high_20", "low_20", "high_60", "low_60",
)
ROUND_STEP = 0.5
EXTREMES = (20, 60)


def _peak() -> Column:
    """A session's high with its position: the larger wins, then the later."""
    return F.when(F.col("high").isNotNull(), F.struct(F.col("high").alias("at"), "pos"))


def _trough() -> Column:
    """A session's low with its position: the smaller wins, then the later."""
    return F.when(
        F.col("low").isNotNull(), F.struct(F.col("low").alias("at"), (-F.col("pos")).alias("neg"))
    )


def session_levels(daily: DataFrame) -> DataFrame:
    """The levels in force on each session, and the position of the session that set each.

    Adds `pos` (the session's place in the security's own history), the ten levels, and
    `set_<level>` for the levels that are dated. Everything is a window over one security's
    sessions; a prior week or month is the last one present in the security's own data.
    """
    require(daily, ["security_key", "date", "high", "low"], "daily bars")
    out = daily.withColumn("pos", F.row_number().over(day_order()) - 1).withColumns(
        {
            "prior_day_high": F.lag("high").over(day_order()),
            "prior_day_low": F.lag("low").over(day_order()),
        }
    )
    for n in EXTREMES:
        frame = tr.before(day_order(), n)
        out = out.withColumns(
            {
                f"high_{n}": tr.highest_before(F.col("high"), day_order(), n),
                f"low_{n}": tr.lowest_before(F.col("low"), day_order(), n),
            }
        )
        if n == 20:
            out = out.withColumns(
                {
                    "set_high_20": F.when(F.col("high_20").isNotNull(), F.max(_peak()).over(frame)["pos"]),
                    "set_low_20": F.when(F.col("low_20").isNotNull(), -F.min(_trough()).over(frame)["neg"]),
                }
            )
    for period in ("week", "month"):
        out = _prior_period(out, period)
    return out


def _prior_period(daily: DataFrame, period: str) -> DataFrame:
    """The last completed period's high and low and the session that set each.

    The extreme of the period so far, one row back at the first row of the next period, is the
    extreme of the whole period before; it then holds through the period. The level's date is
    the last earlier session at that price, which may lie in the period now running.
    """
    # Periods rise with dates, so ordering by both is the order of dates - and the very sort the
    # windows inside a period need: one sort serves all of them.
    across = Window.partitionBy("security_key").orderBy("_period", "date")
    inside = Window.partitionBy("security_key", "_period").orderBy("date")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    hi, lo = f"prior_{period}_high", f"prior_{period}_low"
    return (
        daily.withColumn("_period", F.date_trunc(period, "date"))
        .withColumn("_hi", F.max(_peak()).over(so_far))
        .withColumn("_lo", F.min(_trough()).over(so_far))
        .withColumn("_hi", F.lag("_hi").over(across))
        .withColumn("_lo", F.lag("_lo").over(across))
        .withColumn("_hi", F.first("_hi").over(so_far))
        .withColumn("_lo", F.first("_lo").over(so_far))
        .withColumn(hi, F.col("_hi.at"))
        .withColumn(lo, F.col("_lo.at"))
        .withColumn(
            f"set_{hi}",
            F.coalesce(
                F.max(F.when(F.col("high") == F.col(hi), F.col("pos"))).over(earlier),
                F.col("_hi.pos"),
            ),
        )
        .withColumn(
            f"set_{lo}",
            F.coalesce(
                F.max(F.when(F.col("low") == F.col(lo), F.col("pos"))).over(earlier),
                -F.col("_lo.neg"),
            ),
        )
        .drop("_period", "_hi", "_lo")
    )


def nearest_round_number(price: Column) -> Column:
    """The nearest half dollar; an exact tie goes to the even multiple."""
    return F.bround(price / ROUND_STEP) * ROUND_STEP


def level_distances(bars: DataFrame, raw_close: str = "close", raw_atr: str = "daily_atr") -> DataFrame:
    """`dist_<level>`: signed, in the session's daily ATR.

    `bars` already carries the levels and `daily_atr` of its session. The round number is taken
    from as-traded prices and ATR, the one distance a split adjustment would change.
    """
    columns = {
        f"dist_{name}": ratio(F.col("close") - F.col(name), F.col("daily_atr")) for name in LEVELS
    }
    gap = F.col(raw_close) - nearest_round_number(F.col(raw_close))
    columns["dist_round_number"] = ratio(gap, F.col(raw_atr))
    return bars.withColumns(columns)
