"""How often the nearest level has been touched, and how old it is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barscreen.functions.orders import day_order
from barscreen.functions import trailing as tr

TOUCH_WINDOW = 60
#: The eligible levels, in the order that settles ties.
ANCHORS = (
    "high_20", "low_20", "prior_week_high", "prior_week_low", "prior_month_high", "pivot_high",
)


def anchor_prices(levels: DataFrame) -> DataFrame:
    """The eligible levels in long form: one row per session and anchor."""
    pairs = ", ".join(f"'{a}', {a}" for a in ANCHORS)
    return levels.selectExpr(
        "security_key", "date", f"stack({len(ANCHORS)}, {pairs}) as (anchor, price)"
    )


def touch_counts(levels: DataFrame, n: int = TOUCH_WINDOW) -> DataFrame:
    """`touch_<level>`: sessions among the previous n whose range holds the level."""
    ranges = F.collect_list(F.struct("low", "high")).over(tr.before(day_order(), n))

    def holding(level: Column) -> Column:
        inside = F.filter("_ranges", lambda r: (r["low"] <= level) & (r["high"] >= level))
        return F.when(level.isNotNull() & (F.col("pos") > 0), F.size(inside).cast("double"))

    return (
        levels.withColumn("_ranges", ranges)
        .withColumns({f"touch_{a}": holding(F.col(a)) for a in ANCHORS})
        .drop("_ranges")
    )


def nearest_level(bars: DataFrame) -> DataFrame:
    """`level_touch_count` and `level_age_bars` of the level nearest this bar's close.

    `bars` carries each anchor's price, touch count and setting position for its session.
    """
    entries = [
        F.when(
            (F.col(a) - F.col("close")).isNotNull(),
            F.struct(
                F.abs(F.col(a) - F.col("close")).alias("gap"),
                F.lit(i).alias("tie"),
                F.col(f"touch_{a}").alias("touch"),
                F.col(f"set_{a}").cast("double").alias("set_at"),
            ),
        )
        for i, a in enumerate(ANCHORS)
    ]
    nearest = F.array_min(F.array(*entries))
    return (
        bars.withColumn("_nearest", nearest)
        .withColumn("level_touch_count", F.col("_nearest.touch"))
        .withColumn("level_age_bars", F.col("pos") - F.col("_nearest.set_at"))
        .drop("_nearest")
    )
