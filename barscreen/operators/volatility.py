"""True range and Wilder's average of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barscreen.functions.orders import bar_order, day_order, slot_order
from barscreen.functions import trailing as tr
from barscreen.operators.volume import valid_bar
from barscreen.schema import ratio

ATR_PERIOD = 20
#: Rows in one block of the recursion. Within a block the weights stay far from the limits of a
#: double; across a whole block a value has decayed to nothing (0.95^1024 is about 1e-23).
BLOCK = 1024


def with_true_range(bars: DataFrame, order: WindowSpec, carried: Column | None = None) -> DataFrame:
    """The largest of the bar's own range and its reach from the previous close: `carried` for a
    security's first bar here, if earlier ones are left out."""
    own = F.col("high") - F.col("low")
    previous = F.lag("close").over(order)
    if carried is not None:
        previous = F.when(F.row_number().over(order) == 1, carried).otherwise(previous)
    reach = F.greatest(F.abs(F.col("high") - previous), F.abs(F.col("low") - previous))
    known = F.col("high").isNotNull() & F.col("low").isNotNull()
    widest = F.when(previous.isNull(), own).otherwise(F.greatest(own, reach))
    return bars.withColumn("true_range", F.when(known, widest))


def with_wilder_atr(
    bars: DataFrame, order_by: list[str], into: str, period: int = ATR_PERIOD,
    carried: tuple[Column, Column] | None = None, keep_state: bool = False,
) -> DataFrame:
    """`into`: the averaged true range known when a bar opens.

    The recursion `a' = a + (range - a) / period`, started from the mean of the first `period`
    known ranges, is a weighted sum: each range counts 1/period and fades by (1 - 1/period) a
    step, the first `period` of them fading from the same step. So it needs no loop: ranges are
    scaled by how far they stand from the start of their block, summed as they come, scaled
    back, and the end of the block before is carried in. Unknown ranges leave the average as it
    was.

    The state after a bar is the number of known ranges and the weighted sum of them;
    `keep_state` adds it as `ranges_seen, range_value`. `carried`, the state before a security's
    first bar here (null: none), goes on from there: it fades by the same steps.
    """
    fade = 1.0 - 1.0 / period
    order = Window.partitionBy("security_key").orderBy(*order_by)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    # The next two windows need the same sort of the same partitions: one sort serves both.
    among_known = Window.partitionBy("security_key", "_known").orderBy("_block", *order_by)
    in_block = Window.partitionBy("security_key", "_known", "_block").orderBy(*order_by)

    seen, value = (F.coalesce(c, F.lit(0)) for c in carried) if carried else (F.lit(0), F.lit(0.0))
    # Steps from the carried state, or from the end of the first `period` ranges.
    step = F.greatest(F.col("_seen"), F.lit(period)) - F.greatest(seen, F.lit(period))
    within = F.col("_within")
    out = (
        bars.withColumn("_known", F.col("true_range").isNotNull())
        .withColumn("_seen", F.count("true_range").over(so_far) + seen)
        .withColumn("_block", F.floor(step / BLOCK))
        .withColumn("_step", step - F.col("_block") * BLOCK)
        .withColumn(
            "_within",
            F.sum(F.col("true_range") / period * F.pow(F.lit(fade), -F.col("_step"))).over(
                in_block.rowsBetween(Window.unboundedPreceding, 0)
            )
            * F.pow(F.lit(fade), F.col("_step")),
        )
        .withColumn("_before", F.lag(within).over(among_known))
        .withColumn(
            "_carried",
            F.first("_before").over(in_block.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .withColumn(
            "_value",
            F.when(
                F.col("_known"),
                within
                + F.when(
                    F.col("_block") > 0,
                    F.col("_carried") * F.pow(F.lit(fade), F.col("_step") + 1),
                ).otherwise(0.0),
            ),
        )
    )
    if carried:
        out = out.withColumn("_value", F.col("_value") + value * F.pow(F.lit(fade), F.col("_block") * BLOCK + F.col("_step")))
    known = F.last(F.when(F.col("_seen") >= period, F.col("_value")), ignorenulls=True)
    before = known.over(order.rowsBetween(Window.unboundedPreceding, -1))  # through the previous bar only
    if carried:
        before = F.coalesce(before, F.when(seen >= period, value))
    out = out.withColumn(into, before)
    if keep_state:
        latest = F.last("_value", ignorenulls=True).over(so_far)
        out = out.withColumns({"ranges_seen": F.col("_seen"), "range_value": F.coalesce(latest, value)})
    return out.drop("_known", "_seen", "_block", "_step", "_within", "_before", "_carried", "_value")


def hourly_ranges(bars: DataFrame) -> DataFrame:
    """`true_range, atr20_bar, spread_atr`: everything read in bar order."""
    ranged = with_wilder_atr(
        with_true_range(bars, bar_order()), ["date", "slot_index"], "atr20_bar"
    )
    return ranged.withColumn("spread_atr", ratio(F.col("true_range"), F.col("atr20_bar")))


def spread_percentile(ranged: DataFrame, window: int = 60) -> DataFrame:
    """`spread_pct_slot_60`: the true range against the same slot before."""
    valid = valid_bar() & F.col("true_range").isNotNull()
    found = tr.trailing_percentile(F.col("true_range"), valid, slot_order(), window)
    return ranged.withColumn(
        "spread_pct_slot_60", F.when(tr.measurable(F.col("is_half_day")), found)
    )


def hourly_volatility(bars: DataFrame, window: int = 60) -> DataFrame:
    return spread_percentile(hourly_ranges(bars), window)


def daily_volatility(daily: DataFrame, carried: Column | None = None, keep_state: bool = False) -> DataFrame:
    """`true_range, atr20_day, spread_atr` on daily bars. `carried`: a struct with `close`,
    `ranges_seen` and `range_value` as they stood before a security's first bar here."""
    state = None if carried is None else (carried["ranges_seen"], carried["range_value"])
    ranged = with_true_range(daily, day_order(), None if carried is None else carried["close"])
    ranged = with_wilder_atr(ranged, ["date"], "atr20_day", carried=state, keep_state=keep_state)
    return ranged.withColumn("spread_atr", ratio(F.col("true_range"), F.col("atr20_day")))


def geometry(bars: DataFrame) -> DataFrame:
    """The bar's shape as shares of its true range, and where it closed in its own range.

    A bar with no range has no shape: unknown, not zero.
    """
    top = F.when(
        F.col("open").isNotNull() & F.col("close").isNotNull(), F.greatest("open", "close")
    )
    bottom = F.when(
        F.col("open").isNotNull() & F.col("close").isNotNull(), F.least("open", "close")
    )
    span = F.col("true_range")
    return bars.withColumns(
        {
            "body_frac": ratio(F.abs(F.col("close") - F.col("open")), span),
            "upper_wick_frac": ratio(F.col("high") - top, span),
            "lower_wick_frac": ratio(bottom - F.col("low"), span),
            "close_loc": ratio(F.col("close") - F.col("low"), F.col("high") - F.col("low")),
        }
    )
