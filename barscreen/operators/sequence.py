"""What the bars just before this one looked like."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barscreen.functions.orders import bar_order
from barscreen.functions import trailing as tr
from barscreen.schema import at_least, at_most

BUSY_PERCENTILE = 90.0
NARROW_ATR = 0.6
LONG_WICK = 0.5
REPEAT_WINDOW = 5
EXTREME_WINDOW = 10


def _three_state(condition: Column, *inputs: Column) -> Column:
    """True or false where every input is known, else unknown."""
    known = F.lit(True)
    for value in inputs:
        known = known & value.isNotNull()
    return F.when(known, condition)


def sequence_features(
    bars: DataFrame,
    busy_percentile: float = BUSY_PERCENTILE,
    narrow_atr: float = NARROW_ATR,
    extreme_window: int = EXTREME_WINDOW,
) -> DataFrame:
    busy = at_least(F.col("vol_pct_slot_60"), busy_percentile)
    narrow = at_most(F.col("spread_atr"), narrow_atr)
    rejected = at_least(F.col("upper_wick_frac"), LONG_WICK)
    n = extreme_window
    found = bars.withColumns(
        {
            "repeat_hv_narrow_5": tr.count_before(busy & narrow, bar_order(), REPEAT_WINDOW),
            "repeat_upper_reject_5": tr.count_before(busy & rejected, bar_order(), REPEAT_WINDOW),
            "_hi": tr.highest_before(F.col("high"), bar_order(), n),
            "_lo": tr.lowest_before(F.col("low"), bar_order(), n),
            "_hc": tr.highest_before(F.col("close"), bar_order(), n),
            "_lc": tr.lowest_before(F.col("close"), bar_order(), n),
        }
    )
    return failed_extremes(found)


def failed_extremes(bars: DataFrame) -> DataFrame:
    """`failed_new_high/low` of bars with the extremes before them as columns."""
    return bars.withColumns(
        {
            "failed_new_high": _three_state(
                (F.col("high") > F.col("_hi")) & (F.col("close") <= F.col("_hc")),
                F.col("high"), F.col("close"), F.col("_hi"), F.col("_hc"),
            ),
            "failed_new_low": _three_state(
                (F.col("low") < F.col("_lo")) & (F.col("close") >= F.col("_lc")),
                F.col("low"), F.col("close"), F.col("_lo"), F.col("_lc"),
            ),
        }
    ).drop("_hi", "_lo", "_hc", "_lc")
