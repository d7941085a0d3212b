"""Strictly trailing window measures: rows i-n .. i-1, never the current row.

A row that is not a valid observation keeps its place in the window but contributes nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

#: Fixed values.
MIN_VALID_SHARE = 2 / 3
MAD_TO_SIGMA = 1.4826


def min_valid(window: int) -> int:
    """How many valid observations a window needs: two thirds of it, rounded up."""
    return math.ceil(window * MIN_VALID_SHARE)


def log_volume(volume: Column) -> Column:
    return F.log1p(volume)


def baseline_valid(low_quality: Column, is_half_day: Column | None = None) -> Column:
    """Whether a bar may serve as a trailing observation."""
    valid = ~low_quality
    return valid if is_half_day is None else valid & ~F.coalesce(is_half_day, F.lit(False))


def measurable(is_half_day: Column) -> Column:
    """Whether a bar may be ranked against a baseline at all (half days may not)."""
    return ~F.coalesce(is_half_day, F.lit(False))


def before(window: WindowSpec, n: int) -> WindowSpec:
    return window.rowsBetween(-n, -1)


def trailing_count(valid: Column, window: WindowSpec, n: int) -> Column:
    return F.count(F.when(valid, F.lit(1))).over(before(window, n))


def past_values(value: Column, valid: Column, window: WindowSpec, n: int) -> Column:
    """The valid observations of the previous n rows, sorted. At most n of them."""
    return F.sort_array(F.collect_list(F.when(valid, value)).over(before(window, n)))


def let(value: Column, body) -> Column:
    """`body(value)` with `value` worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def centre_of(ordered: Column) -> Column:
    """The median of a sorted array, null if empty: the mean of its two middle elements. Names
    the array several times, so it should be a column of its own."""
    low = F.get(ordered, F.floor((F.size(ordered) - 1) / 2).cast("int"))
    return (low + F.get(ordered, F.floor(F.size(ordered) / 2).cast("int"))) / 2.0


def middle(ordered: Column) -> Column:
    """The same of any expression."""
    return F.when(F.size(ordered) > 0, let(ordered, centre_of))


def percentile_in(past: Column, value: Column, need: int) -> Column:
    """The share of `past` strictly below `value`, as a percentage.

    So many stand before `value` once it is sorted in among them. Sorting and searching numbers
    is compiled; a filter with a lambda is not.
    """
    known = F.coalesce(value, F.lit(0))  # without nulls an array is sorted as plain numbers
    below = F.array_position(F.sort_array(F.array_append(past, known)), known) - 1
    return F.when(
        (F.size(past) >= need) & value.isNotNull(), below.cast("double") * 100.0 / F.size(past)
    )


def median_of(past: Column, need: int) -> Column:
    return F.when(F.size(past) >= need, centre_of(past))


def distances(past: Column, centre: Column) -> Column:
    """How far the values of `past` lie from `centre`, sorted."""
    return F.sort_array(F.transform(past, lambda v: F.coalesce(F.abs(v - centre), F.lit(0.0))))


def robust_z_of(past: Column, centre: Column, off: Column, value: Column, need: int) -> Column:
    """`robust_z_in` with the median of `past` and the `distances` from it as columns of their own,
    which spares working them out in a lambda."""
    mad = centre_of(off)
    return F.when((F.size(past) >= need) & (mad > 0), (value - centre) / (MAD_TO_SIGMA * mad))


def robust_z_in(past: Column, value: Column, need: int) -> Column:
    """`(value - median) / (1.4826 x MAD)`; unknown where the MAD is zero."""

    def around(centre: Column) -> Column:
        off = F.sort_array(F.transform(past, lambda v: F.abs(v - centre)))
        return let(
            middle(off),
            lambda mad: F.when(mad > 0, (value - centre) / (MAD_TO_SIGMA * mad)),
        )

    return F.when(F.size(past) >= need, let(middle(past), around))


def trailing_percentile(
    value: Column, valid: Column, window: WindowSpec, n: int, need: int | None = None
) -> Column:
    past = past_values(value, valid, window, n)
    return percentile_in(past, value, min_valid(n) if need is None else need)


def trailing_robust_z(
    value: Column, valid: Column, window: WindowSpec, n: int, need: int | None = None
) -> Column:
    past = past_values(value, valid, window, n)
    return robust_z_in(past, value, min_valid(n) if need is None else need)


def trailing_median(
    value: Column, valid: Column, window: WindowSpec, n: int, need: int | None = None
) -> Column:
    return median_of(past_values(value, valid, window, n), min_valid(n) if need is None else need)


def _full(value: Column, frame: WindowSpec, n: int, answer: Column) -> Column:
    """`answer` only where all n rows of the frame hold a value."""
    return F.when(F.count(value).over(frame) == n, answer)


def highest_before(value: Column, window: WindowSpec, n: int) -> Column:
    frame = before(window, n)
    return _full(value, frame, n, F.max(value).over(frame))


def lowest_before(value: Column, window: WindowSpec, n: int) -> Column:
    frame = before(window, n)
    return _full(value, frame, n, F.min(value).over(frame))


def count_before(flag: Column, window: WindowSpec, n: int) -> Column:
    """How many of the previous n rows are true; unknown until n rows exist."""
    frame = before(window, n)
    hit = F.when(flag, 1.0).otherwise(0.0)
    return _full(hit, frame, n, F.sum(hit).over(frame))


def span_total(value: Column, window: WindowSpec, n: int) -> Column:
    """The total over this row and the n-1 before it; unknown if any is unknown."""
    frame = window.rowsBetween(-(n - 1), 0)
    return _full(value, frame, n, F.sum(value).over(frame))


def span_all(flag: Column, window: WindowSpec, n: int) -> Column:
    """True where the flag has held for n rows in a row, the current one included."""
    hits = F.count(F.when(flag, F.lit(1))).over(window.rowsBetween(-(n - 1), 0))
    return hits == n


def shifted(value: Column, window: WindowSpec, k: int) -> Column:
    return F.lag(value, k).over(window)


def running_low(value: Column, window: WindowSpec) -> Column:
    return F.min(value).over(window.rowsBetween(Window.unboundedPreceding, 0))


def forward_fill(value: Column, window: WindowSpec) -> Column:
    return F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0))


def fractional_change(value: Column, window: WindowSpec) -> Column:
    """`value / previous - 1` with no padding across an unknown."""
    return F.try_divide(value, F.lag(value).over(window)) - 1.0
