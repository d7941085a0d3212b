"""No look-ahead, and results that do not depend on row order or partitions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barscreen.functions.orders import by_security
from barscreen.plans import adapters as ad
from barscreen.plans import features as ft
from barscreen.session import cut_lineage

CUT = dt.date(1999, 3, 1)


@pytest.fixture(scope="module")
def inputs(spark, small):
    bars = cut_lineage(ad.slot_bars(spark, small))
    days = cut_lineage(ad.day_bars(spark, small))
    hourly, daily = ad.market_bars(spark, small)
    return bars, days, cut_lineage(hourly), cut_lineage(daily)


def tampered(df):
    """Everything after the cut altered, nothing up to it."""
    after = F.col("date") > F.lit(CUT)
    changes = {
        c: F.when(after, F.col(c) * 3 + 7).otherwise(F.col(c))
        for c in ("open", "high", "low", "close", "volume")
        if c in df.columns
    }
    return df.withColumns(changes)


def rounded(df):
    kinds = dict(df.dtypes)
    return df.select(*[F.round(c, 8).alias(c) if kinds[c] == "double" else F.col(c) for c in df.columns])


def test_later_bars_never_change_earlier_features(inputs):
    before = F.col("date") <= F.lit(CUT)
    real = cut_lineage(rounded(ft.hourly_features(*inputs)).where(before))
    other = cut_lineage(rounded(ft.hourly_features(*[tampered(i) for i in inputs])).where(before))
    assert real.count() > 1000
    assert real.exceptAll(other).count() == 0


def test_row_order_and_partitions_do_not_matter(inputs):
    bars, days, _, daily = inputs
    one = cut_lineage(rounded(ft.daily_features(days, daily)))
    shuffled = days.orderBy(F.rand(9)).repartition(11)
    two = cut_lineage(rounded(ft.daily_features(shuffled, daily)))
    assert one.exceptAll(two).count() == 0 and one.count() == two.count()


def test_price_scale_does_not_matter(inputs):
    _, days, _, daily = inputs
    scaled = days.withColumns({c: F.col(c) * 4.0 for c in ("open", "high", "low", "close")})
    keep = ["security_key", "date", "spread_atr", "close_loc", "ret_atr", "dist_high_20", "efficiency"]
    one, two = (rounded(ft.daily_features(d, daily).select(*keep)) for d in (days, scaled))
    assert cut_lineage(one).exceptAll(cut_lineage(two)).count() == 0


def test_windows_share_one_shuffle(inputs):
    """Volatility and volume over bars already at their security add no exchange."""
    from barscreen.operators import volatility as vt
    from barscreen.operators import volume as vl

    plan = vl.hourly_volume(vt.hourly_volatility(by_security(inputs[0])))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1
