"""Candidates against their own controls, clustered by date, and the verdict on them."""

from __future__ import annotations

import datetime as dt
import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Fixed values.
REQUIRED_EDGE = 0.15
REQUIRED_P = 0.01
REQUIRED_FOLD_SHARE = 2 / 3
FOLDS = 3
PURGE_DAYS = 90
#: Sessions before which features cannot fill and nothing is a candidate.
WARMUP = 120
HOLDOUT_FROM = dt.date(2025, 9, 19)
HORIZON = "move_5d_atr"


@F.pandas_udf(DoubleType())
def two_sided_p(t: pd.Series) -> pd.Series:
    """The normal two-sided p of a t; Spark has no erfc. Runs on summary rows only."""
    return pd.Series(
        [math.erfc(abs(v) / math.sqrt(2)) if np.isfinite(v) else None for v in t.astype(float)]
    )


def picked_rows(rows: DataFrame, families: tuple[str, ...], extra: tuple[str, ...] = ()) -> DataFrame:
    """The chosen families' candidates and the controls drawn for exactly those bars."""
    either = reduce(lambda a, b: a | b, [F.col(f) for f in families])
    chosen = rows.where((F.col("kind") == "candidate") & either)
    bars = chosen.select(
        "date", F.col("security_key").alias("matched_candidate_key"),
        F.col("slot_index").alias("matched_candidate_slot"),
    ).distinct()
    controls = rows.where(F.col("kind") == "control").join(
        bars, ["date", "matched_candidate_key", "matched_candidate_slot"], "left_semi"
    )
    keep = ["date", "kind", HORIZON, *extra]
    return chosen.select(*keep).unionByName(controls.select(*keep))


def daily_differences(picked: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Per date: the mean absolute move of candidates less that of their controls."""
    size = F.abs(F.col(HORIZON))
    own, other = (F.when(F.col("kind") == k, size) for k in ("candidate", "control"))
    return (
        picked.groupBy("date", *by)
        .agg(
            F.count(own).alias("candidates"), F.count(other).alias("controls"),
            F.avg(own).alias("candidate_mean"), F.avg(other).alias("control_mean"),
        )
        .where((F.col("candidates") > 0) & (F.col("controls") > 0))
        .withColumn("difference", F.col("candidate_mean") - F.col("control_mean"))
    )


def clustered_estimate(daily: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The mean over dates with its date-clustered standard error, t and p."""
    n = F.count(F.lit(1))
    found = daily.groupBy(*by).agg(
        n.alias("dates"), F.sum("candidates").alias("candidates"),
        F.sum("controls").alias("controls"), F.avg("candidate_mean").alias("candidate_mean"),
        F.avg("control_mean").alias("control_mean"), F.avg("difference").alias("edge"),
        F.when(n > 1, F.stddev_samp("difference") / F.sqrt(n)).alias("standard_error"),
    )
    t = F.when(F.col("standard_error") != 0, F.try_divide(F.col("edge"), F.col("standard_error")))
    return found.withColumn("t", t).withColumn("p", two_sided_p("t"))


def clustered_difference(rows: DataFrame, families: tuple[str, ...]) -> DataFrame:
    return clustered_estimate(daily_differences(picked_rows(rows, families)))


def with_fold(rows: DataFrame, sessions: DataFrame, folds: int = FOLDS, purge: int = PURGE_DAYS) -> DataFrame:
    """`fold`: equal [start, end) windows over the sessions' span, purge days apart; rows in a
    gap have none. The span is one row, so the join is a broadcast of one row."""
    span = F.datediff(F.max("date"), F.min("date"))
    bounds = sessions.agg(
        F.min("date").alias("_first"), ((span - purge * (folds - 1)) / folds).alias("_length")
    )
    # Lengths are cut to whole days, as date arithmetic does at each step.
    elapsed = F.datediff("date", "_first")
    whole = F.floor("_length")
    period = whole + purge
    fold = F.floor(elapsed / period)
    inside = (elapsed >= 0) & (fold < folds) & (elapsed - fold * period < whole)
    return (
        rows.crossJoin(F.broadcast(bounds))
        .withColumn("fold", F.when(inside, fold.cast("int")))
        .drop("_first", "_length")
    )


def match_quality(rows: DataFrame) -> DataFrame:
    """How tightly the controls were matched."""
    w = F.col("widening")
    return rows.where(F.col("kind") == "control").agg(
        F.count(F.lit(1)).alias("controls"), F.count_if(w == 0).alias("exact"),
        F.count_if(w == 1).alias("within_one"), F.count_if(w >= 2).alias("within_two_or_more"),
        F.avg(w).alias("mean_widening"),
    )


def development_rows(rows: DataFrame, holdout_from: dt.date = HOLDOUT_FROM) -> DataFrame:
    """Rows before the holdout; nothing on or after it is ever read."""
    return rows.where(F.col("date") < F.lit(holdout_from))


def warmed_up(sessions: DataFrame, warmup: int = WARMUP) -> DataFrame:
    """Sessions after the feature warm-up."""
    return sessions.where(F.col("session_no") >= warmup)


def study_window(
    rows: DataFrame, sessions: DataFrame, holdout_from: dt.date = HOLDOUT_FROM, warmup: int = WARMUP
) -> tuple[DataFrame, DataFrame]:
    """Rows and sessions after the warm-up and before the holdout."""
    usable = warmed_up(development_rows(sessions, holdout_from), warmup)
    return rows.join(F.broadcast(usable.select("date")), "date", "left_semi"), usable


def verdict(
    rows: DataFrame, sessions: DataFrame, families: tuple[str, ...],
    holdout_from: dt.date = HOLDOUT_FROM, warmup: int = WARMUP,
) -> DataFrame:
    """One row: the estimate, in how many folds it holds under both readings, and the answer.

    Nothing before the warm-up counts, in the estimate or in the folds.
    """
    rows, usable = study_window(rows, sessions, holdout_from, warmup)
    picked = picked_rows(with_fold(rows, usable), families, ("fold",))
    per_fold = clustered_estimate(
        daily_differences(picked.where(F.col("fold").isNotNull()), ("fold",)), ("fold",)
    )
    big = F.coalesce(F.col("edge") >= REQUIRED_EDGE, F.lit(False))
    sure = big & F.coalesce(F.col("p") < REQUIRED_P, F.lit(False))
    folds = per_fold.agg(
        F.coalesce(F.sum(big.cast("int")), F.lit(0)).alias("folds_effect"),
        F.coalesce(F.sum(sure.cast("int")), F.lit(0)).alias("folds_whole"),
    )
    whole = clustered_estimate(daily_differences(picked))
    holds = F.col("folds_effect") / FOLDS >= REQUIRED_FOLD_SHARE
    return whole.crossJoin(folds).withColumns(
        {
            "edge_ok": big,
            "p_ok": F.coalesce(F.col("p") < REQUIRED_P, F.lit(False)),
            "folds_ok": holds,
        }
    ).withColumn("earned", F.col("edge_ok") & F.col("p_ok") & F.col("folds_ok"))
