"""Who a symbol was, when: ticker histories, segments and rename stitching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barscreen.functions import trailing as tr
from barscreen.operators import histories as hs
from barscreen.operators.intervals import interval_join
from barscreen.session import cut_lineage

#: What tells the spans of the symbols a security used apart.
SPAN = ["ticker_now", "ticker_then", "start", "end", "status"]
EVENTS_JSON = "array<struct<type:string,date:string,ticker_change:struct<ticker:string>>>"


def parse_ticker_events(rows: DataFrame, column: str = "events_json") -> DataFrame:
    """`changes`: the ticker-change events in date order, and whether any symbol is blank.

    The list is one security's own changes. It is parsed once a row, whatever asks for it: a filter
    is not carried past a generator with its expressions, as it is past a projection.
    """
    parsed = F.from_json(column, EVENTS_JSON)
    rows = rows.withColumn("_mine", F.explode(F.array(F.filter(parsed, lambda e: e["type"] == "ticker_change"))))
    mine = F.col("_mine")
    symbol = lambda e: F.trim(F.coalesce(e["ticker_change"]["ticker"], F.lit("")))
    changes = F.sort_array(
        F.transform(
            mine, lambda e: F.struct(e["date"].cast("date").alias("date"),
                                     e["ticker_change"]["ticker"].alias("ticker"))
        )
    )
    return rows.withColumn("has_blank", F.exists(mine, lambda e: symbol(e) == "")).withColumn(
        "changes", F.coalesce(changes, F.array().cast("array<struct<date:date,ticker:string>>"))
    ).drop("_mine")


def ticker_on(changes: Column, day: Column) -> Column:
    """The symbol in use on a day; before the first change, the first symbol."""
    past = F.filter(changes, lambda c: c["date"] <= day)
    known = F.when(F.size(past) > 0, F.element_at(past, -1)).otherwise(F.get(changes, F.lit(0)))
    return known["ticker"]


def with_identity_status(rows: DataFrame) -> DataFrame:
    """`status`: ok, or why the symbol history cannot be used. Needs `composite_figi,
    requested, reference_date, changes, has_blank`."""
    status = (
        F.when(F.coalesce("composite_figi", F.lit("")) == "", "no_figi")
        .when(F.coalesce("has_blank", F.lit(False)), "invalid_events")
        .when(F.size("changes") == 0, "no_events")
        .when(ticker_on(F.col("changes"), F.col("reference_date")) != F.col("requested"),
              "events_disagree")
        .otherwise("ok")
    )
    return rows.withColumn("status", status)


def change_intervals(identities: DataFrame) -> DataFrame:
    """One row per symbol held: [valid_from, valid_to], open-ended at the last."""
    w = Window.partitionBy("security_key").orderBy("valid_from")
    return (
        identities.select("security_key", "requested", "status", F.inline("changes"))
        .withColumnRenamed("date", "valid_from")
        .withColumn("valid_to", F.date_sub(F.lead("valid_from").over(w), 1))
    )


def segments(identities: DataFrame, start: Column, end: Column) -> DataFrame:
    """(security_key, ticker, start, end): which symbol to ask for on which dates.

    A symbol holds from its change to the day before the next one, the first from `start` on,
    and repeats of one symbol are merged. Where the history is not "ok" the requested symbol
    stands for the whole span.
    """
    rows = identities.withColumns({"_start": start, "_end": end}).where("_start <= _end")
    whole = rows.where(F.col("status") != "ok").select(
        "security_key", F.col("requested").alias("ticker"), F.col("_start").alias("start"),
        F.col("_end").alias("end"),
    )
    per = Window.partitionBy("security_key", "_start", "_end")
    held = (
        rows.where(F.col("status") == "ok")
        .select("security_key", "_start", "_end", F.posexplode("changes").alias("_i", "_c"))
        .select(
            "security_key", "_start", "_end", "_i", "_c.ticker",
            F.col("_c.date").alias("_from"),
            F.lead("_c.date").over(per.orderBy("_i")).alias("_next"),
        )
        .withColumn("_from", F.when(F.col("_i") == 0, F.col("_start")).otherwise(F.col("_from")))
        .withColumn("_from", F.greatest("_from", "_start"))
        .withColumn("_to", F.least(F.coalesce(F.date_sub("_next", 1), F.col("_end")), F.col("_end")))
        .where(F.col("_from") <= F.col("_to"))
    )
    turned = F.coalesce(F.lag("ticker").over(per.orderBy("_i")) != F.col("ticker"), F.lit(True))
    runs = (
        held.withColumn("_turned", turned.cast("int"))
        .withColumn("_run", F.sum("_turned").over(
            per.orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("security_key", "_start", "_end", "_run", "ticker")
        .agg(F.min("_from").alias("start"), F.max("_to").alias("end"))
        .select("security_key", "ticker", "start", "end")
    )
    return runs.unionByName(whole)


def rename_suspects(
    bars: DataFrame, window_sessions: int, min_median: float, listed: DataFrame
) -> DataFrame:
    """Listed tickers missing days of the window but trading enough on the days they have."""
    return (
        bars.join(listed.select("ticker").distinct(), "ticker", "left_semi")
        .groupBy("ticker")
        .agg(
            F.count_distinct("date").alias("days"),
            # At most one bar a session of the window.
            F.median(F.col("close") * F.col("volume")).alias("median_on_days_held"),
        )
        .where((F.col("days") < window_sessions) & (F.col("median_on_days_held") >= min_median))
    )


def stitch(bars: DataFrame, splits: DataFrame, held: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Relabel bars and splits of an old symbol to the current one.

    `held`: one row per old symbol (`ticker_now, ticker_then, start, end`). A segment on any of
    whose days both symbols have bars is left alone for bars. Returns bars, splits and the
    segments stitched.
    """
    spans = held.where(F.col("ticker_now") != F.col("ticker_then"))
    old = interval_join(bars, spans, ("ticker", "ticker_then"), "date", "start", "end", how="inner")
    both = old.select("ticker_now", "ticker_then", "start", "date").join(
        bars.select(F.col("ticker").alias("ticker_now"), "date"), ["ticker_now", "date"], "left_semi"
    )
    clash = both.select("ticker_now", "ticker_then", "start").distinct()
    usable = spans.join(clash, ["ticker_now", "ticker_then", "start"], "left_anti")

    def relabel(rows: DataFrame, day: str, segments_: DataFrame) -> DataFrame:
        s = segments_.select(
            F.col("ticker_now").alias("_now"), F.col("ticker_then").alias("_then"),
            F.col("start").alias("_a"), F.col("end").alias("_b"),
        )
        return interval_join(rows, s, ("ticker", "_then"), day, "_a", "_b").withColumn(
            "ticker", F.coalesce("_now", "ticker")
        ).drop("_now", "_then", "_a", "_b")

    return relabel(bars, "date", usable), relabel(splits, "execution_date", spans), usable


def _dollars(bar: Column) -> Column:
    return bar["close"] * bar["volume"]


def _spans(held: DataFrame, listed: DataFrame) -> DataFrame:
    """The spans in which a listed ticker went by another symbol."""
    current = listed.select(F.col("ticker").alias("ticker_now")).distinct()
    return held.where("ticker_now <> ticker_then").join(current, "ticker_now", "left_semi").select(*SPAN)


def _span_bars(bars: DataFrame, sessions: DataFrame, spans: DataFrame) -> DataFrame:
    """A row a span with the bars of the ticker, `_now`, and the days of the old symbol in the span,
    `_then`, in order of date. Bars move once, to their span; those of symbols that no span names
    are not moved."""
    side = lambda name, now: F.struct(F.col(name).alias("ticker"), F.lit(now).alias("_is_now"))
    sides = spans.select(*SPAN, F.inline(F.array(side("ticker_now", True), side("ticker_then", False))))
    known = bars.join(F.broadcast(sessions.select("date").distinct()), "date", "left_semi")
    met = known.join(sides, "ticker").where(F.col("_is_now") | hs.held_on(F.col("date"), F.col("start"), F.col("end")))
    listed = lambda mine, *fields: F.sort_array(F.collect_list(F.when(mine, F.struct(*fields))))
    return met.groupBy(*SPAN).agg(
        listed(F.col("_is_now"), "date", "close", "volume").alias("_now"), listed(~F.col("_is_now"), "date").alias("_then")
    )


def _span_histories(histories: DataFrame, spans: DataFrame) -> DataFrame:
    """The same from histories that are made anyway: they meet once a span, not once a month and bar."""
    now = histories.select(F.col("ticker").alias("ticker_now"), F.col("_bars").alias("_now"))
    then = histories.select(F.col("ticker").alias("ticker_then"), F.col("_bars").alias("_then"))
    own = F.filter("_then", lambda b: hs.held_on(b["date"], F.col("start"), F.col("end")))
    return spans.join(now, "ticker_now").join(then, "ticker_then").withColumn("_then", own)


def _stitches(spans: DataFrame, months: DataFrame, n: int, min_median: float) -> DataFrame:
    """The stitch log from the bars of both symbols of each span. Only months that both may have
    bars in are looked at."""
    seen = hs.by_month(
        spans, months, SPAN,
        lambda m: F.struct(
            m["rebalance_date"].alias("rebalance_date"),
            hs.within("_now", m).alias("_now"), hs.within("_then", m).alias("_old"),
        ),
        only=lambda m: hs.reaches("_now", m) & hs.reaches("_then", m),
    )
    median = tr.middle(hs.ordered(F.col("_now"), _dollars))
    met = (
        seen.where((F.size("_old") > 0) & (F.size(hs.dates(F.col("_now"))) < n) & (median >= min_median))
        .withColumn("_both", F.arrays_overlap(hs.dates(F.col("_old")), hs.dates(F.col("_now"))))
    )
    return met.groupBy("rebalance_date", "ticker_now", "ticker_then", "start").agg(
        F.sum(F.size("_old")).cast("bigint").alias("bars"),
        F.when(F.first("status") != "ok", "no history")
        .when(F.max("_both"), "clash").otherwise("stitched").alias("outcome"),
    )


def _claimed(histories: DataFrame, log: DataFrame, held: DataFrame) -> DataFrame:
    """Histories with `_claims`, who takes over days of the ticker in which month, and
    `_receives`, the months in which the ticker takes over days of another."""
    moved = log.where("outcome = 'stitched'").select("rebalance_date", "ticker_now", "ticker_then", "start")
    spans = moved.join(held.select("ticker_now", "ticker_then", "start", "end"), ["ticker_now", "ticker_then", "start"])
    claims = spans.groupBy(F.col("ticker_then").alias("ticker")).agg(
        F.collect_list(F.struct("rebalance_date", "ticker_now", "start", "end")).alias("_claims")
    )
    receives = moved.groupBy(F.col("ticker_now").alias("ticker")).agg(F.collect_set("rebalance_date").alias("_receives"))
    return histories.join(claims, "ticker", "left").join(receives, "ticker", "left")


def _renamed_rows(claimed: DataFrame, months: DataFrame, rest: list[str], touched: bool = False) -> DataFrame:
    """A row per month and bar of its window, with the ticker it counts for: `rebalance_date,
    ticker, rest`. `touched`: only where a symbol gives or takes days in that month."""
    of_month = lambda m: lambda c: c["rebalance_date"] == m["rebalance_date"]
    seen = hs.by_month(
        claimed, months, ["ticker"],
        lambda m: F.struct(
            m["rebalance_date"].alias("rebalance_date"), hs.within("_bars", m).alias("_bars"),
            F.filter("_claims", of_month(m)).alias("_claims"), _takes(m).alias("_takes"),
        ),
    )
    if touched:
        seen = seen.where("_takes or size(_claims) > 0")
    rows = seen.select("rebalance_date", "ticker", "_claims", F.inline("_bars"))
    # A symbol may have had several owners: only the span that holds the day counts.
    holds = F.filter("_claims", lambda c: hs.held_on(F.col("date"), c["start"], c["end"]))
    name = F.array_max(F.transform(holds, lambda c: c["ticker_now"]))
    return rows.withColumn("ticker", F.coalesce(name, "ticker")).select("rebalance_date", "ticker", *rest)


def _takes(month: Column) -> Column:
    return F.coalesce(F.array_contains("_receives", month["rebalance_date"]), F.lit(False))


def _history_of(
    bars: DataFrame, rebalances: DataFrame, sessions: DataFrame, n: int
) -> tuple[DataFrame, DataFrame, list[str]]:
    rest = [c for c in bars.columns if c != "ticker"]
    # Several branches read the histories: they are made once, a row a ticker.
    return (
        cut_lineage(hs.histories(bars, sessions, rest)),
        _months_of(rebalances, sessions, n),
        rest,
    )


def _months_of(rebalances: DataFrame, sessions: DataFrame, n: int) -> DataFrame:
    return hs.month_windows(rebalances.select("rebalance_date", "as_of_no"), sessions, n)


def stitch_log(
    bars: DataFrame, rebalances: DataFrame, sessions: DataFrame, listed: DataFrame, held: DataFrame,
    n: int, min_median: float,
) -> DataFrame:
    """The log of `stitched_windows` alone: it needs the bars of renamed securities only."""
    months = _months_of(rebalances, sessions, n)
    return _stitches(_span_bars(bars, sessions, _spans(held, listed)), months, n, min_median)


def stitched_windows(
    bars: DataFrame, rebalances: DataFrame, sessions: DataFrame, listed: DataFrame, held: DataFrame,
    n: int, min_median: float,
) -> tuple[DataFrame, DataFrame]:
    """Each rebalance's bars of its last `n` sessions with renames joined up, and the stitch log.

    Suspects are found in each month's own window; only their old symbols are looked up. `held`:
    one row per symbol a security used (`ticker_now, ticker_then, start, end, status`). The log
    has a row per rebalance and old symbol with bars in the window: `stitched`, `clash` (both
    symbols have bars on one day, nothing is moved) or `no history` (the identity is not ok).
    Bars move once, to their ticker; the rows of the windows are made there, unshuffled.
    """
    histories, months, rest = _history_of(bars, rebalances, sessions, n)
    log = cut_lineage(_stitches(_span_histories(histories, _spans(held, listed)), months, n, min_median))
    return _renamed_rows(_claimed(histories, log, held), months, rest), log


def stitched_measure(
    bars: DataFrame, rebalances: DataFrame, sessions: DataFrame, listed: DataFrame, held: DataFrame,
    n: int, min_median: float,
) -> DataFrame:
    """Per rebalance and ticker of `stitched_windows`: `days` with bars and `median_on_days_held`.

    Where no symbol gives or takes days, the month is measured in the ticker's own array; only the
    bars of the others are put together by a shuffle.
    """
    histories, months, _ = _history_of(bars, rebalances, sessions, n)
    log = cut_lineage(_stitches(_span_histories(histories, _spans(held, listed)), months, n, min_median))
    claimed = _claimed(histories, log, held)
    given = lambda m: F.exists("_claims", lambda c: c["rebalance_date"] == m["rebalance_date"])
    quiet = lambda m: ~_takes(m) & ~F.coalesce(given(m), F.lit(False))
    whole = hs.by_month(
        claimed, months, ["ticker"],
        lambda m: tr.let(hs.within("_bars", m), lambda w: F.struct(
            m["rebalance_date"].alias("rebalance_date"), F.size(hs.dates(w)).cast("bigint").alias("days"),
            tr.middle(hs.ordered(w, _dollars)).alias("median_on_days_held"), quiet(m).alias("_quiet"),
        )),
    )
    whole = whole.where("_quiet and days > 0").select("rebalance_date", "ticker", "days", "median_on_days_held")
    some = claimed.where("_claims is not null or _receives is not null")
    joined = _renamed_rows(some, months, ["date", "close", "volume"], touched=True)
    joined = joined.groupBy("rebalance_date", "ticker").agg(
        F.count_distinct("date").alias("days"),
        F.median(F.col("close") * F.col("volume")).alias("median_on_days_held"),
    )
    return whole.unionByName(joined)


def target_set(snapshots: DataFrame, extra: DataFrame, lists: DataFrame) -> DataFrame:
    """Every security ever selected or asked for, with its listed ticker at each month end.

    A permanent identifier matches lists by identifier, a bare ticker by ticker.
    """
    members = snapshots.select("ticker", "composite_figi").unionByName(
        extra.select("ticker", "composite_figi")
    )
    key = lambda: F.coalesce(
        F.nullif("composite_figi", F.lit("")), F.concat(F.lit("TICKER:"), F.col("ticker"))
    )
    targets = members.select(key().alias("security_key")).distinct()
    listed = lists.select(key().alias("security_key"), "month_end", "ticker")
    return targets.join(listed, "security_key", "left").withColumnRenamed("ticker", "listed_as")


def listing_audit(months: DataFrame) -> DataFrame:
    """Per security and month: usable under which symbol, or why not.

    `months` has the listed symbol at the start and end of the month (null: not listed), the
    history's symbol at both, and the identity status.
    """
    start, end = F.col("listed_at_start"), F.col("listed_at_end")
    clash = lambda a, b: F.coalesce(a != b, F.lit(False))
    verdict = (
        F.when(start.isNull() & end.isNull(), "not listed")
        .when(
            (F.col("status") == "ok")
            & (clash(start, F.col("history_at_start")) | clash(end, F.col("history_at_end"))),
            "ticker history disagrees with the list",
        )
        .when((F.col("status") != "ok") & clash(start, end), "symbol changed, no history")
        .otherwise("usable")
    )
    symbol = F.when(F.col("status") == "ok", F.coalesce("history_at_end", "history_at_start")).otherwise(
        F.coalesce(start, end)
    )
    return months.withColumn("verdict", verdict).withColumn(
        "symbol", F.when(F.col("verdict") == "usable", symbol)
    )


def share_count_status(infos: DataFrame, answers: DataFrame) -> DataFrame:
    """What the share-count lookup of each security found: found, missing, wrong_security or
    not_found. `answers` is keyed by (ticker, date asked)."""
    asked = infos.join(answers, ["ticker_on_date", "shares_date"], "left")
    wrong = (
        (F.coalesce("composite_figi", F.lit("")) != "")
        & (F.coalesce("figi_then", F.lit("")) != "")
        & (F.col("figi_then") != F.col("composite_figi"))
    )
    status = (
        F.when(F.col("answered").isNull(), "not_found")
        .when(wrong, "wrong_security")
        .when(F.coalesce("share_class_shares", F.lit(0.0)) > 0, "found")
        .otherwise("missing")
    )
    usable = F.col("status").isin("found", "missing")
    return asked.withColumn("status", status).withColumns(
        {
            c: F.when(usable & (F.col(c) > 0), F.col(c))
            for c in ("share_class_shares", "weighted_shares")
        }
    )
