"""Coverage reports and reconciliations. They measure; they change nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barscreen.operators import calendar as cal

QUARTER_SESSIONS = 63
SUSPECT_GAP = 126
# Fixed output values: the state of a session's filing coverage.
NO_FILINGS = "no filings at all"
BEFORE_FIRST = "before first filing"
FRESH = "within a quarter of a filing"
OLDER = "one to two quarters"
SUSPECT_HOLE = "over two quarters - suspect hole"
RESULTS_ITEM = "2.02"
VOLUNTARY_ITEMS = ("7.01", "8.01")
THIN_PER_YEAR = 3.0
MULTI_CLASS_TOLERANCE = 0.01
CAP_WARN = 0.25
SAME_PRICE = 0.005
ACTION_DAYS = 30
#: What an audit of a vendor's market caps reports.
VERDICTS = {
    "date": "OK: uses the close on that date",
    "previous": "OK: uses the previous day's close",
    "latest": "LOOK-AHEAD: uses the latest close",
    "both": "CANNOT TELL: price barely moved since",
    "none": "UNCLEAR: matches none of the closes",
    "missing": "MISSING: vendor returned no market cap or share count",
    "not found": "NOT FOUND: vendor has no record of this ticker on this date",
}
#: The report for each set of closes matched, in the order date, previous, latest.
MATCHED_CLOSES = {
    "": VERDICTS["none"], "date": VERDICTS["date"], "previous": VERDICTS["previous"],
    "latest": VERDICTS["latest"], "date+previous": VERDICTS["date"], "date+latest": VERDICTS["both"],
    "previous+latest": VERDICTS["both"], "date+previous+latest": VERDICTS["both"],
}
#: Releases a full year has, and the hour the two statistics come out.
PER_YEAR = {"fomc": 8, "cpi": 12, "payrolls": 12}
STATISTICS_TIME = "08:30"


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(condition.cast("bigint")), F.lit(0))


# --- filings ------------------------------------------------------------------


def filing_coverage(traded: DataFrame, filings: DataFrame, sessions: DataFrame) -> DataFrame:
    """`gap_sessions` since the latest filing per traded session, and the state that gap means.

    A filing on a day without trading counts from the next session; one before the first
    session or after the last says nothing. `traded`: security_key, date, session_no.
    """
    days = cal.session_days(sessions).select(
        F.col("day").alias("filing_date"), F.col("session_no").alias("_filed")
    )
    filed = filings.join(F.broadcast(days), "filing_date").select("security_key", "_filed").distinct()
    known = filings.select("security_key").distinct().withColumn("_any", F.lit(True))
    rows = traded.select("security_key", "date", "session_no", F.lit(None).cast("int").alias("_filed"))
    rows = rows.unionByName(
        filed.select("security_key", F.lit(None).cast("date").alias("date"),
                     F.col("_filed").alias("session_no"), "_filed")
    )
    w = Window.partitionBy("security_key").orderBy("session_no")
    last = F.last("_filed", ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, 0))
    gap = F.col("gap_sessions")
    state = (
        F.when(F.col("_any").isNull(), NO_FILINGS)
        .when(gap.isNull(), BEFORE_FIRST)
        .when(gap <= QUARTER_SESSIONS, FRESH)
        .when(gap <= SUSPECT_GAP, OLDER)
        .otherwise(SUSPECT_HOLE)
    )
    return (
        rows.withColumn("gap_sessions", (F.col("session_no") - last).cast("int"))
        .where(F.col("date").isNotNull())
        .join(known, "security_key", "left")
        .select("security_key", "date", "gap_sessions", state.alias("state"))
    )


def coverage_states(coverage: DataFrame) -> DataFrame:
    """Counts and shares per state."""
    total = F.sum("sessions").over(Window.partitionBy(F.lit(0)))  # at most five rows
    return (
        coverage.groupBy("state")
        .agg(F.count(F.lit(1)).alias("sessions"))
        .withColumn("share", F.col("sessions") / total)
    )


def longest_gaps(coverage: DataFrame, k: int = 10) -> DataFrame:
    worst = coverage.where(F.col("state") == SUSPECT_HOLE)
    per = worst.groupBy("security_key").agg(F.max("gap_sessions").alias("gap_sessions"))
    return per.orderBy(F.desc("gap_sessions"), "security_key").limit(k)


def has_item(items: Column, *wanted: str) -> Column:
    return F.arrays_overlap(F.split(items, ","), F.array(*map(F.lit, wanted)))


def missed_announcements(filings: DataFrame) -> DataFrame:
    """Voluntary filings no results filing covers, on the day or either neighbour."""
    voluntary = filings.where(has_item(F.col("items"), *VOLUNTARY_ITEMS))
    covered = (
        filings.where(has_item(F.col("items"), RESULTS_ITEM))
        .select(
            "security_key",
            F.explode(F.array(*[F.date_add("filing_date", k) for k in (-1, 0, 1)])).alias("filing_date"),
        )
        .distinct()
    )
    return voluntary.join(covered, ["security_key", "filing_date"], "left_anti")


def missed_report(filings: DataFrame) -> DataFrame:
    """One row: filings, those missed, across how many securities, and outside which hours."""
    missed = missed_announcements(filings)
    minute = F.col("minute_et")
    per = missed.groupBy("security_key").agg(
        F.count(F.lit(1)).alias("n"), _count(minute < cal.OPEN_MINUTE).alias("before"),
        _count(minute >= cal.CLOSE_MINUTE).alias("after"),
    )
    found = per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("missed"),
        F.count(F.lit(1)).alias("securities"),
        F.coalesce(F.sum("before"), F.lit(0)).alias("before_open"),
        F.coalesce(F.sum("after"), F.lit(0)).alias("after_close"),
    )
    return filings.agg(F.count(F.lit(1)).alias("filings")).crossJoin(found)


def thin_filers(filings: DataFrame) -> DataFrame:
    """Securities filing fewer than three times a year over their span (a year at least)."""
    years = F.greatest(F.datediff(F.max("filing_date"), F.min("filing_date")) / 365.25, F.lit(1.0))
    return (
        filings.groupBy("security_key")
        .agg(F.count(F.lit(1)).alias("filings"), years.alias("years"))
        .withColumn("per_year", F.col("filings") / F.col("years"))
        .where(F.col("per_year") < THIN_PER_YEAR)
    )


# --- the macro table ----------------------------------------------------------


def macro_complaints(events: DataFrame, years: DataFrame) -> DataFrame:
    """`severity, year, kind, date, found, complaint`.

    Blocking: a kind absent for a year, or a statistic at another hour. Review: an unexpected
    number, or payrolls not on a Friday.
    """
    kinds = F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.lit(n).alias("expected")) for k, n in PER_YEAR.items()
    ]))
    grid = years.select("year", kinds.alias("_k")).select("year", "_k.kind", "_k.expected")
    counts = events.groupBy(F.year("date").alias("year"), "kind").agg(
        F.count(F.lit(1)).alias("found")
    )
    yearly = (
        grid.join(counts, ["year", "kind"], "left")
        .withColumn("found", F.coalesce("found", F.lit(0)))
        .where(F.col("found") != F.col("expected"))
        .select(
            F.when(F.col("found") == 0, "blocking").otherwise("review").alias("severity"), "year",
            "kind", F.lit(None).cast("date").alias("date"), "found",
            F.when(F.col("found") == 0, "nothing found").otherwise("unexpected number").alias(
                "complaint"),
        )
    )
    odd_hour = F.col("kind").isin("cpi", "payrolls") & (F.col("time_et") != STATISTICS_TIME)
    not_friday = (F.col("kind") == "payrolls") & (F.weekday("date") != 4)

    def single(condition: Column, severity: str, complaint: str) -> DataFrame:
        return events.where(condition).select(
            F.lit(severity).alias("severity"), F.year("date").alias("year"), "kind", "date",
            F.lit(None).cast("bigint").alias("found"), F.lit(complaint).alias("complaint"),
        )

    return yearly.unionByName(single(odd_hour, "blocking", "wrong hour")).unionByName(
        single(not_friday, "review", "not a Friday")
    )


def meetings_without_statement(meetings: DataFrame, decisions: DataFrame) -> DataFrame:
    """Meetings that published minutes but have no statement on the day."""
    return meetings.join(decisions, "date", "left_anti")


# --- the universe's inputs ----------------------------------------------------


def history_gaps(infos: DataFrame) -> DataFrame:
    return infos.where(F.col("status") != "ok")


def listing_date_differences(infos: DataFrame) -> DataFrame:
    """Where the listing date and the first ticker event disagree, and the date used."""
    return infos.where(~F.col("list_date").eqNullSafe(F.col("first_event_date"))).withColumn(
        "listing_date_used", F.least("list_date", "first_event_date")
    )


def share_count_problems(shares: DataFrame) -> DataFrame:
    return shares.where(F.col("status") != "found")


def multi_class(shares: DataFrame) -> DataFrame:
    """Companies whose share class is not the whole company, where both counts are trustworthy."""
    fraction = F.try_divide(F.col("share_class_shares"), F.col("weighted_shares"))
    return (
        shares.where(F.col("shares_date") >= F.lit("2022-06-01").cast("date"))
        .withColumn("share_class_fraction", fraction)
        .where(F.abs(F.col("share_class_fraction") - 1) > MULTI_CLASS_TOLERANCE)
    )


def market_cap_ratio(selected: DataFrame, vendor: DataFrame) -> DataFrame:
    """Our market cap over the vendor's, and whether it wants a look."""
    ratio = F.try_divide(F.col("market_cap"), F.col("vendor_market_cap"))
    far = F.coalesce(F.abs(F.col("ratio") - 1) > CAP_WARN, F.lit(True))
    return (
        selected.join(vendor, ["rebalance_date", "ticker"], "left")
        .withColumn("ratio", ratio)
        .withColumn("warn", far)
        .select("rebalance_date", "ticker", "market_cap", "vendor_market_cap", "ratio", "warn")
    )


def lookahead_verdict(implied: Column, on_date: Column, previous: Column, latest: Column, found: Column) -> Column:
    """What the set of closes that an implied price equals (to half a percent) says about it."""
    closes = {"date": on_date, "previous": previous, "latest": latest}
    near = [F.when(F.abs(F.try_divide(implied, c) - 1) <= SAME_PRICE, F.lit(n)) for n, c in closes.items()]
    matched = F.array_join(F.array_compact(F.array(*near)), "+")
    table = F.create_map(*[F.lit(x) for pair in MATCHED_CLOSES.items() for x in pair])
    stated = F.when(found & implied.isNotNull(), table[matched])
    return F.coalesce(stated, F.when(found, VERDICTS["missing"]).otherwise(VERDICTS["not found"]))


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def share_fields_summary(rows: DataFrame) -> DataFrame:
    """Presence of each share field, and how the two counts compare where both exist."""
    both = F.try_divide(F.col("share_class_shares"), F.col("weighted_shares"))
    return rows.agg(
        F.count(F.lit(1)).alias("cases"),
        F.count("weighted_shares").alias("with_weighted"),
        F.count("share_class_shares").alias("with_share_class"),
        F.count("market_cap").alias("with_market_cap"),
        _count(F.col("share_class_shares").isNull() & F.col("market_cap").isNull()).alias("neither"),
        F.count(both).alias("with_both"),
        _count(both == 1).alias("identical"),
        F.min(both).alias("lowest_ratio"),
        F.max(both).alias("highest_ratio"),
    )


def count_stability(history: DataFrame, key: str, value: str) -> DataFrame:
    """Does a count change with the date asked for? Distinct values and spread per key.

    The distinct count is a grouped count of grouped values, combined before each shuffle.
    """
    values = history.where(F.col(value).isNotNull()).groupBy(key, value).agg(
        F.count(F.lit(1)).alias("_n")
    )
    spread = F.when(F.min(value) != 0, F.try_divide(F.max(value), F.min(value)) - 1).otherwise(0.0)
    return values.groupBy(key).agg(
        F.count(F.lit(1)).alias("distinct_values"), F.sum("_n").alias("dates"),
        spread.alias("spread"),
    )


# --- bars ---------------------------------------------------------------------


def reconcile_daily(ours: DataFrame, vendor: DataFrame) -> DataFrame:
    """Our daily bar against the vendor's, per cent different, per security and session."""
    fields = ("open", "high", "low", "close", "volume")
    theirs = vendor.select("ticker", "date", *[F.col(c).alias(f"vendor_{c}") for c in fields])
    return ours.join(theirs, ["ticker", "date"], "left").select(
        "ticker", "date",
        *[
            ((F.try_divide(F.col(c), F.col(f"vendor_{c}")) - 1) * 100).alias(f"{c}_pct")
            for c in fields
        ],
        F.col("vendor_close").isNull().alias("vendor_missing"),
    )


def actions_near(cases: DataFrame, actions: DataFrame, column: str) -> DataFrame:
    """Splits or dividends within thirty days of each case."""
    near = F.abs(F.datediff(F.col(column), F.col("date"))) <= ACTION_DAYS
    return cases.join(actions, "ticker").where(near)


def needs_adjusted_copy(cases: DataFrame, splits: DataFrame) -> DataFrame:
    """Cases a later split puts on another share basis."""
    later = splits.groupBy("ticker").agg(F.max("execution_date").alias("_last"))
    return cases.join(later, "ticker", "left").withColumn(
        "adjusted_copy", F.coalesce(F.col("_last") > F.col("date"), F.lit(False))
    ).drop("_last")


def missing_bars(securities: DataFrame, bars: DataFrame, sessions: DataFrame) -> DataFrame:
    """Securities with sessions without bars: how many, and the first.

    How many are missing needs only a count. The first one lies right before the first break in
    a security's numbered sessions, so no grid of securities and sessions is built.
    """
    first_no = F.broadcast(sessions.agg(F.min("session_no").alias("_lo"), F.count(F.lit(1)).alias("_all")))
    have = bars.select("security_key", "date").distinct().join(
        F.broadcast(sessions.select("date", "session_no")), "date"
    ).select("security_key", "session_no")
    w = Window.partitionBy("security_key").orderBy("session_no")
    # In an unbroken run from the start, number and rank differ by the first session's number.
    numbered = have.withColumn("_rank", F.row_number().over(w) - 1).crossJoin(first_no)
    unbroken = F.max(
        F.when(F.col("session_no") - F.col("_lo") == F.col("_rank"), F.col("session_no"))
    )
    per = numbered.groupBy("security_key").agg(
        F.count(F.lit(1)).alias("_have"), unbroken.alias("_unbroken")
    )
    dates = sessions.select(F.col("session_no").alias("_gap_no"), F.col("date").alias("first_missing"))
    return (
        securities.select("security_key").distinct()
        .join(per, "security_key", "left")
        .crossJoin(first_no)
        .withColumn("missing", F.col("_all") - F.coalesce("_have", F.lit(0)))
        .where(F.col("missing") > 0)
        .withColumn("_gap_no", F.coalesce(F.col("_unbroken") + 1, F.col("_lo")))
        .join(F.broadcast(dates), "_gap_no", "left")
        .select("security_key", "missing", "first_missing")
    )
