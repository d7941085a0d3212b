"""Event flags and audits over the order calendar."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from barscreen.operators import audits as au
from barscreen.operators import bars as bo
from barscreen.operators import flags as fl
from barscreen.plans import adapters as ad
from barscreen.plans.catalog import base as b
from barscreen.plans.catalog import universe as cu
from barscreen.plans.catalog.bars import SPLITS
from barscreen.plans.catalog.base import chain, query, select, tidy

# Orders as dated company events: the customer's nation is the security, the order key a clock.
ORDERS = """ords AS (SELECT n_name AS security_key, CAST(o_orderdate AS DATE) AS date, CAST(o_orderkey % 1440 AS INTEGER) AS minute_et,
    o_orderkey, o_orderpriority, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
REACTED = """(SELECT min(s.date) FROM sessions s WHERE s.date >= o.date + CASE WHEN o.minute_et >= (CASE WHEN EXISTS (
      SELECT 1 FROM sessions h WHERE h.date = o.date AND h.is_half_day) THEN 780 ELSE 960 END) THEN 1 ELSE 0 END)"""
FIRST = "(SELECT min(date) FROM sessions)"


def orders(spark, sf):
    customer = ad.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = ad.table(spark, sf, "nation").select("n_nationkey", "n_name")
    return (
        ad.table(spark, sf, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("security_key"), F.col("o_orderdate").cast("date").alias("date"),
            (F.col("o_orderkey") % 1440).cast("int").alias("minute_et"), "o_orderkey",
            "o_orderpriority", "o_totalprice",
        )
    )


@query(
    select(
        chain(b.SESSIONS, ORDERS),
        f"(SELECT o.o_orderkey, o.date, o.minute_et, CASE WHEN o.date >= {FIRST} THEN {REACTED} END AS reacted_on FROM ords o)",
        "o_orderkey date minute_et reacted_on",
    )
)
def reacting_sessions(spark, sf):
    found = fl.reacting_session(orders(spark, sf), ad.order_sessions(spark, sf), "date", "minute_et")
    return found.select("o_orderkey", "date", "minute_et", "reacted_on")


RELEASES = """releases AS (SELECT date, ['fomc', 'cpi', 'payrolls'][CAST(o_orderkey % 3 + 1 AS INTEGER)] AS kind,
    CASE WHEN o_orderkey % 5 <> 0 THEN CAST((o_orderkey * 37) % 1440 AS INTEGER) END AS minute_et,
    CASE WHEN o_orderkey % 5 <> 0 THEN '08:30' ELSE '' END AS time_et FROM ords)"""
MACRO = f"""reacted AS (SELECT DISTINCT kind, CASE WHEN o.date >= {FIRST} THEN {REACTED} END AS date FROM releases o),
macro AS (SELECT s.date, {', '.join(f"EXISTS (SELECT 1 FROM reacted r WHERE r.date = s.date AND r.kind = '{k}') AS {k}" for k in fl.MACRO)} FROM sessions s)"""


def releases(spark, sf):
    key = F.col("o_orderkey")
    kinds = F.array(*map(F.lit, fl.MACRO))
    return orders(spark, sf).select(
        "date", F.get(kinds, (key % 3).cast("int")).alias("kind"),
        F.when(key % 5 != 0, ((key * 37) % 1440).cast("int")).alias("minute_et"),
        F.when(key % 5 != 0, "08:30").otherwise("").alias("time_et"),
    )


@query(select(chain(b.SESSIONS, ORDERS, RELEASES, MACRO), "macro", "date fomc cpi payrolls"))
def macro_flags(spark, sf):
    return fl.macro_flags(ad.order_sessions(spark, sf), releases(spark, sf))


CALENDAR = """exp AS (SELECT (SELECT max(date) FROM sessions s WHERE s.date <= f AND s.date >= m) AS date
  FROM (SELECT m, m + CAST((4 - (isodow(m) - 1) + 7) % 7 + 14 AS INTEGER) AS f FROM (SELECT DISTINCT CAST(date_trunc('month', date) AS DATE) AS m FROM sessions))),
cal AS (SELECT date, e AS option_expiry, e AND q AS triple_witching, turn AS month_end, CASE WHEN turn IS NOT NULL THEN turn AND q END AS quarter_end,
    is_half_day AS half_day, CASE WHEN prv IS NOT NULL THEN (SELECT count(*) FROM (SELECT CAST(unnest(generate_series(prv + 1, date - 1, INTERVAL 1 DAY)) AS DATE) AS d) WHERE isodow(d) < 6) > 0 END AS day_after_holiday
  FROM (SELECT *, date IN (SELECT date FROM exp WHERE date IS NOT NULL) AS e, month(date) IN (3, 6, 9, 12) AS q, month(lead(date) OVER w) <> month(date) AS turn, lag(date) OVER w AS prv
    FROM sessions WINDOW w AS (ORDER BY date)))"""


@query(select(chain(b.SESSIONS, CALENDAR), "cal", "date " + " ".join(fl.CALENDAR)))
def calendar_flags(spark, sf):
    return fl.calendar_flags(ad.order_sessions(spark, sf))


TRADED = "traded AS (SELECT DISTINCT security_key, date, session_no FROM ords JOIN sessions USING (date))"
EARNINGS = f"""ann AS (SELECT DISTINCT security_key, s.session_no FROM (SELECT o.security_key, CASE WHEN o.date >= {FIRST} THEN {REACTED} END AS date
    FROM ords o WHERE o_orderpriority = '1-URGENT') JOIN sessions s USING (date)),
earn AS (SELECT t.security_key, t.date, t.session_no, CASE WHEN gap <= 126 THEN gap <= 1 END AS earnings
  FROM (SELECT t.*, (SELECT min(abs(a.session_no - t.session_no)) FROM ann a WHERE a.security_key = t.security_key) AS gap FROM traded t) t)"""


def traded(spark, sf):
    sessions = ad.order_sessions(spark, sf).select("date", "session_no")
    return orders(spark, sf).select("security_key", "date").distinct().join(sessions, "date")


def announcements(spark, sf):
    return orders(spark, sf).where(F.col("o_orderpriority") == "1-URGENT")


@query(select(chain(b.SESSIONS, ORDERS, TRADED, EARNINGS), "earn", "security_key date session_no earnings"))
def earnings_flags(spark, sf):
    reacted = fl.reacting_session(announcements(spark, sf), ad.order_sessions(spark, sf), "date", "minute_et")
    reacted = reacted.where("reacted_no is not null").select("security_key", F.col("reacted_no").alias("session_no"))
    return fl.earnings_flags(traded(spark, sf), reacted)


EVENT_TABLE = f"""evt AS (SELECT e.security_key, e.date, earnings,
    EXISTS (SELECT 1 FROM ords d WHERE d.security_key = e.security_key AND d.date = e.date AND o_orderpriority = '2-HIGH') AS ex_dividend,
    EXISTS (SELECT 1 FROM ords d WHERE d.security_key = e.security_key AND d.date = e.date AND o_orderpriority = '3-MEDIUM') AS split,
    CAST(NULL AS BOOLEAN) AS index_change, CAST(NULL AS BOOLEAN) AS halt, {', '.join(fl.CALENDAR)}, fomc, cpi, payrolls
  FROM earn e JOIN cal USING (date) JOIN macro USING (date))"""
EVENT_CTES = chain(b.SESSIONS, ORDERS, RELEASES, MACRO, CALENDAR, TRADED, EARNINGS, EVENT_TABLE)


@query(
    f"WITH {EVENT_CTES} SELECT *, security_key AS requested_ticker, {' OR '.join(fl.OBSERVABLE)} AS any_event FROM evt"
)
def event_table(spark, sf):
    rows = orders(spark, sf)

    def dated(priority: str, column: str):
        mine = rows.where(F.col("o_orderpriority") == priority)
        return mine.select(F.col("security_key").alias("requested_ticker"), F.col("date").alias(column))

    securities = traded(spark, sf).withColumn("requested_ticker", F.col("security_key"))
    return fl.event_table(
        securities, ad.order_sessions(spark, sf), announcements(spark, sf),
        dated("2-HIGH", "ex_dividend_date"), dated("3-MEDIUM", "execution_date"),
        releases(spark, sf),
    )


# --- filings ------------------------------------------------------------------

COVERAGE = """filed AS (SELECT DISTINCT security_key, (SELECT min(session_no) FROM sessions s WHERE s.date >= o.date) AS n
  FROM ords o WHERE o_orderpriority = '1-URGENT' AND n_ok AND o.date >= (SELECT min(date) FROM sessions)),
gaps AS (SELECT t.security_key, t.date, CAST(t.session_no - (SELECT max(n) FROM filed f WHERE f.security_key = t.security_key AND n <= t.session_no) AS INTEGER) AS gap_sessions FROM traded t),
cover AS (SELECT *, CASE WHEN security_key NOT IN (SELECT security_key FROM filed) THEN 'no filings at all' WHEN gap_sessions IS NULL THEN 'before first filing'
    WHEN gap_sessions <= 63 THEN 'within a quarter of a filing' WHEN gap_sessions <= 126 THEN 'one to two quarters' ELSE 'over two quarters - suspect hole' END AS state FROM gaps)""".replace(
    "n_ok", "security_key NOT LIKE '%7'"
)
COVERAGE_CTES = chain(b.SESSIONS, ORDERS, TRADED, COVERAGE)


def coverage(spark, sf, missing_year=None):
    filings = announcements(spark, sf).where(~F.col("security_key").endswith("7"))
    if missing_year:
        filings = filings.where(F.year("date") != missing_year)
    filings = filings.select("security_key", F.col("date").alias("filing_date"))
    return au.filing_coverage(traded(spark, sf), filings, ad.order_sessions(spark, sf))


@query(select(COVERAGE_CTES, "cover", "security_key date gap_sessions state"))
def filing_coverage(spark, sf):
    return coverage(spark, sf)


@query(
    f"WITH {COVERAGE_CTES} SELECT state, count(*) AS sessions, round(count(*) / (SELECT count(*) FROM cover), 6) + 0.0 AS share FROM cover GROUP BY state"
)
def coverage_states(spark, sf):
    return tidy(au.coverage_states(coverage(spark, sf)))


GAP_CTES = COVERAGE_CTES.replace("NOT LIKE '%7'", "NOT LIKE '%7' AND year(o.date) <> 1997")


@query(
    f"""WITH {GAP_CTES} SELECT security_key, max(gap_sessions) AS gap_sessions FROM cover WHERE state LIKE 'over%'
GROUP BY 1 ORDER BY gap_sessions DESC, security_key LIMIT 10"""
)
def longest_gaps(spark, sf):
    """With the filings of one year missing: few securities have a gap that long by themselves."""
    return au.longest_gaps(coverage(spark, sf, missing_year=1997))


FILINGS = """filings AS (SELECT security_key, date AS filing_date, minute_et, o_orderkey,
    ['2.02,9.01', '7.01', '8.01,9.01', '5.02'][CAST(o_orderkey % 4 + 1 AS INTEGER)] AS items FROM ords),
missed AS (SELECT * FROM filings v WHERE (items LIKE '%7.01%' OR items LIKE '%8.01%') AND NOT EXISTS (
  SELECT 1 FROM filings r WHERE r.security_key = v.security_key AND r.items LIKE '%2.02%' AND abs(r.filing_date - v.filing_date) <= 1))"""


def filings(spark, sf):
    items = F.array(*map(F.lit, ("2.02,9.01", "7.01", "8.01,9.01", "5.02")))
    return orders(spark, sf).select(
        "security_key", F.col("date").alias("filing_date"), "minute_et", "o_orderkey",
        F.get(items, (F.col("o_orderkey") % 4).cast("int")).alias("items"),
    )


@query(select(chain(ORDERS, FILINGS), "missed", "o_orderkey security_key filing_date items"))
def missed_announcements(spark, sf):
    found = au.missed_announcements(filings(spark, sf))
    return found.select("o_orderkey", "security_key", "filing_date", "items")


@query(
    f"""WITH {chain(ORDERS, FILINGS)} SELECT (SELECT count(*) FROM filings) AS filings, count(*) AS missed, count(DISTINCT security_key) AS securities,
  count(*) FILTER (minute_et < 570) AS before_open, count(*) FILTER (minute_et >= 960) AS after_close FROM missed"""
)
def missed_report(spark, sf):
    return au.missed_report(filings(spark, sf))


@query(
    """WITH per AS (SELECT 'C' || o_custkey AS security_key, count(*) AS filings, greatest(date_diff('day', min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE))) / 365.25, 1.0) AS years
  FROM orders GROUP BY 1) SELECT security_key, filings, round(filings / years, 6) + 0.0 AS per_year FROM per WHERE filings / years < 3"""
)
def thin_filers(spark, sf):
    rows = ad.table(spark, sf, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("security_key"),
        F.col("o_orderdate").cast("date").alias("filing_date"),
    )
    return tidy(au.thin_filers(rows).select("security_key", "filings", "per_year"))


@query(
    f"""WITH {chain(ORDERS, RELEASES)}, years AS (SELECT DISTINCT CAST(year(date) AS INTEGER) AS year FROM ords),
want AS (SELECT year, k.kind, k.expected FROM years, (VALUES ('fomc', 8), ('cpi', 12), ('payrolls', 12)) k(kind, expected)),
found AS (SELECT year, kind, expected, (SELECT count(*) FROM releases r WHERE year(r.date) = w.year AND r.kind = w.kind) AS found FROM want w)
SELECT CASE WHEN found = 0 THEN 'blocking' ELSE 'review' END AS severity, year, kind, CAST(NULL AS DATE) AS date, found, CASE WHEN found = 0 THEN 'nothing found' ELSE 'unexpected number' END AS complaint
FROM found WHERE found <> expected
UNION ALL SELECT 'blocking', year(date), kind, date, NULL, 'wrong hour' FROM releases WHERE kind IN ('cpi', 'payrolls') AND time_et <> '08:30'
UNION ALL SELECT 'review', year(date), kind, date, NULL, 'not a Friday' FROM releases WHERE kind = 'payrolls' AND isodow(date) <> 5"""
)
def macro_complaints(spark, sf):
    years = orders(spark, sf).select(F.year("date").alias("year")).distinct()
    return au.macro_complaints(releases(spark, sf), years)


@query(
    f"WITH {chain(ORDERS, RELEASES)} SELECT DISTINCT date FROM releases WHERE kind = 'fomc' AND date NOT IN (SELECT date FROM ords WHERE o_orderpriority = '1-URGENT')"
)
def meetings_without_statement(spark, sf):
    meetings = releases(spark, sf).where(F.col("kind") == "fomc").select("date").distinct()
    decisions = orders(spark, sf).where(F.col("o_orderpriority") == "1-URGENT").select("date").distinct()
    return au.meetings_without_statement(meetings, decisions)


# --- the universe's inputs ----------------------------------------------------


@query(select(cu.SECURITIES, "(SELECT ticker, list_date, first_event_date, least(list_date, first_event_date) AS listing_date_used FROM securities WHERE list_date IS DISTINCT FROM first_event_date)",
              "ticker list_date first_event_date listing_date_used"))
def listing_date_differences(spark, sf):
    found = au.listing_date_differences(cu.securities(spark, sf))
    return found.select("ticker", "list_date", "first_event_date", "listing_date_used")


@query(select(cu.CHANGES, "ident", "security_key status", tail="WHERE status <> 'ok'"))
def history_gaps(spark, sf):
    return au.history_gaps(cu.identities(spark, sf)).select("security_key", "status")


@query(b.ORACLES["share_count_status"].replace("END AS weighted_shares FROM st", "END AS weighted_shares FROM st WHERE status <> 'found'"))
def share_count_problems(spark, sf):
    found = au.share_count_problems(cu.share_counts(spark, sf))
    return found.select("ticker_on_date", "status", "share_class_shares", "weighted_shares")


@query(
    f"WITH shares AS ({b.ORACLES['share_count_status']}) SELECT ticker_on_date, round(share_class_shares / weighted_shares, 6) + 0.0 AS share_class_fraction FROM shares WHERE abs(share_class_shares / weighted_shares - 1) > 0.01"
)
def multi_class(spark, sf):
    found = au.multi_class(cu.share_counts(spark, sf))
    return tidy(found.select("ticker_on_date", "share_class_fraction"))


@query(
    f"""WITH {cu.RATED}, cmp AS (SELECT rebalance_date, ticker, market_cap, CASE WHEN CAST(substr(ticker, 2) AS BIGINT) % 7 <> 0 THEN share_class_shares * 1500 END AS vendor_market_cap FROM picked)
SELECT rebalance_date, ticker, market_cap, vendor_market_cap, round(market_cap / vendor_market_cap, 6) + 0.0 AS ratio, coalesce(abs(market_cap / vendor_market_cap - 1) > 0.25, true) AS warn FROM cmp"""
)
def market_cap_audit(spark, sf):
    chosen = b.stored(spark, sf, "universe", lambda: cu.selected(spark, sf))
    vendor = cu.securities(spark, sf).where(F.substring("ticker", 2, 20).cast("bigint") % 7 != 0)
    vendor = vendor.select("ticker", (F.col("share_class_shares") * 1500).alias("vendor_market_cap"))
    asked = chosen.select("rebalance_date", "ticker").join(vendor, "ticker")
    return tidy(au.market_cap_ratio(chosen, asked), exact="market_cap vendor_market_cap")


IMPLIED = f"""imp AS (SELECT security_key, date, close AS on_date, lag(close) OVER w AS previous, last_value(close) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS latest, CAST(volume AS BIGINT) AS v
  FROM days WINDOW w AS ({b.DAY_W})),
imp2 AS (SELECT *, v % 13 <> 0 AS found, CASE WHEN v % 11 = 0 THEN NULL WHEN v % 4 = 0 THEN on_date * 1.001 WHEN v % 4 = 1 THEN previous * 1.002 WHEN v % 4 = 2 THEN latest ELSE on_date * 1.3 END AS implied FROM imp)"""


@query(
    f"""WITH {chain(b.days('supplier', 'week'), IMPLIED)}, same AS (SELECT *, coalesce(abs(implied / on_date - 1) <= 0.005, false) AS a, coalesce(abs(implied / previous - 1) <= 0.005, false) AS p, coalesce(abs(implied / latest - 1) <= 0.005, false) AS l FROM imp2)
SELECT CASE WHEN NOT found THEN 'NOT FOUND: vendor has no record of this ticker on this date' WHEN implied IS NULL THEN 'MISSING: vendor returned no market cap or share count'
  WHEN (a OR p) AND l THEN 'CANNOT TELL: price barely moved since' WHEN a THEN 'OK: uses the close on that date' WHEN p THEN 'OK: uses the previous day''s close'
  WHEN l THEN 'LOOK-AHEAD: uses the latest close' ELSE 'UNCLEAR: matches none of the closes' END AS verdict, count(*) AS n
FROM same GROUP BY 1"""
)
def lookahead_verdicts(spark, sf):
    w = Window.partitionBy("security_key").orderBy("date")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    v = F.col("volume").cast("bigint")
    rows = cu.supplier_bars(spark, sf).select(
        "security_key", F.col("close").alias("on_date"), F.lag("close").over(w).alias("previous"),
        F.last("close").over(whole).alias("latest"), v.alias("v"),
    )
    v = F.col("v")
    implied = (
        F.when(v % 11 == 0, None)
        .when(v % 4 == 0, F.col("on_date") * 1.001)
        .when(v % 4 == 1, F.col("previous") * 1.002)
        .when(v % 4 == 2, F.col("latest"))
        .otherwise(F.col("on_date") * 1.3)
    )
    rows = rows.withColumn("implied", implied)
    verdict = au.lookahead_verdict(
        F.col("implied"), F.col("on_date"), F.col("previous"), F.col("latest"), v % 13 != 0
    )
    return au.value_counts(rows.withColumn("verdict", verdict), "verdict")


@query(
    """WITH f AS (SELECT CASE WHEN c_acctbal > 0 THEN c_acctbal END AS share_class_shares, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal WHEN c_custkey % 3 = 1 THEN c_acctbal * 2 END AS weighted_shares,
  CASE WHEN c_nationkey % 4 <> 0 THEN c_acctbal * 10 END AS market_cap FROM customer)
SELECT count(*) AS cases, count(weighted_shares) AS with_weighted, count(share_class_shares) AS with_share_class, count(market_cap) AS with_market_cap,
  count(*) FILTER (share_class_shares IS NULL AND market_cap IS NULL) AS neither, count(share_class_shares / weighted_shares) AS with_both,
  count(*) FILTER (share_class_shares / weighted_shares = 1) AS identical, min(share_class_shares / weighted_shares) AS lowest_ratio, max(share_class_shares / weighted_shares) AS highest_ratio FROM f"""
)
def share_fields(spark, sf):
    k, balance = F.col("c_custkey"), F.col("c_acctbal")
    rows = ad.table(spark, sf, "customer").select(
        F.when(balance > 0, balance).alias("share_class_shares"),
        F.when(k % 3 == 0, balance).when(k % 3 == 1, balance * 2).alias("weighted_shares"),
        F.when(F.col("c_nationkey") % 4 != 0, balance * 10).alias("market_cap"),
    )
    return au.share_fields_summary(rows)


@query(
    "SELECT 'S' || l_suppkey AS ticker, count(DISTINCT l_quantity) AS distinct_values, count(l_quantity) AS dates, round(max(l_quantity) / min(l_quantity) - 1, 6) + 0.0 AS spread FROM lineitem GROUP BY 1"
)
def count_stability(spark, sf):
    rows = ad.table(spark, sf, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("ticker"), "l_quantity"
    )
    return tidy(au.count_stability(rows, "ticker", "l_quantity"))


# --- bars ---------------------------------------------------------------------

VENDOR = f"vendor AS (SELECT security_key AS ticker, date, {b.OHLCV} FROM trades WHERE q > 5 GROUP BY ALL)"


@query(
    f"""WITH {chain(b.days('supplier', 'week'), VENDOR)}
SELECT d.security_key AS ticker, d.date, {', '.join(f'round((d.{c} / v.{c} - 1) * 100, 6) + 0.0 AS {c}_pct' for c in ('open', 'high', 'low', 'close', 'volume'))}, v.close IS NULL AS vendor_missing
FROM days d LEFT JOIN vendor v ON v.ticker = d.security_key AND v.date = d.date"""
)
def reconciled_bars(spark, sf):
    vendor = ad.trades(spark, sf, "supplier", "week").where(F.col("volume") > 5)
    vendor = vendor.groupBy("ticker", "date").agg(*bo.ohlcv())
    return tidy(au.reconcile_daily(cu.supplier_bars(spark, sf), vendor))


CASES = "cases AS (SELECT security_key AS ticker, date FROM days)"


@query(
    f"""WITH {chain(b.days('supplier', 'week'), SPLITS, CASES)} SELECT ticker, c.date, execution_date, split_from, split_to FROM cases c JOIN splits USING (ticker) WHERE abs(date_diff('day', c.date, execution_date)) <= 30"""
)
def actions_near(spark, sf):
    return au.actions_near(_cases(spark, sf), ad.splits(spark, sf), "execution_date")


def _cases(spark, sf):
    return cu.supplier_bars(spark, sf).select("ticker", "date")


@query(
    f"""WITH {chain(b.days('supplier', 'week'), SPLITS, CASES)} SELECT c.ticker, c.date, EXISTS (SELECT 1 FROM splits s WHERE s.ticker = c.ticker AND s.execution_date > c.date) AS adjusted_copy FROM cases c"""
)
def needs_adjusted_copy(spark, sf):
    return au.needs_adjusted_copy(_cases(spark, sf), ad.splits(spark, sf))


@query(
    f"""WITH {chain(b.days('supplier', 'week'), b.WEEKS)}
SELECT 'S' || s_suppkey AS security_key, count(*) AS missing, min(w.date) AS first_missing FROM supplier CROSS JOIN weeks w
WHERE NOT EXISTS (SELECT 1 FROM days d WHERE d.security_key = 'S' || s_suppkey AND d.date = w.date) GROUP BY 1"""
)
def missing_bars(spark, sf):
    bars = cu.supplier_bars(spark, sf)
    names = cu.securities(spark, sf).select(F.col("ticker").alias("security_key"))
    return au.missing_bars(names, bars, ad.sessions_of(bars))
