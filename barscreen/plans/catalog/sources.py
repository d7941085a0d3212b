"""Landed JSON, HTML pages and stored tables, made from the given tables and read back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from barscreen.operators import audits as au
from barscreen.operators import bars as bo
from barscreen.operators import patterns as pt
from barscreen.plans import adapters as ad
from barscreen.plans.catalog import base as b
from barscreen.plans.catalog import flags as cfl
from barscreen.plans.catalog import screens as cs
from barscreen.plans.catalog import study as cst
from barscreen.plans.catalog import universe as cu
from barscreen.plans.catalog.bars import SPLITS
from barscreen.plans.catalog.features import stored_features
from barscreen.plans.catalog.base import chain, query, select, tidy
from barscreen.session import shared_folder
from barscreen.sources import landed, pages, store
from barscreen.streaming import incremental


def scratch(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}/{uuid.uuid4().hex}"


# --- landed JSON ----------------------------------------------------------------


@query(
    """SELECT 'U' || user_id AS security_key, epoch_ms_ts AS timestamp_utc, CAST(epoch_ms_ts - INTERVAL 5 HOUR AS DATE) AS date_et, value AS close, 1.0 AS volume, event_id AS transactions
FROM (SELECT *, make_timestamp(epoch_us(ts) // 1000 * 1000) AS epoch_ms_ts FROM events) WHERE CAST(epoch_ms_ts - INTERVAL 5 HOUR AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"""
)
def minute_json(spark, sf):
    events = ad.table(spark, sf, "events")
    user = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    micros = F.timestamp_diff(
        "MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz")
    )
    value = F.col("value")
    row = F.struct(
        user.alias("ticker"), user.alias("requested_ticker"), user.alias("security_key"),
        F.floor(micros / 1000).alias("t"), value.alias("o"), value.alias("h"), value.alias("l"),
        value.alias("c"), F.lit(1.0).alias("v"), value.alias("vw"), F.col("event_id").alias("n"),
    )
    path = scratch(spark, "minutes")
    events.select(F.to_json(row)).write.text(path)
    kept = landed.read_minutes(spark, path, dt.date(2024, 1, 5), dt.date(2024, 1, 20))
    return kept.select("security_key", "timestamp_utc", "date_et", "close", "volume", "transactions")


@query(
    f"""WITH {b.days('supplier', 'week')} SELECT security_key AS ticker, DATE '1998-06-15' AS date, open, high, low, close, volume, transactions FROM days WHERE date = DATE '1998-06-15'"""
)
def grouped_daily(spark, sf):
    bars = cu.supplier_bars(spark, sf).where(F.col("date") == F.lit("1998-06-15").cast("date"))
    sent = F.to_json(
        F.struct(
            F.col("ticker").alias("T"), F.col("open").alias("o"), F.col("high").alias("h"),
            F.col("low").alias("l"), F.col("close").alias("c"), F.col("volume").alias("v"),
            F.col("transactions").alias("n"), F.lit(True).alias("otc"),
        )
    )
    path = scratch(spark, "grouped")
    bars.select(sent).write.text(path)
    return landed.read_grouped_daily(spark, path, dt.date(1998, 6, 15)).drop("vwap")


@query(f"""WITH {cu.RATED} SELECT rebalance_date, ticker, rank, median_dollar_volume_60 FROM keyed""")
def snapshot_store(spark, sf):
    """Write the snapshots in two goes, each rebalance once, and read the table back."""
    root = scratch(spark, "universe")
    chosen = b.stored(spark, sf, "universe", lambda: cu.selected(spark, sf))
    rows = chosen.select("rebalance_date", "ticker", "rank", "median_dollar_volume_60")
    late = F.col("rebalance_date") >= F.lit("1998-01-01").cast("date")
    store.write_snapshots(rows.where(~late), root)
    store.write_snapshots(rows.where(late), root)
    return spark.read.parquet(root)


DIVIDENDS = """dividends AS (SELECT 'S' || ps AS ticker, DATE '1995-03-01' + CAST(91 * q + ps % 60 AS INTEGER) AS ex_dividend_date,
    round(cost / 100, 4) AS cash_amount, ['CD', 'SC'][CAST(q % 2 + 1 AS INTEGER)] AS dividend_type, 4 AS frequency
  FROM (SELECT s_suppkey AS ps, abs(s_acctbal) AS cost FROM supplier), (SELECT unnest(range(12)) AS q))"""


@query(f"WITH {DIVIDENDS} SELECT ticker, ex_dividend_date, cash_amount, dividend_type, frequency, DATE '2002-01-01' AS fetched FROM dividends")
def dividends(spark, sf):
    """Dividends landed as JSON, stored by the day they were fetched, and read back."""
    k = F.col("s_suppkey")
    rows = ad.table(spark, sf, "supplier").withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(11))))
    sent = F.struct(
        F.concat(F.lit("S"), k.cast("string")).alias("ticker"),
        F.date_add(F.lit("1995-03-01").cast("date"), (91 * F.col("q") + k % 60).cast("int")).cast("string").alias("ex_dividend_date"),
        F.round(F.abs("s_acctbal") / 100, 4).alias("cash_amount"),
        F.get(F.array(F.lit("CD"), F.lit("SC")), F.col("q") % 2).alias("dividend_type"), F.lit(4).alias("frequency"),
    )
    path, root = scratch(spark, "dividends"), scratch(spark, "actions")
    rows.select(F.to_json(sent)).write.text(path)
    store.write_actions(landed.read_dividends(spark, path, dt.date(2002, 1, 1)), root, "dividends")
    return store.read_dataset(spark, root, "dividends")


@query("SELECT last_day(l_shipdate) AS date, 'S' || l_suppkey AS ticker, min('X' || l_partkey) AS composite_figi FROM lineitem GROUP BY 1, 2")
def listed_tickers(spark, sf):
    lists = ad.table(spark, sf, "lineitem").select(
        F.last_day("l_shipdate").alias("date"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("ticker"),
        F.concat(F.lit("X"), F.col("l_partkey").cast("string")).alias("composite_figi"),
    )
    return landed.listed_once(lists)


FORMS = """forms AS (SELECT n_name AS security_key, 'A' || o_orderkey AS accession_number, CAST(o_orderdate AS DATE) AS filing_date, o_orderkey,
    strftime(o_orderdate + to_minutes(o_orderkey % 1440), '%Y-%m-%dT%H:%M:%S') || 'Z' AS accepted_utc, ['2.02,9.01', '7.01', '8.01', ''][CAST(o_orderkey % 4 + 1 AS INTEGER)] AS items
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderpriority <> '5-LOW')"""


def filings_json(spark, sf):
    """Filing pages: columnar arrays of at most 500 filings, as a long record is paged."""
    items = F.array(*map(F.lit, ("2.02,9.01", "7.01", "8.01", "")))
    stamp = F.col("date").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("minute_et"))
    rows = cfl.orders(spark, sf).select(
        "security_key", F.floor(F.col("o_orderkey") / 500).alias("page"),
        F.when(F.col("o_orderpriority") == "5-LOW", "10-Q").otherwise("8-K").alias("form"),
        F.concat(F.lit("A"), F.col("o_orderkey").cast("string")).alias("acc"),
        F.col("date").cast("string").alias("day"),
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"),
        F.get(items, (F.col("o_orderkey") % 4).cast("int")).alias("items"),
    )
    page = rows.groupBy("security_key", "page").agg(
        F.sort_array(F.collect_list(F.struct("acc", "form", "day", "at", "items"))).alias("f")
    )
    arrays = F.struct(
        F.col("f.form").alias("form"), F.col("f.acc").alias("accessionNumber"),
        F.col("f.day").alias("filingDate"), F.col("f.at").alias("acceptanceDateTime"),
        F.col("f.items").alias("items"),
    )
    return page.select("security_key", F.to_json(arrays).alias("filings_json"))


@query(select(FORMS, "forms", "security_key accession_number filing_date accepted_utc items"))
def filing_json(spark, sf):
    return landed.eight_k_filings(filings_json(spark, sf))


@query(
    f"""WITH {FORMS} SELECT accession_number, CAST(z AS DATE) AS date_et, CAST(hour(z) * 60 + minute(z) AS INTEGER) AS minute_et FROM (
  SELECT *, (CAST(replace(replace(accepted_utc, 'T', ' '), 'Z', '') AS TIMESTAMP) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS z FROM forms WHERE items LIKE '%2.02%')"""
)
def results_filings(spark, sf):
    found = landed.earnings_filings(landed.eight_k_filings(filings_json(spark, sf)))
    day, minute = landed.eastern_clock(F.col("accepted_utc"))
    return found.select("accession_number", day.alias("date_et"), minute.alias("minute_et"))


@query(f"WITH {SPLITS} SELECT ticker, execution_date, split_from, split_to, split_from / split_to AS price_factor, DATE '2002-01-01' AS fetched FROM splits")
def corporate_actions(spark, sf):
    return landed.corporate_actions(ad.splits(spark, sf), dt.date(2002, 1, 1))


@query(select(cu.CHANGES, "changes JOIN ident USING (security_key)", "requested date ticker"))
def ticker_changes(spark, sf):
    return landed.changes_table(cu.identities(spark, sf)).select("requested", "date", "ticker")


# --- pages ----------------------------------------------------------------------


@query(
    r"""SELECT page_id, regexp_replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '\s+', ' ', 'g') AS title,
  contains(regexp_replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '\s+', ' ', 'g'), 'the ') AS is_statement FROM pages"""
)
def page_titles(spark, sf):
    return ad.table(spark, sf, "pages").select(
        "page_id", pages.title().alias("title"),
        pages.is_policy_statement(wording="the ").alias("is_statement"),
    )


@query(
    r"""SELECT DISTINCT page_id, d AS date FROM (SELECT page_id, CAST(try_strptime(unnest(regexp_extract_all(html, '/([0-9]{8})', 1)), '%Y%m%d') AS DATE) AS d
FROM (SELECT page_id, html || ' /' || strftime(DATE '1990-01-01' + CAST(page_id AS INTEGER) * 7, '%Y%m%d') || ' /99999999' AS html FROM pages)) WHERE d IS NOT NULL"""
)
def page_dates(spark, sf):
    day = F.date_add(F.lit("1990-01-01").cast("date"), (F.col("page_id") * 7).cast("int"))
    html = F.concat("html", F.lit(" /"), F.date_format(day, "yyyyMMdd"), F.lit(" /99999999"))
    rows = ad.table(spark, sf, "pages").select("page_id", html.alias("html"))
    return pages.linked_dates(rows, r"/(\d{8})")


def release_pages(spark, sf):
    """One page an order: links, a title and a schedule table."""
    o = ad.table(spark, sf, "orders")
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    stamp = F.when(key % 10 == 0, "99999999").otherwise(F.date_format(day, "yyyyMMdd"))
    name = F.when(key % 3 == 0, "Consumer Price Index for ").when(
        key % 3 == 1, "Employment Situation for "
    ).otherwise("Employment Situation of Veterans for ")
    clock = F.when(key % 7 == 0, "at noon").when(key % 2 == 0, "08:30 AM").otherwise("01:15 PM")
    title = F.when(F.col("o_orderpriority") == "1-URGENT", "Federal Reserve\n issues FOMC statement")
    html = F.concat(
        F.lit("<title>"), F.coalesce(title, F.lit("Other")), F.lit('</title><a href="monetary'), stamp,
        F.lit('a.htm">x</a><a href="fomcminutes'), stamp, F.lit('.pdf">y</a><table>\n<tr class="r">\n<td>'),
        F.date_format(day, "EEEE, MMMM dd, yyyy"), F.lit("</td><td> "), clock, F.lit("</td>\n<td><b>"),
        name, F.date_format(day, "MMMM yyyy"), F.lit("</b>&nbsp;</td></tr><tr><td>only one</td></tr></table>"),
    )
    return o.select("o_orderkey", html.alias("html"))


@query(
    """SELECT 'statement' AS link, CAST(o_orderdate AS DATE) AS date, o_orderkey FROM orders WHERE o_orderkey % 10 <> 0
UNION ALL SELECT 'minutes', CAST(o_orderdate AS DATE), o_orderkey FROM orders WHERE o_orderkey % 10 <> 0"""
)
def linked_dates(spark, sf):
    rows = release_pages(spark, sf)
    statements = pages.linked_dates(rows, pages.STATEMENT_LINK).withColumn("link", F.lit("statement"))
    minutes = pages.linked_dates(rows, pages.MINUTES_LINK).withColumn("link", F.lit("minutes"))
    return statements.unionByName(minutes)


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def policy_statements(spark, sf):
    return release_pages(spark, sf).where(pages.is_policy_statement()).select("o_orderkey")


@query(
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 2 = 0 THEN '08:30' ELSE '13:15' END AS time_et,
  CASE WHEN o_orderkey % 3 = 0 THEN 'cpi' ELSE 'payrolls' END AS kind FROM orders WHERE o_orderkey % 3 <> 2"""
)
def statistics_releases(spark, sf):
    return pages.statistics_releases(release_pages(spark, sf))


# --- stored tables ---------------------------------------------------------------


@query(
    select(
        b.days("supplier", "week"),
        "(SELECT * REPLACE (CASE WHEN date >= DATE '1998-01-01' THEN volume + 1 ELSE volume END AS volume) FROM days)",
        "security_key date close volume", tail="WHERE date BETWEEN DATE '1997-06-01' AND DATE '1998-06-30'",
    )
)
def session_store(spark, sf):
    """Write sessions, replace the later ones, read a range back: only its partitions are read."""
    root = scratch(spark, "bars")
    bars = cu.supplier_bars(spark, sf)
    store.write_sessions(bars, root, "daily")
    later = bars.where(F.col("date") >= F.lit("1998-01-01").cast("date"))
    store.write_sessions(later.withColumn("volume", F.col("volume") + 1), root, "daily")
    found = store.read_bars(spark, root, "daily", dt.date(1997, 6, 1), dt.date(1998, 6, 30))
    return found.select("security_key", "date", "close", "volume")


def _parts(spark, sf):
    root = scratch(spark, "raw")
    bars = cu.supplier_bars(spark, sf).select("security_key", "date", "close", "volume")
    bars.hint("rebalance", "security_key").write.parquet(f"{root}/parts")
    store.write_manifests(spark, f"{root}/parts", f"{root}/manifests", "run-1")
    return f"{root}/parts", f"{root}/manifests"


@query(select(b.days("supplier", "week"), "days", "security_key date close volume"))
def complete_parts(spark, sf):
    return store.read_complete_parts(spark, *_parts(spark, sf))


@query(f"WITH {b.days('supplier', 'week')} SELECT 'ok' AS state, count(*) AS rows FROM days")
def manifest_audit(spark, sf):
    audit = store.audit_manifests(spark, *_parts(spark, sf))
    return audit.groupBy("state").agg(F.sum("rows").alias("rows"))


LOGGED = {
    "listing_date_discrepancies": "listing_date_differences", "share_count_problems": "share_count_problems",
    "multi_class_securities": "multi_class", "market_cap_audit": "market_cap_audit",
    "ticker_history_gaps": "history_gaps", "ticker_stitches": "monthly_stitches",
}


@query(
    " UNION ALL ".join(
        f"SELECT '{log}' AS log, count(*) AS rows FROM ({b.ORACLES[name]})"
        + (" WHERE outcome = 'stitched'" if log == "ticker_stitches" else "")
        for log, name in LOGGED.items()
    )
)
def audit_logs(spark, sf):
    """Every audit appended to its log and the logs read back."""
    root = scratch(spark, "audits")
    securities, shares = cu.securities(spark, sf), cu.share_counts(spark, sf).withColumnRenamed("ticker_on_date", "ticker")
    # The universe and the renames measure the same bars.
    bars = cu.stored_bars(spark, sf)
    chosen = b.stored(spark, sf, "universe", lambda: cu.selected(spark, sf, bars))
    found = {
        "listing_date_discrepancies": au.listing_date_differences(securities).withColumnsRenamed(
            {"list_date": "vendor_list_date", "first_event_date": "first_ticker_event"}
        ),
        "share_count_problems": au.share_count_problems(shares),
        "multi_class_securities": au.multi_class(shares),
        "market_cap_audit": chosen.withColumnRenamed("market_cap", "our_market_cap"),
        "ticker_history_gaps": au.history_gaps(cu.identities(spark, sf)).withColumnRenamed("requested", "ticker"),
        "ticker_stitches": cu.stitch_log(spark, sf, bars).where("outcome = 'stitched'").withColumnsRenamed(
            {"ticker_now": "requested_ticker", "ticker_then": "fetched_as"}
        ).withColumn("run_id", F.lit("run-1")),
    }
    counts = []
    for log, rows in found.items():
        store.append_audit(rows, root, log)
        counts.append(store.read_audit(spark, root, log).agg(F.lit(log).alias("log"), F.count(F.lit(1)).alias("rows")))
    out = counts[0]
    for more in counts[1:]:
        out = out.unionAll(more)
    return out


@query(select(chain(cfl.ORDERS, cfl.RELEASES), "releases", "date kind time_et"))
def macro_csv(spark, sf):
    path = scratch(spark, "macro")
    rows = cfl.releases(spark, sf).select("date", "kind", "time_et", F.lit("s").alias("source"), F.lit("").alias("note"))
    store.append_log(rows, path)
    found = store.read_macro_table(spark, path)
    return found.select("date", "kind", F.coalesce("time_et", F.lit("")).alias("time_et"))


@query(select(cst.LABELS, "lab", "security_key date slot_index stratum is_retest response note pattern_guess"))
def label_records(spark, sf):
    path = scratch(spark, "labels")
    rows = cst.label_rows(spark, sf).drop("doc_id")
    for answer in ("interesting", "not_interesting"):
        store.append_labels(rows.where(F.col("response") == answer), path)
    found = store.read_labels(spark, path)
    return found.select(
        "security_key", "date", "slot_index", "stratum", "is_retest", "response", "note", "pattern_guess"
    )


@query(
    """WITH rows AS (SELECT 'S' || l_suppkey AS security_key, CAST(l_shipdate AS DATE) AS date_et, 'T' || l_linenumber AS ticker FROM lineitem),
covered AS (SELECT DISTINCT security_key, date_et FROM rows WHERE ticker = 'T1')
SELECT security_key, date_et, count(*) AS bars, string_agg(DISTINCT ticker, ',' ORDER BY ticker) AS tickers_used FROM rows
WHERE NOT EXISTS (SELECT 1 FROM covered c WHERE c.security_key = rows.security_key AND c.date_et = rows.date_et) GROUP BY 1, 2"""
)
def new_part_rows(spark, sf):
    items = ad.table(spark, sf, "lineitem")
    rows = items.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("security_key"),
        F.col("l_shipdate").cast("date").alias("date_et"),
        F.concat(F.lit("T"), F.col("l_linenumber").cast("string")).alias("ticker"),
    )
    return store.day_manifest(store.new_rows(rows, rows.where(F.col("ticker") == "T1"), items.count()))


@query(
    """WITH parts AS (SELECT DISTINCT CAST(date_trunc('week', l_shipdate) AS DATE) AS date, 'part-' || (l_suppkey % 5) AS file, l_suppkey % 5 AS k FROM lineitem),
now AS (SELECT date, count(*) || '-' || sum(('0x' || substr(sha1(file), 1, 13))::BIGINT) AS parts_digest FROM parts GROUP BY 1),
built AS (SELECT date, count(*) || '-' || sum(('0x' || substr(sha1(file), 1, 13))::BIGINT) AS parts_digest FROM parts WHERE month(date) <> 5 AND (year(date) <> 1997 OR k < 3) GROUP BY 1)
SELECT n.date, n.parts_digest FROM now n LEFT JOIN built b ON b.date = n.date AND b.parts_digest = n.parts_digest WHERE b.date IS NULL"""
)
def stale_sessions(spark, sf):
    k = F.col("l_suppkey") % 5
    parts = ad.table(spark, sf, "lineitem").select(
        F.date_trunc("week", "l_shipdate").cast("date").alias("date"),
        F.concat(F.lit("part-"), k.cast("string")).alias("file"), k.alias("k"),
    )
    seen = parts.where((F.month("date") != 5) & ((F.year("date") != 1997) | (F.col("k") < 3)))
    return incremental.stale_sessions(parts, incremental.part_sets(seen))


@query(select(b.days("nation", "month"), "days", "security_key date open high low close volume transactions"))
def arriving_sessions(spark, sf):
    """Day bars kept up by a stream: minutes land, late ones of the same sessions follow, and at
    last every file is handed out again, as after a lost checkpoint."""
    root = scratch(spark, "arrivals")
    raw, bars = f"{root}/raw", f"{root}/bars"
    minutes = ad.trades(spark, sf, "nation", "month").select(*bo.MINUTE_COLUMNS, "date")
    late = F.pmod(F.xxhash64("timestamp_utc", "security_key"), F.lit(10)) == 0

    def build(rows):
        return rows.groupBy(*bo.IDENTITY, "date").agg(*bo.ohlcv())

    def land(rows):
        rows.hint("rebalance", "date").write.mode("append").partitionBy("date").parquet(raw)

    def run(checkpoint):
        incremental.rebuild_on_arrival(spark, raw, minutes.schema, build, bars, "daily", f"{root}/{checkpoint}")

    land(minutes.where(~late))
    run("first")
    land(minutes.where(late))
    run("first")
    run("again")
    found = store.read_dataset(spark, bars, "daily")
    return found.select("security_key", "date", "open", "high", "low", "close", "volume", "transactions")


@query(
    select(
        chain(cs.MARKED_CTES, cs.CAPPED),
        "(SELECT *, 'abc123' AS git_commit, '2' AS config_version FROM capped)",
        "security_key date slot_index family_a family_b git_commit config_version",
    )
)
def scan_report(spark, sf):
    path = scratch(spark, "report")
    kept = pt.apply_cap(cs.marked(spark, sf), cs.CAP).select("security_key", "date", "slot_index", "family_a", "family_b")
    store.write_report(kept, path, git_commit="abc123", config_version="2")
    schema = "security_key string, date date, slot_index int, family_a boolean, family_b boolean, git_commit string, config_version string"
    return spark.read.schema(schema).json(path)


@query(select(chain(cs.MARKED_CTES), "feat", "security_key date slot_index close", "vol_pct_slot_60"))
def features_with_prices(spark, sf):
    bars = ad.slot_bars(spark, sf)
    features = stored_features(spark, sf)
    kept = features.drop("open", "high", "low", "close", "volume")
    return tidy(
        store.with_prices(kept, bars), "security_key", "date", "slot_index", "close", "vol_pct_slot_60",
        exact="close",
    )
