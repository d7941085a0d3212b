"""The register of queries, and the SQL pieces their comparisons are put together from.

Each query has a Spark builder and, where SQL can say it, an equivalent DuckDB statement over
the same tables. Doubles are rounded on both sides, as sums may be added in another order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barscreen.schema import alone
from barscreen.session import shared_folder

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
_STORED: dict[tuple[str, str, str, str], str] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6
#: So many columns are rounded together with the steps before.
MOST = 10


def query(sql: str | None = None) -> Callable[[Builder], Builder]:
    def register(builder: Builder) -> Builder:
        QUERIES[builder.__name__] = builder
        if sql is not None:
            ORACLES[builder.__name__] = sql
        return builder

    return register


def stored(spark: SparkSession, sf: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A stage table: written to the shared folder by the first query of a session that needs
    it, read back by all. The stages of a build hand over tables, not plans. A change of the
    input files (names, sizes, times) makes it anew."""
    key = (spark.sparkContext.applicationId, sf, input_state(spark, sf), name)
    if key not in _STORED:
        path = f"{shared_folder(spark)}/stages/{uuid.uuid4().hex}/{name}"
        build().write.parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def input_state(spark: SparkSession, sf: str) -> str:
    """A digest of the listing of a folder of tables; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = files.option("pathGlobFilter", "*.parquet").load(sf)
    each = F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)")
    return str(files.agg(F.count(F.lit(1)), F.sum(each)).first())


def forget_stored() -> None:
    """Let the next query build its stage tables anew (for timing)."""
    _STORED.clear()


def nearest(value: Column, digits: int) -> Column:
    """A double rounded as the SQL rounds it: scaled, to the nearest whole number (halves away from
    zero), scaled back. `round` goes through decimals, at some fifty times the cost."""
    scaled = F.abs(value) * 10.0**digits
    whole = F.signum(value) * F.floor(scaled + 0.5) / 10.0**digits
    return F.when(scaled < 2.0**52, whole).otherwise(F.round(value, digits))


def tidy(
    df: DataFrame, *columns: str, exact: str = "", digits: int = DIGITS
) -> DataFrame:
    """The named columns (default: all), doubles rounded unless named in `exact`; adding zero
    turns -0 into 0.

    Prices are one division of two stored numbers, the same in any engine: they stay exact.
    Values of the size of a price that are computed further want fewer digits.
    """
    kinds = dict(df.dtypes)
    keep = set(exact.split())
    names = columns or df.columns
    rounded = [c for c in names if kinds[c] in ("double", "float") and c not in keep]
    # Many of them are too much for the method of the steps before.
    apart = next((c for c in names if c not in rounded), None) if len(rounded) > MOST else None
    return df.select(
        *[
            (nearest(F.col(c), digits) + F.lit(0.0)).alias(c)
            if c in rounded
            else alone(c)
            if c == apart
            else F.col(c)
            for c in names
        ]
    )


def select(
    ctes: str, source: str, plain: str = "", doubles: str = "", tail: str = "", digits: int = DIGITS
) -> str:
    """`WITH RECURSIVE ctes SELECT plain, rounded doubles FROM source tail`."""
    columns = plain.split()
    columns += [f"round({d}, {digits}) + 0.0 AS {d}" for d in doubles.split()]
    head = f"WITH RECURSIVE {ctes} " if ctes else ""
    return f"{head}SELECT {', '.join(columns)} FROM {source} {tail}"


def chain(*parts: str) -> str:
    return ",\n".join(p.strip().rstrip(",") for p in parts)


def frame(n: int) -> str:
    return f"ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING"


SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
EARLIER = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
BAR_W = "PARTITION BY security_key ORDER BY date, slot_index"
SLOT_W = "PARTITION BY security_key, slot_index ORDER BY date"
DAY_W = "PARTITION BY security_key ORDER BY date"


def trades(security: str = "nation", session: str = "week", name: str = "trades") -> str:
    key = "n_name" if security == "nation" else "'S' || l_suppkey"
    joins = (
        "JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"
        if security == "nation"
        else ""
    )
    return f"""{name} AS (
  SELECT {key} AS security_key, CAST(date_trunc('{session}', l_shipdate) AS DATE) AS date,
    CAST(l_linenumber - 1 AS INTEGER) AS slot_index,
    l_shipdate + to_microseconds((l_orderkey * 1000 + l_partkey % 1000) % 86400000000) AS ts,
    l_extendedprice / l_quantity AS p, l_quantity AS q
  FROM lineitem {joins})"""


OHLCV = """first(p ORDER BY ts) AS open, max(p) AS high, min(p) AS low,
    last(p ORDER BY ts) AS close, sum(q) AS volume, count(*) AS transactions"""
HALF = "(month(date) = 12 AND day(date) >= 24)"


def bars(security: str = "nation", session: str = "week") -> str:
    return chain(
        trades(security, session),
        f"""agg AS (SELECT security_key, date, slot_index, {OHLCV} FROM trades GROUP BY ALL),
bars AS (SELECT i.security_key, i.date, s.slot_index, {HALF.replace('date', 'i.date')} AS is_half_day,
    open, high, low, close, coalesce(volume, 0) AS volume,
    coalesce(transactions, 0) AS transactions, coalesce(transactions, 0) < 1 AS low_quality
  FROM (SELECT DISTINCT security_key, date FROM trades) i
  CROSS JOIN (SELECT CAST(unnest([0, 1, 2, 3, 4, 5, 6]) AS INTEGER) AS slot_index) s
  LEFT JOIN agg USING (security_key, date, slot_index)),
days AS (SELECT security_key, date, {HALF} AS is_half_day, {OHLCV}, count(*) < 1 AS low_quality
  FROM trades GROUP BY security_key, date)""",
    )


def days(security: str = "nation", session: str = "day") -> str:
    return chain(
        trades(security, session),
        f"""days AS (SELECT security_key, date, {HALF} AS is_half_day, {OHLCV},
    count(*) < 1 AS low_quality FROM trades GROUP BY security_key, date)""",
    )


def atr(source: str, order: str, into: str, p: str = "a") -> str:
    """True range and Wilder's recursion, one step of it a recursion of the query."""
    keys = "security_key, " + order
    return f"""{p}tr AS (SELECT *, CASE WHEN high IS NULL OR low IS NULL THEN NULL
    WHEN pc IS NULL THEN high - low
    ELSE greatest(high - low, abs(high - pc), abs(low - pc)) END AS true_range
  FROM (SELECT *, lag(close) OVER (PARTITION BY security_key ORDER BY {order}) AS pc FROM {source})),
{p}kn AS MATERIALIZED (SELECT {keys}, true_range,
    row_number() OVER (PARTITION BY security_key ORDER BY {order}) AS k
  FROM {p}tr WHERE true_range IS NOT NULL),
{p}rec(security_key, k, a) AS (
  SELECT security_key, CAST(20 AS BIGINT), avg(true_range) FROM {p}kn WHERE k <= 20
  GROUP BY security_key HAVING count(*) = 20
  UNION ALL
  SELECT t.security_key, t.k, (r.a * 19 + t.true_range) / 20
  FROM {p}rec r JOIN {p}kn t ON t.security_key = r.security_key AND t.k = r.k + 1),
{into} AS (SELECT {p}tr.*, last_value(a IGNORE NULLS) OVER (
    PARTITION BY security_key ORDER BY {order} {EARLIER}) AS atr20
  FROM {p}tr LEFT JOIN (SELECT {keys}, a FROM {p}kn JOIN {p}rec USING (security_key, k)) x
  USING ({keys}))"""


def market(session: str = "week") -> str:
    return f"""{trades('supplier', session, 'mtrades')},
mbar AS (SELECT date, slot_index, sum(p * q) / sum(q) AS close FROM mtrades GROUP BY date, slot_index),
mday AS (SELECT date, sum(p * q) / sum(q) AS close FROM mtrades GROUP BY date),
mret AS (SELECT date, close / lag(close) OVER (ORDER BY date) - 1 AS m FROM mday),
mbret AS (SELECT date, slot_index, close / lag(close) OVER (ORDER BY date, slot_index) - 1 AS m FROM mbar),
mbday AS (SELECT date, close / lag(close) OVER (ORDER BY date) - 1 AS market_ret_day
  FROM (SELECT date, max_by(close, slot_index) AS close FROM mbar GROUP BY date))"""


BETA = f"""brt AS (SELECT d.security_key, d.date,
    d.close / lag(d.close) OVER (PARTITION BY d.security_key ORDER BY d.date) - 1 AS s, m
  FROM days d LEFT JOIN mret USING (date)),
bfit AS (SELECT security_key, date, CASE WHEN count(*) OVER b = 60 THEN regr_slope(s, m) OVER b END AS fit
  FROM brt WHERE s IS NOT NULL AND m IS NOT NULL WINDOW b AS ({DAY_W} {frame(60)})),
beta AS (SELECT security_key, date, last_value(held IGNORE NULLS) OVER ({DAY_W} {SO_FAR}) AS beta_60
  FROM (SELECT *, CASE WHEN opens AND c >= 40 THEN fit END AS held
    FROM (SELECT brt.security_key, brt.date, fit,
        coalesce(lag(date_trunc('week', brt.date)) OVER w <> date_trunc('week', brt.date), true) AS opens,
        count(CASE WHEN s IS NOT NULL AND m IS NOT NULL THEN 1 END) OVER (w {frame(60)}) AS c
      FROM brt LEFT JOIN bfit USING (security_key, date)
      WINDOW w AS (PARTITION BY brt.security_key ORDER BY brt.date))))"""


def percentile(past: str, x: str, need: int) -> str:
    return (
        f"CASE WHEN len({past}) >= {need} AND {x} IS NOT NULL THEN "
        f"100.0 * len(list_filter({past}, lambda v: v < {x})) / len({past}) END"
    )


#: Weekday order dates stand for the market calendar.
SESSIONS = """sessions AS (SELECT date, CAST(row_number() OVER (ORDER BY date) - 1 AS INTEGER) AS session_no,
    (month(date) = 12 AND day(date) = 24) OR (month(date) = 7 AND day(date) = 3) AS is_half_day
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders) WHERE isodow(date) < 6)"""
WEEKS = """weeks AS (SELECT date, CAST(row_number() OVER (ORDER BY date) - 1 AS INTEGER) AS session_no
  FROM (SELECT DISTINCT date FROM days))"""
