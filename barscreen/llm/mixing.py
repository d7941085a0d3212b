"""Mixing sources to target weights by iterative proportional fitting.

Token counts are added up per cell (source, language, topic). Raking scales the cells until the
totals of each source, language and topic meet their targets; a cell's calibrated weight over
its tokens, scaled to the token budget and never above one, is the probability with which each
of its documents is sampled. The draw is a hash of the document's id: repeating it, or adding
documents, changes no other document's lot.

Only counting reads the documents; raking works on the table of cells with window sums, which
are dealt out like any other where sources are many. Sweeps are written to the shared folder.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barscreen.llm.common import BROADCAST_ROWS, attach, fresh, staged

MARGINS = ("source", "lang", "topic")
#: Targets are the shares of the table to these powers: below 1, small ones gain.
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.7}
SHARE, SEED = 0.5, 11
#: Raking with the bound ends at this gap, a share of the budget, or after so many sweeps.
GAP, BOUNDED_SWEEPS = 1e-3, 40
_LOG = logging.getLogger(__name__)
WORD = "[^ \\t\\n\\x0b\\f\\r]+"


def tokens_of(text: Column) -> Column:
    """Words of a text, the unit of the weights; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """Form of a text, standing for its topic where a table has none."""
    return (
        F.when(F.coalesce(F.length(text), F.lit(0)) == 0, "empty").when(text.contains(" | "), "table")
        .when(text.contains("!! "), "shout").when(text.rlike("[#*$%&]{3}"), "symbols")
        .when(text.contains("\n"), "lines").otherwise("line")
    )


def chance(doc_id: Column, seed: int = SEED) -> Column:
    """A uniform number in [0, 1) from an id: 52 bits of an MD5."""
    named = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f"/{seed}"))
    return F.conv(F.substring(F.md5(named), 1, 13), 16, 10).cast("double") / float(1 << 52)


def shares(cells: DataFrame, margin: str, power: float, given: Mapping[str, float] | None) -> DataFrame:
    """(margin value, target share), summing to 1; given targets count only for values present."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("t")).where("t > 0")
    if given is None:
        sums = sums.withColumn("want", F.pow("t", F.lit(power)))
    else:
        pairs = F.create_map(*[F.lit(x) for kv in given.items() for x in kv]) if given else F.create_map()
        sums = sums.withColumn("want", F.coalesce(F.get(F.array(pairs), F.lit(0))[F.col(margin)], F.lit(0.0)))
    total = F.broadcast(sums.agg(F.sum("want").alias("all")))  # one row
    return staged(sums.join(total).where("all > 0").select(margin, (F.col("want") / F.col("all")).alias("target")), "targets")


def _filled(rows: DataFrame, by: list[str], want: Column) -> DataFrame:
    """Scales `weight` per group so that the sum of min(tokens, weight) is `want`; where all
    tokens are too few, each weight reaches its tokens. Tokens and weights are above 0."""
    group = [F.col(c) for c in by] or [F.lit(0)]
    order = Window.partitionBy(*group).orderBy("_ratio", *[c for c in MARGINS if c in rows.columns])
    before = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("_ratio", F.col("tokens") / F.col("weight"))
    rows = rows.withColumn("_factor", F.greatest(want - before, F.lit(0.0)) / rest)
    whole = Window.partitionBy(*group)
    best = F.max(F.when(F.col("_factor") <= F.col("_ratio"), F.col("_factor"))).over(whole)
    rows = rows.withColumn("_best", F.coalesce(best, F.max("_ratio").over(whole)))
    rows = rows.withColumn("weight", F.col("weight") * F.col("_best")).drop("_ratio", "_factor", "_best")
    return rows.where("weight > 0")


def bounded(cells: DataFrame, budget: float, targets: Mapping[str, Mapping[str, float]] | None = None) -> DataFrame:
    """(MARGINS, tokens, p): raking with p <= 1 in the fit, so that expected tokens meet each
    margin's targets. A target above the tokens there are is cut to them and the others share
    the rest. Sweeps end when margins are met to GAP of the budget. Targets that were cut and
    what BOUNDED_SWEEPS cannot meet are logged."""
    rows = cells.where("tokens > 0").withColumn("weight", F.col("tokens").cast("double"))
    for m in MARGINS:
        wanted = shares(cells, m, POWERS[m], (targets or {}).get(m)).where("target > 0")
        sums = cells.groupBy(m).agg(F.sum("tokens").alias("tokens"))
        wanted = staged(wanted.join(sums, m).withColumn("weight", F.col("target") * budget), "wants")
        short = wanted.where("weight > tokens").agg(F.count("*").alias("n"), F.sum(F.col("weight") - F.col("tokens")).alias("lost")).first()
        if short.n:
            _LOG.warning("mixing: %d values of %s have fewer tokens than their targets, by %.4f of the budget", short.n, m, short.lost / budget)
        wanted = _filled(wanted, [], F.lit(float(budget)))
        wanted = wanted.select(m, F.least("weight", "tokens").alias(f"{m}_want"))
        rows = attach(rows, staged(wanted, "wants"), [m], "inner")
    rows = staged(rows, "bounded")
    few = rows.count() <= BROADCAST_ROWS
    for _ in range(BOUNDED_SWEEPS):
        rows = rows.coalesce(1) if few else rows
        for m in MARGINS:
            rows = _filled(rows, [m], F.col(f"{m}_want"))
        rows = staged(rows, "bounded")
        gaps = {}
        for m in MARGINS:
            met = rows.groupBy(m).agg((F.sum(F.least("tokens", "weight")) - F.first(f"{m}_want")).alias("d"))
            gaps[m] = (met.agg(F.max(F.abs("d"))).first()[0] or 0.0) / max(budget, 1)
        if max(gaps.values()) <= GAP:
            break
    else:
        _LOG.warning("mixing targets can't all be met: largest gaps as shares of the budget %s", gaps)
    found = rows.select(*MARGINS, F.least(F.col("weight") / F.col("tokens"), F.lit(1.0)).alias("p"))
    return attach(cells, staged(found, "found"), list(MARGINS)).withColumn("p", F.coalesce("p", F.lit(0.0)))


def mixed(
    docs: DataFrame, share: float = SHARE, seed: int = SEED,
    targets: Mapping[str, Mapping[str, float]] | None = None,
) -> DataFrame:
    """The sampled rows of (doc_id, text, source, lang, ...), all their columns, and `_tokens`,
    `_topic`, `_p`.

    `share` of all tokens is the budget. Null sources and languages are a value of their own
    (empty text). Documents without words weigh nothing and are sampled with the budget's share.
    Rows of one id share their lot, rows without an id share one lot. Columns named like those
    added keep their names, the added ones get another `_` at the end.
    """
    names = {n: fresh(docs, n) for n in ("_tokens", "_topic", "_p", "_source", "_lang")}
    rows = docs.withColumns(
        {
            names["_tokens"]: tokens_of(F.col("text")), names["_topic"]: topic_of(F.col("text")),
            names["_source"]: F.coalesce("source", F.lit("")), names["_lang"]: F.coalesce("lang", F.lit("")),
        }
    )
    key = {"source": names["_source"], "lang": names["_lang"], "topic": names["_topic"]}
    counted = rows.groupBy(*[F.col(c).alias(m) for m, c in key.items()]).agg(F.sum(names["_tokens"]).alias("tokens"))
    cells = staged(counted, "cells")
    total = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    found = bounded(cells, share * total, targets).withColumn("p", F.when(F.col("tokens") > 0, F.col("p")).otherwise(F.lit(share)))
    small = staged(found.select(*[F.col(m).alias(c) for m, c in key.items()], F.col("p").alias(names["_p"])), "chances")
    drawn = attach(rows, small, list(key.values())).where(chance(F.col("doc_id"), seed) < F.col(names["_p"]))
    return drawn.select(*docs.columns, *[names[n] for n in ("_tokens", "_topic", "_p")])


def _filled_sql(source: str, by: str, want: str, names: str) -> str:
    """`_filled` in SQL: the rows of `source` with `weight` scaled per group of `by`."""
    group = f"PARTITION BY {by}" if by else ""
    order = f"{group} ORDER BY tokens / weight, {names}"
    kept = "* EXCLUDE (weight, best)"
    return f"""(SELECT {kept}, weight * best AS weight FROM (
    SELECT * EXCLUDE (factor), coalesce(max(CASE WHEN factor <= tokens / weight THEN factor END) OVER ({group}), max(tokens / weight) OVER ({group})) AS best
    FROM (SELECT *, greatest({want} - coalesce(sum(tokens) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0)
      / sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS factor FROM {source})) WHERE weight * best > 0)"""


def sql(docs: str = "documents") -> str:
    """The comparison SQL: cells, targets cut to the tokens there are, sweeps as a recursion that
    ends when every margin is met, the draw."""
    wants = []
    for m in MARGINS:
        share = f"""(SELECT {m}, tokens, pow(tokens, {POWERS[m]}) / sum(pow(tokens, {POWERS[m]})) OVER () * (SELECT b FROM budget) AS weight
    FROM (SELECT {m}, CAST(sum(tokens) AS DOUBLE) AS tokens FROM cells GROUP BY 1 HAVING sum(tokens) > 0))"""
        wants.append(f"want_{m} AS MATERIALIZED (SELECT {m}, least(weight, tokens) AS {m}_want FROM {_filled_sql(share, '', '(SELECT b FROM budget)', m)})")
    names = ", ".join(MARGINS)
    swept = "(SELECT * FROM r WHERE gap > {gap} AND sweep < {sweeps})".format(gap=GAP, sweeps=BOUNDED_SWEEPS)
    for m in MARGINS:
        swept = _filled_sql(swept, m, f"{m}_want", names)
    met = ", ".join(f"abs(sum(least(tokens, weight)) OVER (PARTITION BY {m}) - {m}_want)" for m in MARGINS)
    columns = f"{names}, tokens, weight, {', '.join(f'{m}_want' for m in MARGINS)}"
    return f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
    coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\x0b\\f\\r]+')), 0) AS n,
    CASE WHEN coalesce(text, '') = '' THEN 'empty' WHEN contains(text, ' | ') THEN 'table' WHEN contains(text, '!! ') THEN 'shout'
      WHEN regexp_matches(text, '[#*$%&]{{3}}') THEN 'symbols' WHEN contains(text, chr(10)) THEN 'lines' ELSE 'line' END AS topic
  FROM {docs}),
cells AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(n) AS DOUBLE) AS tokens FROM d GROUP BY ALL),
budget AS MATERIALIZED (SELECT {SHARE} * sum(tokens) AS b FROM cells),
{", ".join(wants)},
r AS (SELECT 0 AS sweep, CAST(1 AS DOUBLE) AS gap, {names}, tokens, tokens AS weight, {', '.join(f'{m}_want' for m in MARGINS)}
  FROM cells {' '.join(f'JOIN want_{m} USING ({m})' for m in MARGINS)} WHERE tokens > 0
  UNION ALL
  SELECT sweep + 1, max(off) OVER () / greatest((SELECT b FROM budget), 1), {columns} FROM (SELECT *, greatest({met}) AS off FROM {swept})),
p AS (SELECT source, lang, topic, CASE WHEN c.tokens > 0 THEN coalesce(least(weight / c.tokens, 1.0), 0.0) ELSE {SHARE} END AS p
  FROM cells c LEFT JOIN (SELECT * FROM r WHERE sweep = (SELECT max(sweep) FROM r)) USING (source, lang, topic))
SELECT doc_id, d.source, d.lang, topic, n AS tokens, round(p, 6) + 0.0 AS p FROM d JOIN p USING (source, lang, topic)
WHERE ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '/{SEED}'), 1, 13))::BIGINT / {1 << 52}.0 < p
"""
