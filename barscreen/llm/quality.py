"""Quality rules with a guarantee: cutoffs whose false rejections are bounded by exact tests.

Each rule is a ratio measured on the whole text; a document goes if a ratio exceeds the cutoff
of its stratum. A candidate is a whole vector of cutoffs, one a rule: the same share of the good
documents of the choosing half under each rule. Candidates are certified on labelled good
documents that took no part in choosing them: per stratum they are tried from the most lenient
on, and the walk stops at the first whose exact binomial p-value (Learn-then-Test: chance of so
few false rejections, by any rule, if their true rate were above the limit) exceeds
alpha / strata. Walking in a fixed order needs no further correction, the division over the
strata is Bonferroni's. So all rules together reject at most `limit` of the good documents of a
stratum, with probability 1 - alpha over all strata; at the defaults and four strata, about 440
certifying documents without an error are the least that certify anything.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barscreen.llm.common import add_columns, attach, staged

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
WINDOW = 8
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct", "n_letters", "n_upper",
)
#: Ratio measured by each rule: numerator, denominator.
RULES = {
    "symbols": ("n_symbols", "n_words"),
    "repeats": ("n_repeat_words", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "capitals": ("n_upper", "n_letters"),
}
#: Candidate cutoffs are these shares of the good documents of the choosing half.
SHARES = (1.0, 0.9999, 0.9995, 0.999, 0.998, 0.997, 0.996, 0.995, 0.993, 0.99)


def repeated(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more, the first included.

    Windows are ranked by doubling their length, so equality is exact, not that of a hash.
    """
    n = len(ids)
    if n <= window:
        return 0
    length, rank = 1, ids.astype(np.int64)
    while length < window:
        step = min(length, window - length)
        pair = rank[: n - length - step + 1] * (n + 1) + rank[step:][: n - length - step + 1]
        rank = np.unique(pair, return_inverse=True)[1]
        length += step
    again = np.flatnonzero(np.bincount(rank)[rank] > 1)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, again, 1)
    np.add.at(edges, again + window, -1)
    return int(np.count_nonzero(np.cumsum(edges)[:n]))


def measure(text: str | None) -> tuple[int, ...]:
    """The MEASURES of one text; null has none of anything. Letters are characters that have
    case, in either of the two ways they are counted."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.encode("utf-8", "surrogatepass").split()
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    lower, upper = text.lower(), text.upper()
    n_upper = n_letters = 0
    if len(lower) == len(upper) == len(text):
        whole, low, up = (
            np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
            for t in (text, lower, upper)
        )
        cased = low != up
        n_letters, n_upper = int(cased.sum()), int((cased & (whole == up)).sum())
    else:
        for c, times in Counter(text).items():
            if c.lower() != c.upper():
                n_letters += times
                n_upper += times * (c == c.upper())
    return (
        len(words),
        len(text) - sum(text.count(c) for c in WHITE),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated(ids) if len(known) < len(words) else 0,
        len(lines),
        len(known),
        n_letters,
        n_upper,
    )


def _measured(texts: list[str | None]) -> list[pa.Array]:
    return [pa.array(column, pa.int64()) for column in zip(*map(measure, texts), strict=True)]


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every column of `docs` but its texts, and the measures. One pass, no shuffle; a null
    text gives zeros."""
    fields = ", ".join(f"{m} long" for m in MEASURES)
    return add_columns(docs, text, fields, _measured, keep_text=False)


def no_more(n: int, k: int, rate: float) -> float:
    """P(X <= k) for X binomial(n, rate)."""
    if k >= n:
        return 1.0
    log = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
        + i * math.log(rate) + (n - i) * math.log1p(-rate)
        for i in range(k + 1)
    ]
    top = max(log)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in log))


def ratio(rule: str):
    over, under = RULES[rule]
    return F.when(F.col(under) > 0, F.col(over) / F.col(under)).otherwise(F.lit(0.0))


def certified(
    labelled: DataFrame, stratum: str, good: str, limit: float = 0.01, alpha: float = 0.05
) -> DataFrame:
    """(stratum, n, wrong, one cutoff per rule): null cutoffs reject nothing.

    `labelled` holds measures, the stratum, a boolean `good` and `_half` (0 chooses candidates,
    1 certifies them). Both passes are aggregates with one row a stratum. Rows whose stratum is
    null form a stratum of their own, named by an empty text. `n` counts the certifying good
    documents, `wrong` those of them that the certified cutoffs reject.
    """
    rows = labelled.where(F.col(good)).select(
        F.coalesce(F.col(stratum), F.lit("")).alias("stratum"), "_half",
        *[ratio(r).alias(r) for r in RULES],
    )
    # A percentile list that starts at 1.0 is the most lenient candidate first.
    asked = F.array(*[F.lit(s) for s in SHARES])
    tried = rows.where("_half = 0").groupBy("stratum").agg(
        *[F.percentile_approx(r, asked, F.lit(20_000)).alias(f"{r}_tried") for r in RULES]
    )
    tried = staged(tried, "candidates")

    def rejected(i: int):
        return F.greatest(*[(F.col(r) > F.col(f"{r}_tried")[i]).cast("int") for r in RULES])

    counted = attach(rows.where("_half = 1"), tried, ["stratum"], "inner").groupBy("stratum").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(rejected(i)) for i in range(len(SHARES))]).alias("wrong"),
        *[F.first(f"{r}_tried").alias(f"{r}_tried") for r in RULES],
    )
    counted = staged(counted, "counted")
    level = alpha / max(1, counted.count())
    schema = "stratum string, n long, wrong long, " + ", ".join(f"{r}_cutoff double" for r in RULES)
    arrow = pa.schema(
        [("stratum", pa.string()), ("n", pa.int64()), ("wrong", pa.int64())]
        + [(f"{r}_cutoff", pa.float64()) for r in RULES]
    )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = []
            for row in batch.to_pylist():
                passed = None
                for i, k in enumerate(row["wrong"]):
                    if no_more(row["n"], k, limit) > level:
                        break
                    passed = i
                cutoffs = {f"{r}_cutoff": None if passed is None else row[f"{r}_tried"][passed] for r in RULES}
                wrong = 0 if passed is None else row["wrong"][passed]
                chosen.append({"stratum": row["stratum"], "n": row["n"], "wrong": wrong} | cutoffs)
            yield pa.RecordBatch.from_pylist(chosen, schema=arrow)

    return staged(counted.mapInArrow(choose, schema), "cutoffs")


def judged(measured: DataFrame, cutoffs: DataFrame, stratum: str) -> DataFrame:
    """Adds `stratum`, `base_failed`, `broken` (names of the rules broken) and `kept`."""
    rows = attach(
        measured.withColumn("stratum", F.coalesce(F.col(stratum), F.lit(""))),
        cutoffs.drop("n", "wrong"), ["stratum"],
    )
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    broken = F.filter(
        F.array(*[F.when(ratio(r) > F.col(f"{r}_cutoff"), F.lit(r)) for r in RULES]),
        lambda x: x.isNotNull(),
    )
    return rows.withColumns({"base_failed": base, "broken": broken}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("broken") == 0)
    )


def halves(doc_id):
    """0 or 1, by the last hex digit of a document's SHA-256; a null counts as empty text."""
    digest = F.sha2(F.coalesce(doc_id.cast("string"), F.lit("")), 256)
    return (F.instr(F.lit("13579bdf"), F.right(digest, F.lit(1))) > 0).cast("int")


def risk_controlled(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", limit: float = 0.01,
    alpha: float = 0.05,
) -> DataFrame:
    """Judge documents (doc_id, text, stratum) by certified cutoffs; see the module's text.

    Labels (doc_id, quality) with null quality are passed over; repeated documents are judged
    each, repeated labels count each. A stratum without enough labelled good documents for its
    limit gets no cutoff and loses nothing but what fails the base rules. Empty tables give
    empty results. `doc_id` splits the labelled documents in two halves.
    """
    need = docs.select("doc_id", "text", F.col(stratum).cast("string").alias("_stratum"))
    measured = staged(measures(need), "measures")
    good = labels.where(F.col("quality").isNotNull()).select("doc_id", (F.col("quality") == 1).alias("_good"))
    labelled = measured.join(good, "doc_id").withColumn("_half", halves(F.col("doc_id")))
    return judged(measured, certified(labelled, "_stratum", "_good", limit, alpha), "_stratum").drop("_stratum")


# The comparison SQL: (1) measures, (2) candidates and the certifying walk, (3) the verdict.
_OVER = {r: f"CASE WHEN {under} > 0 THEN {over} / {under} ELSE 0.0 END" for r, (over, under) in RULES.items()}


def sql(stratum: str = "lang", limit: float = 0.01, alpha: float = 0.05) -> str:
    word = r"[^\x20\x09-\x0D]"
    cut = ", ".join(f"max_by({r}_tried[i], i) AS {r}_cutoff" for r in RULES)
    return f"""
WITH texts AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce({stratum}, '') AS stratum, coalesce(text, '') AS t FROM documents),
parts AS (SELECT *, regexp_extract_all(t, '{word}+') AS words,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{word}')) AS lines,
    list_filter(string_split(t, ''), lambda c: lower(c) <> upper(c)) AS letters FROM texts),
windows AS (SELECT row_id, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS said
  FROM (SELECT row_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM parts)),
again AS (SELECT row_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY row_id, said) > 1),
held AS (SELECT row_id, count(DISTINCT i + j) AS n_repeat_words FROM again, range({WINDOW}) AS r(j) GROUP BY row_id),
m AS (SELECT doc_id, stratum, len(words) AS n_words,
    coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[{SYMBOLS}]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines, len(letters) AS n_letters,
    len(list_filter(letters, lambda c: c = upper(c))) AS n_upper
  FROM parts LEFT JOIN held USING (row_id)),
rated AS (SELECT *, {", ".join(f"{e} AS {r}" for r, e in _OVER.items())} FROM m),
good AS (SELECT rated.*, right(sha256(coalesce(doc_id::VARCHAR, '')), 1) IN ('1', '3', '5', '7', '9', 'b', 'd', 'f') AS certifies
  FROM rated JOIN labels USING (doc_id) WHERE quality = 1),
tried AS (SELECT stratum, {", ".join(f"quantile_disc({r}, [{', '.join(map(str, SHARES))}]) AS {r}_tried" for r in RULES)}
  FROM good WHERE NOT certifies GROUP BY stratum),
steps AS (SELECT stratum, i, count(*) AS n, count(*) FILTER ({" OR ".join(f"{r} > {r}_tried[i]" for r in RULES)}) AS k
  FROM good JOIN tried USING (stratum), range(1, {len(SHARES) + 1}) AS s(i) WHERE certifies GROUP BY stratum, i),
walk AS (SELECT *, list_sum(list_transform(range(0, k + 1), lambda x: CASE WHEN x = n THEN x * ln({limit}) ELSE
      lgamma(n + 1) - lgamma(x + 1) - lgamma(n - x + 1) + x * ln({limit}) + (n - x) * ln(1 - {limit}) END).list_transform(lambda y: exp(y))) AS p,
    {alpha} / (SELECT count(DISTINCT stratum) FROM steps) AS level FROM steps),
ends AS (SELECT *, bool_and(k < n AND p <= level) OVER (PARTITION BY stratum ORDER BY i) AS passed FROM walk),
cutoffs AS (SELECT stratum, {cut} FROM ends JOIN tried USING (stratum) WHERE passed GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  concat_ws(',', {", ".join(f"CASE WHEN {r} > {r}_cutoff THEN '{r}' END" for r in RULES)}) AS broken,
  NOT base_failed AND broken = '' AS kept
FROM rated LEFT JOIN cutoffs USING (stratum)"""
