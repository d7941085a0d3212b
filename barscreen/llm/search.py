"""Ranked lexical search over hashed max-sketches.

A document's score for an item is a sum over the item's terms of a weight times an impact, and the
impact grows with the term's count. A sketch folds the counts of all terms of a document into the
coordinates that the terms hash to, keeping the largest of each; so the impact of a coordinate is
at least that of every term in it, and the weighted sum over an item's coordinates is at least the
item's score. These bounds are looked up for a block of documents and a batch of items at a time.

The search goes down the bounds. The documents of the highest bounds of each item are scored
exactly, which tells a score that k documents reach; then every document whose bound is at least
that is scored, highest bound first, until the bounds fall below the k-th best score. No document
that could be among the k best is left out, and few others are looked at.

Sketches hold counts, not impacts, as the statistics of the whole table (documents, terms) are not
known while they are made: impacts follow from a count by a rising function, so largest counts
give largest impacts, and sketches of new documents can be added to a stored table.
"""

from __future__ import annotations

import math
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from barscreen.llm.common import add_columns, attach, slices, staged

#: Coordinates of a sketch. Only those that a document uses are kept, four bytes each.
PLACES = 1 << 16
#: The largest count a coordinate tells apart; it stands for itself and all above.
MOST = 255
#: An impact is less than this.
IMPACT = 1_000_000
#: Items and distinct terms of one batch (an item of more terms is a batch of its own).
BATCH_ITEMS, BATCH_TERMS = 512, 50_000
#: Fixed value: what a term is, as SQL says it.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """Terms of a text in order: runs of ASCII letters, digits and all other characters, with
    A-Z in lower case. Bytes of other characters are never ASCII, so UTF-8 is cut as it is."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def sketch(counts: dict[bytes, int]) -> bytes:
    """The coordinates in use, each with the largest count of its terms in the lowest byte, as
    ascending little-endian unsigned 32-bit numbers."""
    n = len(counts)
    places = np.fromiter(map(crc32, counts), np.int64, n) % PLACES
    cells = np.sort(places << 8 | np.minimum(np.fromiter(counts.values(), np.int64, n), MOST))
    last = np.append(np.diff(cells >> 8) > 0, True)[:n]  # the largest of each coordinate
    return cells[last].astype("<u4").tobytes()


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, text, mark, n_terms, sketch) of every row of (doc_id, text); other columns are left
    out. `mark` is a hash of id and text, by which rows are found again."""
    rows = docs.select("doc_id", "text").withColumn("mark", F.xxhash64("doc_id", "text"))

    def make(texts: list[str | None]) -> list[pa.Array]:
        sizes, folded = [], []
        for text in texts:
            found = terms(text)
            sizes.append(len(found))
            folded.append(sketch(Counter(found)))
        return [pa.array(sizes, pa.int64()), pa.array(folded, pa.binary())]

    return add_columns(rows, "text", "n_terms long, sketch binary", make)


class Batch:
    """Some items with their terms' weights, which bound and score documents."""

    def __init__(self, items: list[list[bytes]], k: int) -> None:
        self.items, self.k = items, k
        self.numbers = {t: i for i, t in enumerate(dict.fromkeys(t for item in items for t in item))}
        self.docs = self.tokens = 0
        self.weighted: list[list[tuple[bytes, int]]] = []
        self.floors = [1] * len(items)
        self._places: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def weigh(self, docs: int, tokens: int, holding: dict[int, int]) -> None:
        """Set the weights from the documents with a term, all their terms, and the documents
        holding each term by its number. Terms that no document holds are left out."""
        self.docs, self.tokens = docs, tokens
        weights = {
            t: math.floor(1000 * math.log((2 * docs + 2) / (2 * holding[i] + 1)))
            for t, i in self.numbers.items()
            if holding.get(i)
        }
        self.weighted = [[(t, weights[t]) for t in item if t in weights] for item in self.items]

    def measure(self, n_terms: int) -> int:
        return 10 + 90 * n_terms * self.docs // self.tokens

    def places(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the entries of each coordinate start, and the item and weight of every entry."""
        if self._places is None:
            cells = [(crc32(t) % PLACES, i, w) for i, item in enumerate(self.weighted) for t, w in item]
            place, item, weight = np.array(sorted(cells), np.int64).reshape(-1, 3).T
            self._places = np.searchsorted(place, np.arange(PLACES + 1)), item, weight.astype(np.float64)
        return self._places

    def bounds(self, sketches: list[bytes], sizes: list[int]) -> np.ndarray:
        """What the score of each document (row) for each item (column) is at most."""
        starts, item, weight = self.places()
        cells = np.frombuffer(b"".join(sketches), "<u4").astype(np.int64)
        row = np.repeat(np.arange(len(sketches)), [len(s) // 4 for s in sketches])
        entries = np.diff(starts)[cells >> 8]
        used = entries > 0
        cells, row, entries = cells[used], row[used], entries[used]
        count = cells & 255
        measures = np.array([self.measure(n) for n in sizes], np.int64)[row]
        impact = np.where(count == MOST, IMPACT, 10**9 * count // (1000 * count + 8 * measures)).astype(np.float64)
        # Each cell once for every entry of its coordinate.
        ends = np.cumsum(entries)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[cells >> 8] - ends + entries, entries)
        width = len(self.items)
        sums = np.bincount(
            np.repeat(row * width, entries) + item[at], np.repeat(impact, entries) * weight[at], len(sketches) * width
        )
        return sums.reshape(-1, width) * (1 + 1e-9)  # more than the sums could lose in rounding

    def score(self, counts: dict[bytes, int], measure: int, item: int) -> int:
        total = 0
        for term, weight in self.weighted[item]:
            count = counts.get(term)
            if count:
                total += weight * (10**9 * count // (1000 * count + 8 * measure))
        return total


def batches(queries: DataFrame) -> Iterator[tuple[list[object], list[list[bytes]]]]:
    """Ids and distinct terms of the items, a bounded batch at a time; items without terms, which
    find nothing, are passed over. Partitions come to the driver one after the other."""
    ids: list[object] = []
    items: list[list[bytes]] = []
    held = 0
    for row in queries.select("item_id", "text").toLocalIterator():
        found = list(dict.fromkeys(terms(row["text"])))
        if not found:
            continue
        if items and (len(items) >= BATCH_ITEMS or held + len(found) > BATCH_TERMS):
            yield ids, items
            ids, items, held = [], [], 0
        ids.append(row["item_id"])
        items.append(found)
        held += len(found)
    if items:
        yield ids, items


def holding(index: DataFrame, batch: Batch) -> dict[int, int]:
    """In how many documents each term of a batch occurs, by its number."""

    def run(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = batch.numbers.keys()
        here: Counter[bytes] = Counter()
        for piece in pieces:
            for text in piece.column("text").to_pylist():
                here.update(wanted & set(terms(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([batch.numbers[t] for t in here], pa.int64()), pa.array(list(here.values()), pa.int64())],
            names=["term", "n"],
        )

    sums = index.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r.term: r.n for r in sums.collect()}  # at most BATCH_TERMS


def _highest(index: DataFrame, batch: Batch) -> DataFrame:
    """(item, bound, mark): the k highest bounds of each item in each task."""

    def run(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.full((0, len(batch.items)), 0.0)
        marks = np.full((0, len(batch.items)), 0, np.int64)
        for piece in slices(pieces, "sketch"):
            found = batch.bounds(piece.column("sketch").to_pylist(), piece.column("n_terms").to_pylist())
            own = np.broadcast_to(piece.column("mark").to_numpy()[:, None], found.shape)
            top, marks = np.concatenate([top, found]), np.concatenate([marks, own])
            if len(top) > batch.k:
                keep = np.argpartition(-top, batch.k - 1, axis=0)[: batch.k]
                top, marks = np.take_along_axis(top, keep, 0), np.take_along_axis(marks, keep, 0)
        items = np.broadcast_to(np.arange(len(batch.items)), top.shape)
        some = top > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(items[some].astype(np.int32)), pa.array(top[some]), pa.array(marks[some])],
            names=["item", "bound", "mark"],
        )

    return index.select("mark", "n_terms", "sketch").mapInArrow(run, "item int, bound double, mark long")


def _raise_floors(index: DataFrame, batch: Batch) -> None:
    """Score the documents of the k highest bounds of each item for all items: the k-th best
    score of an item is one that its result reaches."""
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "mark")
    first = _highest(index, batch).withColumn("place", F.row_number().over(order)).where(F.col("place") <= batch.k)
    first = staged(first.select("mark").distinct(), "first")
    chosen = attach(index.select("mark", "text", "n_terms"), first, ["mark"], "left_semi")

    def run(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[int]] = [[] for _ in batch.items]
        for piece in pieces:
            for text, size in zip(piece.column("text").to_pylist(), piece.column("n_terms").to_pylist(), strict=True):
                counts, measure = Counter(terms(text)), batch.measure(size)
                for item, scores in enumerate(best):
                    insort(scores, -batch.score(counts, measure, item))
                    del scores[batch.k :]
        rows = [(i, -s) for i, scores in enumerate(best) for s in scores if s]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64())], names=["item", "score"]
        )

    scores = chosen.mapInArrow(run, "item int, score long")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
    for row in scores.withColumn("place", place).where(F.col("place") == batch.k).collect():  # a row an item
        batch.floors[row["item"]] = row["score"]


def _place(row: tuple) -> tuple:
    """Order of (-score, no id, id): two missing ids are not compared."""
    return row[:2] if row[1] else row


def _rescored(index: DataFrame, batch: Batch, id_type: StructField) -> DataFrame:
    """(item, score, doc_id): the k best documents of each item in each task."""

    def run(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in batch.items]
        floors = list(batch.floors)
        kind = pa.int64()
        for piece in slices(pieces, "text"):
            kind = piece.schema.field("doc_id").type
            sizes, ids = piece.column("n_terms").to_pylist(), piece.column("doc_id").to_pylist()
            found = batch.bounds(piece.column("sketch").to_pylist(), sizes)
            texts = piece.column("text")
            counted: dict[int, Counter] = {}
            for item, kept in enumerate(best):
                bound = found[:, item]
                near = np.flatnonzero(bound >= floors[item])
                for row in near[np.argsort(-bound[near], kind="stable")].tolist():
                    if bound[row] < floors[item]:
                        break
                    if row not in counted:
                        counted[row] = Counter(terms(texts[row].as_py()))
                    score = batch.score(counted[row], batch.measure(sizes[row]), item)
                    if score >= floors[item]:
                        insort(kept, (-score, ids[row] is None, ids[row]), key=_place)
                        del kept[batch.k :]
                        if len(kept) == batch.k:
                            floors[item] = max(floors[item], -kept[-1][0])
        rows = [(i, -s, d) for i, kept in enumerate(best) for s, _, d in kept]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], kind)],
            names=["item", "score", "doc_id"],
        )

    schema = StructType.fromDDL("item int, score long").add(StructField("doc_id", id_type.dataType))
    return index.select("doc_id", "text", "n_terms", "sketch").mapInArrow(run, schema)


def ranked(index: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each row of `queries` (item_id,
    text) in a written table of `sketched` documents.

    Equal scores go by doc_id, null ids last. Documents and items without a term, null texts among
    them, find and are found by nothing; repeated rows are ranked each, repeated items give
    repeated results. Items are taken BATCH_ITEMS at a time; each batch reads the table again.
    """
    spark = index.sparkSession
    id_type, item_type = index.schema["doc_id"], queries.schema["item_id"]
    totals = index.agg(F.count(F.when(F.col("n_terms") > 0, 1)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    results: list[DataFrame] = []
    for ids, items in batches(queries) if totals[0] else ():
        batch = Batch(items, k)
        batch.weigh(totals[0], totals[1], holding(index, batch))
        _raise_floors(index, batch)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        best = _rescored(index, batch, id_type).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        named = spark.createDataFrame(
            list(enumerate(ids)), StructType.fromDDL("item int").add(StructField("item_id", item_type.dataType))
        )
        results.append(best.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"))
    if results:
        return reduce(DataFrame.unionAll, results)
    empty = StructType([
        StructField("item_id", item_type.dataType), *StructType.fromDDL("rank int"),
        StructField("doc_id", id_type.dataType), *StructType.fromDDL("score long"),
    ])
    return spark.createDataFrame([], empty)


def search(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """`ranked` over the sketches of (doc_id, text), which are written first."""
    return ranked(staged(sketched(docs), "sketches"), queries, k)


#: Comparison SQL: every document scored for every item that shares a term with it.
SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') AS terms
  FROM documents
), s AS (
  SELECT count(*) FILTER (WHERE len(terms) > 0) AS docs, CAST(sum(len(terms)) AS BIGINT) AS tokens FROM d
), u AS (
  SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d
), t AS (
  SELECT doc_id, n, term, count(*) AS tf FROM u GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * max(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, s GROUP BY term
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS term
  FROM benchmark
), r AS (
  SELECT item_id, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // tokens)))) AS BIGINT) AS score
  FROM q JOIN t USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id
), o AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM r WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10
"""
