"""Toxicity by a factorization machine over hashed terms.

A document is the set of its terms: words and the first letters of words, hashed to 32 bits. A
linear model adds one weight per term; the factorization machine adds, for each two terms
present, the product of their factor vectors, so that an insult next to the mention of a group
can weigh more than both alone. With sum-of-squares algebra scoring costs terms x factors.

The fit sees a bounded draw of labelled rows, each weighing as many as it was drawn from, keeps
the terms whose share differs most between the labels, and learns by mini-batch AdaGrad. So scores
stand for the labels' real rate, whatever share of each label is drawn.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barscreen.llm.common import add_columns, bucket, held

#: Bounds of the fit: labelled rows drawn of each label, terms kept.
FIT_ROWS, FIT_TERMS = {1: 3_000, 0: 5_000}, 2_000
FACTORS, EPOCHS, BATCH = 8, 30, 256
#: Words are also described by their first letters, if they are longer.
STEM = 5
#: Word cache of a worker process: entries.
CACHE = 200_000
_WORD = re.compile(r"\w+")


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def word_terms(word: str) -> tuple[int, ...]:
    """32-bit hashes of a word and, if it is longer, of its stem."""
    own = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    if len(word) <= STEM:
        return (own,)
    return own, zlib.crc32(b"\0" + word[:STEM].encode("utf-8", "surrogatepass"))


def terms(text: str | None) -> np.ndarray:
    """Sorted distinct terms of a text."""
    found = {t for w in words(text or "") for t in word_terms(w)}
    return np.sort(np.fromiter(found, np.uint32, len(found)))


class Machine:
    """score = sigmoid(bias + sum w_i + sum over pairs <v_i, v_j>) over the known terms present."""

    def __init__(self, known: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray) -> None:
        self.bias, self.weights, self.factors = bias, weights, factors
        self.index = {int(t): i for i, t in enumerate(known)}
        self.cache: dict[str, tuple[int, ...]] = {}

    def rows(self, word: str) -> tuple[int, ...]:
        found = self.cache.get(word)
        if found is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            found = tuple(self.index[t] for t in word_terms(word) if t in self.index)
            self.cache[word] = found
        return found

    def score(self, text: str | None) -> float:
        present = sorted({i for w in words(text or "") for i in self.rows(w)})
        return _sigmoid(self.raw(np.array(present, np.int64)))

    def raw(self, present: np.ndarray) -> float:
        v = self.factors[present]
        pairs = 0.5 * float((v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())
        return self.bias + float(self.weights[present].sum()) + pairs


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _document_counts(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All terms in order, and in how many documents of label 1 and of label 0 each occurs."""
    sides = [np.unique(np.concatenate([r for r, y in zip(rows, labels, strict=True) if y == side]), return_counts=True) for side in (1, 0)]
    known = np.union1d(sides[0][0], sides[1][0])
    counts = [np.zeros(len(known), np.int32) for _ in sides]
    for (terms_, n), into in zip(sides, counts, strict=True):
        into[np.searchsorted(known, terms_)] = n
    return known, *counts


def learned(rows: list[np.ndarray], labels: np.ndarray, seed: int = 7, stands: tuple[float, float] = (1.0, 1.0)) -> Machine:
    """A machine from term arrays and 0/1 labels, a row of label 0 and 1 standing for so many. One
    label alone, or no rows, gives the constant that fits it: half without rows."""
    n1, n0 = int(labels.sum()), int((1 - labels).sum())
    if not n1 or not n0:
        rate = 0.5 if not len(labels) else (n1 + 0.05) / (len(labels) + 0.1)
        return Machine(np.empty(0, np.uint32), float(np.log(rate / (1 - rate))), np.empty(0), np.empty((0, FACTORS)))
    known, in1, in0 = _document_counts(rows, labels)
    # Two-proportion z-score with one document added to each side.
    p1, p0 = (in1 + 0.5) / (n1 + 1), (in0 + 0.5) / (n0 + 1)
    both = (in1 + in0 + 1) / (n1 + n0 + 2)
    z = (p1 - p0) / np.sqrt(both * (1 - both) * (1 / (n1 + 1) + 1 / (n0 + 1)))
    chosen = np.flatnonzero((np.abs(z) >= 3) & (in1 + in0 >= 2))
    if len(chosen) > FIT_TERMS:
        chosen = chosen[np.argsort(-np.abs(z[chosen]), kind="stable")[:FIT_TERMS]]
    terms_kept = known[np.sort(chosen)]
    x = np.zeros((len(rows), len(terms_kept)), np.float32)
    for i, row in enumerate(rows):
        x[i] = np.isin(terms_kept, row, assume_unique=True)
    rng = np.random.default_rng(seed)
    w = np.zeros(len(chosen), np.float32)
    v = rng.normal(0, 0.02, (len(chosen), FACTORS)).astype(np.float32)
    bias = np.float32(np.log(n1 * stands[1] / (n0 * stands[0])))
    weight = np.where(labels == 1, stands[1], stands[0])
    weight = (weight / weight.mean()).astype(np.float32)
    grown_w, grown_v = np.full_like(w, 1e-3), np.full_like(v, 1e-3)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), BATCH):
            part = order[start : start + BATCH]
            xb, yb = x[part], labels[part]
            xv = xb @ v
            raw = bias + xb @ w + 0.5 * ((xv**2).sum(axis=1) - xb @ (v**2).sum(axis=1))
            off = (_sigmoid(raw) - yb).astype(np.float32) * weight[part] / len(part)
            gw = xb.T @ off + 1e-4 * w
            gv = xb.T @ (off[:, None] * xv) - (xb.T @ off)[:, None] * v + 1e-3 * v
            grown_w += gw**2
            grown_v += gv**2
            w -= 0.2 * gw / np.sqrt(grown_w)
            v -= 0.02 * gv / np.sqrt(grown_v)
            bias -= np.float32(0.1) * off.sum()
    return Machine(terms_kept, float(bias), w.astype(float), v.astype(float))


def fit(docs: DataFrame, labels: DataFrame, draws: dict[int, int] | None = None) -> Machine:
    """A machine from texts (doc_id, text) and labels (doc_id, toxic): so many labels of each
    kind, drawn by hash of the id.

    A drawn label stands for the labels of its kind over those drawn. Null labels are passed
    over, null texts are documents without terms. The drawn labels are bounded by the parameter
    and so are broadcast; only hashed terms reach the driver.
    """
    kinds = sorted((draws or FIT_ROWS).items())
    drawn = [
        labels.where(F.col("toxic") == label).select("doc_id", F.lit(label).alias("_toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        for label, n in kinds
    ]
    chosen = drawn[0]
    for more in drawn[1:]:
        chosen = chosen.unionAll(more)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def make(texts: list[str | None]) -> list[pa.Array]:
        return [pa.array([terms(t).tobytes() for t in texts], pa.binary())]

    found = add_columns(rows, "text", "_terms binary", make, keep_text=False).select("_toxic", "_terms")
    got = sorted((r["_toxic"], r["_terms"]) for r in found.toArrow().to_pylist())
    arrays = [np.frombuffer(t, np.uint32) for _, t in got]
    counted = labels.agg(*[F.count_if(F.col("toxic") == label).alias(f"n{label}") for label, _ in kinds]).first()
    stands = {label: max(1.0, counted[f"n{label}"] / n) for label, n in kinds if n}
    return learned(arrays, np.array([label for label, _ in got], np.int64), stands=(stands.get(0, 1.0), stands.get(1, 1.0)))


def scored(docs: DataFrame, machine: Machine, text: str = "text", name: str = "score", keep_text: bool = True) -> DataFrame:
    """Every column of `docs` (its texts if asked) and the score of every whole text, 0 to 1.

    One pass, no shuffle. Null and empty texts get the score of a document without terms.
    """
    known = np.fromiter(machine.index, np.uint32, len(machine.index))
    parts = (known, machine.bias, machine.weights, machine.factors)
    key = zlib.crc32(repr((machine.bias, machine.weights.tobytes(), machine.factors.tobytes(), known.tobytes())).encode())

    def make(texts: list[str | None]) -> list[pa.Array]:
        model = held(("machine", key), lambda: Machine(*parts))  # once in a worker process
        return [pa.array([float(model.score(t)) for t in texts], pa.float64())]

    return add_columns(docs, text, f"{name} double", make, keep_text)


def held_out() -> Column:
    return bucket(F.col("doc_id"), 4) == 2
