"""SimHash near-duplicates by a self-join of a binary trie.

Fingerprints that differ in at most four of 64 bits are linked. Two nodes of the trie are
traversed together, the bits in which their paths differ are added up, and a pair is dropped as
soon as that sum exceeds the budget of its depth.

The bits form a ring of five blocks. If two fingerprints differ in four bits or fewer, then at
least one of the five rotations of the ring has at most 0, 1, 2, 3, 4 differing bits in its first
1, 2, 3, 4, 5 blocks (the pigeonring principle). So each fingerprint enters five tries, one per
rotation, and these tight budgets prune most pairs near the root. It also makes the join
distributable: pairs meet only under nodes that agree in the first block, so the tries are dealt
out by (rotation, first block). A node with too many fingerprints is descended by one more block,
in which one bit may differ: its fingerprints go to the nodes that share all bits but one. What
is still too large is cut in pieces, and every two pieces meet in a task. Nothing is dropped.

A task returns a spanning forest of the links it finds, not the links: a group of copies costs
as many rows as it has fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barscreen.llm.common import add_columns, attach, fresh, staged
from barscreen.llm.components import connected

SHINGLE, SEED, BUDGET = 4, 42, 4
BLOCKS = (13, 13, 13, 13, 12)
#: Fingerprints a node may hold before it is descended or cut.
NODE_ROWS = 2_000
#: Rows that a task joins at a time, and node pairs that it holds at a time.
BATCH_ROWS, FRONTIER = 40_000, 400_000


def fingerprint(text: str | None) -> int:
    """Unsigned fingerprint of one text; null and wordless texts have 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes + 1) - sizes - 1
    n = max(1, len(words) - SHINGLE + 1)
    ends = (starts + sizes)[-n:].tolist()
    parts = [joined[s:e] for s, e in zip(starts[:n].tolist(), ends, strict=True)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, n)
    set_bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fp", keep_text: bool = False) -> DataFrame:
    """Every column of `docs` (its texts if asked) and the fingerprint as a signed long."""

    def make(texts: list[str | None]) -> list[pa.Array]:
        found = np.fromiter(map(fingerprint, texts), np.uint64, len(texts))
        return [pa.array(found.view(np.int64))]

    return add_columns(docs, text, f"{name} long", make, keep_text)


def _budgets() -> np.ndarray:
    """Bits that may differ down to each depth (columns 0 to 64), per rotation."""
    out = np.zeros((len(BLOCKS), 65), np.int64)
    for r in range(len(BLOCKS)):
        depth = 0
        for i in range(len(BLOCKS)):
            size = BLOCKS[(r + i) % len(BLOCKS)]
            out[r, depth + 1 : depth + size + 1] = BUDGET * (i + 1) // len(BLOCKS)
            depth += size
    return out


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of a[i] and b[i]; `label` holds the least member of every row's set."""
    while len(a):
        left, right = label[a], label[b]
        apart = left != right
        a, b, left, right = a[apart], b[apart], left[apart], right[apart]
        np.minimum.at(label, np.maximum(left, right), np.minimum(left, right))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def trie_join(keys: np.ndarray, starts: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """Label of every row after linking, within each group, all rows within the budget.

    `keys` are rotated fingerprints, ascending inside each range; `starts` holds the frontier to
    begin with: rows (a_from, a_to, b_from, b_to), a range with itself or two ranges.
    """
    budgets = _budgets()
    label = np.arange(len(keys))
    zero = np.zeros(len(starts), np.int64)
    work = [(0, np.column_stack([starts, zero, rotation]))] if len(starts) else []
    ones: dict[int, np.ndarray] = {}
    while work:
        depth, pairs = work.pop()
        if len(pairs) > FRONTIER:
            work += [(depth, pairs[:FRONTIER]), (depth, pairs[FRONTIER:])]
            continue
        a0, a1, b0, b1, errors, rot = pairs.T
        same = a0 == b0
        # Below here no further difference can exceed the budget: both ranges are linked whole.
        sure = (64 - depth + errors <= BUDGET) & (budgets[rot, 64] == BUDGET)
        few = ~sure & ((a1 - a0) * (b1 - b0) <= 16)
        for chosen, whole in ((sure, True), (few, False)):
            if chosen.any():
                _leaves(keys, label, pairs[chosen], whole)
        go = ~(sure | few)
        if not go.any():
            continue
        a0, a1, b0, b1, errors, rot, same = (x[go] for x in (a0, a1, b0, b1, errors, rot, same))
        if depth not in ones:
            bit = (keys >> np.uint64(63 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate([[0], np.cumsum(bit.astype(np.int64))])
        c = ones[depth]
        am, bm = a1 - (c[a1] - c[a0]), b1 - (c[b1] - c[b0])
        other = ~same
        more = errors + 1
        nxt = np.concatenate([
            np.column_stack([a0, am, b0, bm, errors, rot]),
            np.column_stack([am, a1, bm, b1, errors, rot]),
            np.column_stack([a0, am, bm, b1, more, rot]),
            np.column_stack([am, a1, b0, bm, more, rot])[other],
        ])
        alive = (nxt[:, 0] < nxt[:, 1]) & (nxt[:, 2] < nxt[:, 3])
        alive &= nxt[:, 4] <= budgets[nxt[:, 5], depth + 1]
        alive &= ~((nxt[:, 0] == nxt[:, 2]) & (nxt[:, 1] - nxt[:, 0] == 1))
        if alive.any():
            work.append((depth + 1, nxt[alive]))
    return label


def _leaves(keys: np.ndarray, label: np.ndarray, pairs: np.ndarray, whole: bool) -> None:
    """Link the rows of pairs of ranges: all to the first one, or each two that are near."""
    a0, a1, b0, b1 = pairs.T[:4]
    if whole:
        for lo, hi in ((a0, a1), (b0, b1)):
            sizes = hi - lo
            first = np.repeat(a0, sizes)
            rows = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(lo, sizes)
            _unite(label, first, rows)
        return
    wide = b1 - b0
    sizes = (a1 - a0) * wide
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    wide = np.repeat(wide, sizes)
    a, b = np.repeat(a0, sizes) + within // wide, np.repeat(b0, sizes) + within % wide
    near = np.bitwise_count(keys[a] ^ keys[b]) <= BUDGET
    _unite(label, a[near], b[near])


def _rotated(fp: str, r: int):
    turn = sum(BLOCKS[:r])
    return F.shiftleft(fp, turn).bitwiseOR(F.shiftrightunsigned(fp, 64 - turn)) if turn else F.col(fp)


def _nodes(fps: DataFrame, node_rows: int) -> DataFrame:
    """Rows (node, piece, other, side, rotation, key): fingerprints that must meet.

    `node` is a hash of what the fingerprints share (two nodes with one hash only meet in vain);
    a piece meets itself (`other` = `piece`) or another piece, as side 0 or 1.
    """
    sizes = F.array(*[F.lit(b) for b in BLOCKS])
    rows = fps.select(
        F.posexplode(F.array(*[_rotated("fp", r) for r in range(len(BLOCKS))])).alias("rotation", "key")
    ).withColumn("size", sizes[F.col("rotation")])
    rows = rows.withColumn("first", F.expr("shiftrightunsigned(key, 64 - size)"))
    rows = rows.withColumn("node", F.xxhash64("rotation", "first"))
    counts = staged(rows.groupBy("node").agg(F.count("*").alias("n")), "nodes")
    rows = attach(rows, counts, ["node"], "inner")
    few = rows.where(F.col("n") <= node_rows).select("node", "rotation", "key", F.lit(1).cast("long").alias("n"))
    # One more block, in which one bit is left open, or none: equal there, or different in that bit.
    second = sizes[(F.col("rotation") + 1) % len(BLOCKS)]
    deep = (
        rows.where(F.col("n") > node_rows)
        .withColumn("second", second)
        .withColumn("bits", F.expr("shiftrightunsigned(shiftleft(key, size), 64 - second)"))
        .withColumn("open", F.explode(F.expr("sequence(0, second)")))
        .withColumn(
            "node",
            F.xxhash64("node", "open", F.expr("if(open = second, bits, bits & ~shiftleft(1L, open))")),
        )
        .select("node", "rotation", "key")
    )
    counts = staged(deep.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") > node_rows), "crowded")
    deep = attach(deep, counts, ["node"]).select("node", "rotation", "key", F.ceil(F.coalesce("n", F.lit(1)) / node_rows).alias("n"))
    rows = few.unionByName(deep).withColumn("own", F.expr("cast(pmod(xxhash64(key), n) as int)"))
    return rows.withColumn("met", F.explode(F.expr("sequence(0, cast(n as int) - 1)"))).select(
        "node", F.least("own", "met").alias("piece"), F.greatest("own", "met").alias("other"),
        (F.col("own") > F.col("met")).cast("int").alias("side"), "rotation", "key",
    )


def links(fps: DataFrame, node_rows: int = NODE_ROWS) -> DataFrame:
    """Edges (a, b) of distinct fingerprints (column `fp`, signed long) that span the same
    components as all links of BUDGET bits or fewer."""
    order = ["node", "piece", "other", "side", "key"]
    nodes = _nodes(fps, node_rows)
    dealt = nodes.repartition("node", "piece", "other").select(*order, "rotation", F.expr("key ^ (1L << 63)").alias("unsigned_order"))
    dealt = dealt.sortWithinPartitions("node", "piece", "other", "rotation", "side", "unsigned_order").drop("unsigned_order")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows = 0
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "piece", "other", "side", "rotation", "key")]
            held.append(np.column_stack([c.astype(np.int64) for c in columns]))
            rows += batch.num_rows
            if rows >= BATCH_ROWS:
                table = np.concatenate(held)
                last = np.flatnonzero((table[:, [0, 1, 2, 4]] != table[-1, [0, 1, 2, 4]]).any(axis=1))
                cut = int(last[-1]) + 1 if len(last) else 0
                if cut:
                    yield _edges(table[:cut])
                held, rows = [table[cut:]], len(table) - cut
        if rows:
            yield _edges(np.concatenate(held))

    return dealt.mapInArrow(run, "a long, b long").dropDuplicates()


def _edges(table: np.ndarray) -> pa.RecordBatch:
    """The spanning edges of the groups in a table of (node, piece, other, side, rotation, key)."""
    group, side, rotation, keys = table[:, [0, 1, 2, 4]], table[:, 3], table[:, 4], table[:, 5].view(np.uint64)
    new = np.concatenate([[True], (group[1:] != group[:-1]).any(axis=1)])
    lo = np.flatnonzero(new)
    hi = np.concatenate([lo[1:], [len(table)]])
    sides = np.concatenate([[0], np.cumsum(side)])
    mid = hi - (sides[hi] - sides[lo])
    itself = table[lo, 1] == table[lo, 2]
    starts = np.where(itself[:, None], np.column_stack([lo, hi, lo, hi]), np.column_stack([lo, mid, mid, hi]))
    met = np.where(itself, hi - lo > 1, (mid > lo) & (hi > mid))
    keys = np.ascontiguousarray(keys)
    label = trie_join(keys, starts[met], rotation[lo][met])
    rows = np.flatnonzero(label != np.arange(len(label)))
    turn = np.array([sum(BLOCKS[:r]) for r in range(len(BLOCKS))], np.uint64)[rotation[rows]]
    back = np.uint64(64) - turn

    def original(k: np.ndarray) -> np.ndarray:
        return np.where(turn == 0, k, (k >> turn) | (k << (back % np.uint64(64)))).view(np.int64)

    return pa.RecordBatch.from_arrays([pa.array(original(keys[rows])), pa.array(original(keys[label[rows]]))], names=["a", "b"])


def near_duplicates(docs: DataFrame, node_rows: int = NODE_ROWS) -> DataFrame:
    """(doc_id, fp, component_id) of every row of (doc_id, text).

    `component_id` is the smallest doc_id that links reach; null only if all ids reached are
    null. Repeated rows give repeated results; empty texts are linked with each other.
    """
    printed = staged(fingerprints(docs.select("doc_id", "text")), "fingerprints")
    classes = staged(printed.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    joined = connected(links(classes.select("fp"), node_rows))
    roots = classes.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = staged(roots.join(least, "root").select("fp", "component_id"), "components")
    return attach(printed, named, ["fp"])


def keep_one(docs: DataFrame, node_rows: int = NODE_ROWS) -> DataFrame:
    """`docs` with one row of each group of near-duplicates: that of the smallest doc_id.

    All columns stay. Rows without an id come after those with one; among rows with one id the
    smallest hash of the whole row decides, and rows equal throughout count as one.
    """
    fp, root, order = fresh(docs, "_fp"), fresh(docs, "_root"), fresh(docs, "_order")
    printed = staged(fingerprints(docs, name=fp, keep_text=True), "printed")
    prints = printed.select(F.col(fp).alias("fp")).distinct()
    prints = staged(prints, "prints")
    joined = connected(links(prints, node_rows)).select(F.col("node").alias(fp), F.col("root").alias(root))
    named = staged(joined, "roots")
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64(*docs.columns))
    rows = attach(printed, named, [fp]).withColumns({root: F.coalesce(root, fp), order: rank})
    best = rows.groupBy(root).agg(F.min(order).alias(order))
    best = staged(best, "best")
    kept = rows.join(best, [root, order], "left_semi") if best.count() > 0 else rows
    return kept.dropDuplicates([root]).select(*docs.columns)
