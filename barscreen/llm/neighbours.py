"""Embedding near-duplicates by NN-descent.

Exact copies are one node that counts as many. Each node keeps a list of its LIST nearest nodes
so far. Lists start from runs of nodes that sort next to each other by the signs of random
projections. Then, round by round, each node joins its neighbours (and nodes that list it) with
each other: neighbours of neighbours are likely neighbours, and a node takes those that are
nearer than its list's last. This runs on one-byte components; pairs near the threshold are then
checked in double precision, and only those at or above it are links.

A list whose every member is a link is saturated: the node may have more. Such nodes are put in
blocks and compared with all nodes, without those that the angle to a block's centre rules out.
So no link is lost to the length of lists; what the descent may miss between other nodes is
audited against brute force for a set of nodes that grows with the table, and rounds are added
until recall is met; if EXTRA_ROUNDS do not do, the job fails.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barscreen.llm.common import joined_schema, staged
from barscreen.llm.components import connected

LIST, TABLES, RUN = 12, 4, 48
ROUNDS, EXTRA_ROUNDS, RECALL = 3, 16, 0.98
BLOCK, AUDITED = 128, 200
#: Saturated nodes sent to tasks at a time, nodes a task compares at a time.
PIECE_BYTES, COMPARED = 8 << 20, 2048
#: Added to angles, far above what rounding takes from them.
ANGLE = 1e-6
PLANES = 32
ALL = 4.0  # above any cosine: takes no more neighbours


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """Rows of a binary column as vectors; shorter ones are filled up with zeros."""
    rows = column.to_pylist()
    sizes = {len(r) for r in rows}
    if len(sizes) == 1:
        return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1)
    width = max(sizes)
    return np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), kind).reshape(len(rows), -1)


def nodes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vec_id, vec) of every row, null where a vector can't link, and the distinct vectors
    (id, size, vec, q, off): smallest vec_id, number of copies, doubles, one-byte components and
    the angle between the two.

    Vectors are brought to components below one by a power of two, which takes nothing from their
    digits and keeps squares of very large or small ones from leaving the range.
    """
    schema = joined_schema(vectors.select("vec_id"), "vec binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[bytes | None] = []
            for row in batch.column("embedding").to_pylist():
                v = np.array(row if row is not None else [], np.float64)
                usable = len(v) and np.isfinite(v).all() and v.any()
                made.append(np.ldexp(v, -np.frexp(np.abs(v).max())[1]).tobytes() if usable else None)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(made, pa.binary())], names=["vec_id", "vec"])

    plain = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = staged(plain.mapInArrow(run, schema), "vectors")
    classes = rows.where("vec is not null").groupBy("vec").agg(F.min("vec_id").alias("low"), F.count("*").alias("size"))
    classes = classes.withColumn("id", F.xxhash64("vec"))

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column("vec"), np.float64)
                q = np.rint(v / np.abs(v).max(axis=1, keepdims=True) * 127).astype(np.int8)
                apart = np.linalg.norm(v / np.linalg.norm(v, axis=1, keepdims=True) - _unit(q, np.float64), axis=1)
                made = [pa.array([r.tobytes() for r in q], pa.binary()), pa.array(2 * np.arcsin(np.minimum(apart / 2, 1)))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "q", "off"])

    return rows, staged(classes.mapInArrow(small, joined_schema(classes, "q binary, off double")), "nodes")


def slack(nodes: DataFrame, threshold: float) -> float:
    """How far below the threshold the one-byte cosine of a link can lie: two vectors' angle
    grows by no more than both angles to their one-byte forms; the products are summed in four
    bytes."""
    off, width = nodes.agg(F.max("off"), F.max(F.length("q"))).first()
    wider = np.arccos(np.clip(threshold, -1, 1)) + 2 * (off or 0.0) + ANGLE
    return float(threshold - np.cos(min(wider, np.pi)) + (width or 0) * 2.0**-22)


def _unit(q: np.ndarray, kind: type = np.float32) -> np.ndarray:
    v = q.astype(kind)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _pairs(ids: list[np.ndarray], others: list[np.ndarray], sims: list[np.ndarray]) -> pa.RecordBatch:
    columns = [np.concatenate(x) if x else np.empty(0, t) for x, t in ((ids, np.int64), (others, np.int64), (sims, np.float32))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "other", "sim"])


PAIRS = "id long, other long, sim float"
MET = "id long, other long, n long"


def first_lists(nodes: DataFrame, seed: int) -> DataFrame:
    """(id, other, sim): the nearest of each node among the RUN nodes around it in each of
    TABLES orders. Runs are pieces of a range sort, so none grows with a crowd."""

    def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _unit(_matrix(batch.column("q"), np.int8))
            planes = np.random.default_rng(seed).normal(size=(TABLES * PLANES, v.shape[1])).astype(np.float32)
            bits = ((v @ planes.T) > 0).reshape(len(v), TABLES, PLANES)
            keys = bits @ (1 << np.arange(PLANES - 1, -1, -1, dtype=np.int64))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(TABLES, dtype=np.int32), n)), pa.array(keys.T.ravel()),
                    pa.concat_arrays([batch.column("id")] * TABLES), pa.concat_arrays([batch.column("q")] * TABLES),
                ],
                names=["table", "key", "id", "q"],
            )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, others, sims = [], [], []
            table = batch.column("table").to_numpy()
            every = batch.column("id").to_numpy()
            for start in range(0, batch.num_rows, RUN):
                part = slice(start, min(batch.num_rows, start + RUN))
                own = every[part]
                v = _unit(_matrix(batch.column("q").slice(start, len(own)), np.int8))
                sim = v @ v.T
                sim[table[part][:, None] != table[part][None, :]] = -2
                np.fill_diagonal(sim, -2)
                k = min(LIST, len(own) - 1)
                if k < 1:
                    continue
                best = np.argpartition(-sim, k - 1, axis=1)[:, :k]
                value = np.take_along_axis(sim, best, axis=1)
                good = value > -2
                ids.append(np.repeat(own, k)[good.ravel()])
                others.append(own[best][good])
                sims.append(value[good])
            yield _pairs(ids, others, sims)

    keyed = nodes.select("id", "q").mapInArrow(signs, "table int, key long, id long, q binary")
    ordered = staged(keyed, "signs").repartitionByRange("table", "key", "id").sortWithinPartitions("table", "key", "id")
    return ordered.mapInArrow(runs, PAIRS)


def _kept(pairs: DataFrame) -> DataFrame:
    """The LIST nearest of each node; `fresh` where the pair was not `old`."""
    one = pairs.repartition("id").groupBy("id", "other").agg(F.max("sim").alias("sim"), F.max("old").alias("old"))
    nearest = Window.partitionBy("id").orderBy(F.desc("sim"), "other")
    return one.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= LIST).drop("rank")


def _local_joins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of nodes that meet at a common neighbour and are news to one of them."""
    held: list[pa.RecordBatch] = []

    def joined(table: pa.Table) -> pa.RecordBatch:
        mid = table.column("mid").to_numpy()
        ids, old, last = (table.column(c).to_numpy() for c in ("id", "old", "last"))
        v = _unit(_matrix(table.column("q").combine_chunks(), np.int8))
        new = np.concatenate([[True], mid[1:] != mid[:-1]])
        group = np.cumsum(new) - 1
        place = np.arange(len(mid)) - np.flatnonzero(new)[group]
        width = int(place.max()) + 1
        cube = np.zeros((group[-1] + 1, width, v.shape[1]), np.float32)
        cube[group, place] = v
        grid = np.full((len(cube), width), -1)
        grid[group, place] = np.arange(len(mid))
        sim = cube @ cube.transpose(0, 2, 1)
        row_last = np.where(grid >= 0, last[grid], ALL)
        row_old = np.where(grid >= 0, old[grid], 1)
        wanted = (sim > row_last[:, :, None]) & (grid >= 0)[:, None, :]
        wanted &= (row_old[:, :, None] == 0) | (row_old[:, None, :] == 0)
        g, a, b = np.nonzero(wanted)
        rows, cols = grid[g, a], grid[g, b]
        apart = ids[rows] != ids[cols]
        return _pairs([ids[rows][apart]], [ids[cols][apart]], [sim[g, a, b][apart]])

    rows = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= 20_000:
            table = pa.Table.from_batches(held)
            mid = table.column("mid").to_numpy()
            cut = int(np.searchsorted(mid, mid[-1]))
            if cut:
                yield joined(table.slice(0, cut))
            rest = table.slice(cut).combine_chunks()
            held, rows = rest.to_batches(), rest.num_rows
    if held:
        yield joined(pa.Table.from_batches(held))


def improved(lists: DataFrame, nodes: DataFrame, threshold: float, turn: int = 0) -> DataFrame:
    """One round: every node joins its neighbours and up to LIST nodes that list it, drawn anew
    each turn. Those not drawn the turn before are news to the others."""
    state = lists.groupBy("id").agg(
        F.when((F.count("*") >= LIST) & (F.min("sim") >= threshold), F.lit(ALL))
        .when(F.count("*") >= LIST, F.min("sim")).otherwise(F.lit(-2.0)).cast("float").alias("last")
    )
    known = nodes.select("id", "q").join(state, "id")
    back = lists.select(F.col("other").alias("mid"), "id", "old")
    for name, at in (("n", turn), ("past", turn - 1)):
        drawn = Window.partitionBy("mid").orderBy(F.xxhash64("id", "mid", F.lit(at)), "id")
        back = back.withColumn(name, F.row_number().over(drawn))
    back = back.where(F.col("n") <= LIST).withColumn("old", F.when(F.col("past") <= LIST, F.col("old")).otherwise(0))
    there = lists.select(F.col("id").alias("mid"), F.col("other").alias("id"), "old")
    met = there.unionByName(back.drop("n", "past")).groupBy("mid", "id").agg(F.min("old").alias("old"))
    rows = met.join(known, "id").select("mid", "id", "old", "last", "q")
    found = rows.repartition("mid").sortWithinPartitions("mid").mapInArrow(_local_joins, PAIRS)
    before = lists.select("id", "other", "sim", F.lit(1).alias("old"))
    return staged(_kept(before.unionByName(found.withColumn("old", F.lit(0)))), "lists")


def descend(nodes: DataFrame, threshold: float, rounds: int, seed: int, lists: DataFrame | None = None) -> DataFrame:
    """(id, other, sim, old) lists after some rounds, from scratch or, the seed being the number
    of rounds they had, from given ones."""
    past = seed
    if lists is None:
        past, lists = 0, staged(_kept(first_lists(nodes, seed).withColumn("old", F.lit(0))), "lists")
    for turn in range(past, past + rounds):
        if lists.where("old = 0").isEmpty():
            break
        lists = improved(lists, nodes, threshold, turn)
    return lists


def _cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def exact_links(lists: DataFrame, nodes: DataFrame, threshold: float, below: float) -> DataFrame:
    """(a, b), a < b: listed pairs whose cosine in double precision reaches the threshold, checked
    where the one-byte cosine is at most `below` less."""
    close = lists.where(F.col("sim") >= threshold - below)
    close = close.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
    vec = nodes.select("id", "vec")
    rows = close.join(vec.select(F.col("id").alias("a"), F.col("vec").alias("va")), "a")
    rows = rows.join(vec.select(F.col("id").alias("b"), F.col("vec").alias("vb")), "b").select("a", "b", "va", "vb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                both = _matrix(pa.concat_arrays([batch.column("va"), batch.column("vb")]), np.float64)
                good = _cosine(both[: batch.num_rows], both[batch.num_rows :]) >= threshold
                yield batch.select(["a", "b"]).filter(pa.array(good))

    return staged(rows.mapInArrow(run, "a long, b long"), "links")


def _drawn(nodes: DataFrame, n: float, of: int, seed: int) -> DataFrame:
    """About n of the nodes by hash; no task gathers them."""
    share = int(min(1.0, n / max(of, 1)) * (1 << 30))
    return nodes.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < share)


def audit(links: DataFrame, nodes: DataFrame, threshold: float, full: DataFrame | None = None, seed: int = 0) -> float:
    """Estimated share of link ends that `links` has among nodes that are not in `full` (id):
    the links of these are counted exactly later. 1 if no link end was seen.

    Some nodes with links found and some without are compared with all nodes. Of the latter
    there are so many that, if a share 1 - RECALL of as many link ends as nodes with links had
    been lost, one is seen with 95% probability; where less than one node in the root of all
    has a link, as many as if it were so. Both draws grow with the table.
    """
    free = nodes if full is None else nodes.join(full, "id", "left_anti")
    free = staged(free, "free")
    ids = free.select("id")
    both = links.select("a", "b").unionAll(links.select("b", "a")).toDF("id", "other")
    both = both.join(ids, "id", "left_semi").join(ids.toDF("other"), "other", "left_semi").distinct()
    known = staged(both.groupBy("id").agg(F.count("*").alias("k")), "known")
    every, linked = free.count(), known.count()
    if not every:
        return 1.0
    root = every**0.5
    wanted = max(AUDITED, 4 * root, 3 / ((1 - RECALL) * max(linked / every, 1 / root)))
    with_, without = free.join(known, "id"), free.join(known, "id", "left_anti").withColumn("k", F.lit(0).cast("long"))
    asked = _drawn(with_, max(AUDITED, 4 * root), linked, seed).unionByName(_drawn(without, wanted, every - linked, seed))
    asked = staged(asked.withColumn("size", F.lit(1).cast("long")).withColumn("root", F.lit(0).cast("long")), "asked")
    one = free.withColumn("size", F.lit(1).cast("long")).withColumn("open", F.lit(False))
    truth = compared(asked, one, threshold, edges=False).groupBy("id").agg(F.sum("n").alias("n"))
    sums = asked.join(truth, "id", "left").groupBy((F.col("k") > 0).alias("found")).agg(
        F.count("*").alias("rows"), F.sum("k").alias("k"), F.sum(F.coalesce("n", F.lit(0))).alias("n")
    )
    have = true = 0.0
    for r in sums.collect():
        weight = (linked if r.found else every - linked) / r.rows
        have, true = have + weight * r.k, true + weight * r.n
    return have / true if true else 1.0


def blocked(members: DataFrame) -> DataFrame:
    """(block, id, size, vec) of (root, id, size, vec, q): up to BLOCK members of one group that
    sort next to each other by the signs of random projections."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = _unit(_matrix(batch.column("q"), np.int8))
                planes = np.random.default_rng(3).normal(size=(PLANES, v.shape[1])).astype(np.float32)
                key = ((v @ planes.T) > 0) @ (1 << np.arange(PLANES - 1, -1, -1, dtype=np.int64))
                kept = batch.select(["root", "id", "size", "vec"])
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(key)], names=[*kept.schema.names, "key"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            root, ids = batch.column("root").to_numpy(), batch.column("id").to_numpy()
            starts = [0] * bool(len(ids))
            for at in range(1, len(ids)):
                if root[at] != root[starts[-1]] or at - starts[-1] == BLOCK:
                    starts.append(at)
            first = np.repeat(ids[starts], np.diff([*starts, len(ids)]))
            yield pa.RecordBatch.from_arrays([pa.array(first, pa.int64()), *batch.select(["id", "size", "vec"]).columns], names=["block", "id", "size", "vec"])

    keyed = staged(members.select("root", "id", "size", "vec", "q").mapInArrow(keys, "root long, id long, size long, vec binary, key long"), "keys")
    ordered = keyed.repartitionByRange("root", "key", "id").sortWithinPartitions("root", "key", "id")
    return staged(ordered.mapInArrow(cut, "block long, id long, size long, vec binary"), "blocks")


def _wide(v: np.ndarray, width: int) -> np.ndarray:
    return np.pad(v, ((0, 0), (0, width - v.shape[1])))


def _merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels, each the least member of its group, after the members a and b were joined."""
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


class Blocks:
    """Some blocks of members that are compared with any nodes in double precision.

    A block has a centre and the greatest angle to it. A node whose angle to the centre is above
    that angle and the threshold's together links with no member (triangle inequality), so only
    the others are compared.
    """

    def __init__(self, table: pa.Table, threshold: float) -> None:
        table = table.sort_by([("block", "ascending"), ("id", "ascending")]).combine_chunks()
        self.ids, self.sizes, block = (table.column(c).to_numpy() for c in ("id", "size", "block"))
        self.v, self.threshold = _matrix(table.column("vec").combine_chunks(), np.float64), threshold
        self.starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        unit = self.v / np.sqrt((self.v * self.v).sum(axis=1, keepdims=True))
        centre = np.add.reduceat(unit, self.starts, axis=0)
        norm = np.sqrt((centre * centre).sum(axis=1, keepdims=True))
        self.centre = centre / np.where(norm > 0, norm, 1)
        own = np.repeat(np.arange(len(self.starts)), np.diff([*self.starts, len(unit)]))
        least = np.minimum.reduceat((unit * self.centre[own]).sum(axis=1), self.starts)
        reach = np.arccos(np.clip(least, -1, 1)) + np.arccos(np.clip(threshold, -1, 1)) + ANGLE
        self.limit = np.where((reach < np.pi) & (norm[:, 0] > 0), np.cos(np.minimum(reach, np.pi)), -2)

    def met(self, batches: Iterator[pa.RecordBatch], edges: bool) -> Iterator[pa.RecordBatch]:
        """(id, other, n) of nodes (id, size, vec, open): where `other` is null, the weight of a
        member's links with the nodes or of an open node's links with the members; else edges
        that join what links join, a row a node and a row a member at most."""
        ends, n, label = [*self.starts[1:], len(self.ids)], np.zeros(len(self.ids), np.int64), np.arange(len(self.ids))
        unit = self.v / np.sqrt((self.v * self.v).sum(axis=1, keepdims=True))
        for batch in (b.slice(at, COMPARED) for b in batches for at in range(0, b.num_rows, COMPARED)):
            ids, size, open_ = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "size", "open"))
            v = _matrix(batch.column("vec"), np.float64)
            width = max(v.shape[1], unit.shape[1])
            v, all_v, members, centre = (_wide(x, width) for x in (v, self.v, unit, self.centre))
            u = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
            near = u @ centre.T >= self.limit
            own, first = np.zeros(len(ids), np.int64), np.full(len(ids), -1)
            for k in np.flatnonzero(near.any(axis=0)):
                at, part = np.flatnonzero(near[:, k]), slice(self.starts[k], ends[k])
                cosine = u[at] @ members[part].T
                link = cosine >= self.threshold
                # Rounding decides nothing: these are compared as `exact_links` does.
                r, c = np.nonzero(np.abs(cosine - self.threshold) < 1e-9)
                link[r, c] = _cosine(v[at[r]], all_v[part][c]) >= self.threshold
                link &= ids[at][:, None] != self.ids[part][None, :]
                if not link.any():
                    continue
                n[part] += size[at] @ link
                own[at] += link @ self.sizes[part]
                if edges:
                    some = link.any(axis=1)
                    which = link.argmax(axis=1)[some] + self.starts[k]
                    known = first[at[some]]
                    label = _merged(label, known[known >= 0], which[known >= 0])
                    first[at[some]] = np.where(known >= 0, known, which)
                    if (label[part] != label[part][0]).any():
                        a, b = np.nonzero(np.triu(link.T.astype(np.float32) @ link.astype(np.float32), 1))
                        label = _merged(label, a + self.starts[k], b + self.starts[k])
            linked, counted = first >= 0, open_ & (own > 0)
            yield _met(ids[linked], self.ids[first[linked]], None)
            yield _met(ids[counted], None, own[counted])
        yield _met(self.ids[n > 0], None, n[n > 0])
        moved = label != np.arange(len(label))
        yield _met(self.ids[moved] if edges else self.ids[:0], self.ids[label[moved]] if edges else self.ids[:0], None)


def _met(ids: np.ndarray, other: np.ndarray | None, n: np.ndarray | None) -> pa.RecordBatch:
    columns = [pa.nulls(len(ids), pa.int64()) if c is None else pa.array(c, pa.int64()) for c in (ids, other, n)]
    return pa.RecordBatch.from_arrays(columns, names=["id", "other", "n"])


def compared(members: DataFrame, nodes: DataFrame, threshold: float, edges: bool = True) -> DataFrame:
    """What `Blocks.met` finds of members (root, id, size, vec, q) among all nodes (id, size, vec,
    open). So many blocks as fit in PIECE_BYTES are sent to the tasks at a time; nodes stay where
    they lie, so a crowd crowds no task."""
    blocks = blocked(members)
    held = blocks.agg(F.coalesce(F.sum(F.length("vec") + 16), F.lit(0))).first()[0]
    pieces = -(-held // PIECE_BYTES)
    nodes = staged(nodes.select("id", "size", "vec", "open"), "compared_nodes")
    parts: list[DataFrame] = []
    for piece in range(pieces):
        table = blocks.where(F.pmod(F.xxhash64("block"), F.lit(pieces)) == piece).toArrow()
        if table.num_rows:
            some = Blocks(table, threshold)
            parts.append(staged(nodes.mapInArrow(lambda b, some=some: some.met(b, edges), MET), "met"))
        if len(parts) == 16:
            parts = [staged(reduce(DataFrame.unionAll, parts), "met")]
    return reduce(DataFrame.unionAll, parts) if parts else nodes.sparkSession.createDataFrame([], MET)


def saturated(lists: DataFrame, threshold: float, below: float) -> DataFrame:
    """(id) of nodes whose every listed node may be a link: there may be more."""
    degree = lists.where(F.col("sim") >= threshold - below).groupBy("id").agg(F.count("*").alias("n"))
    return staged(degree.where(F.col("n") >= LIST).select("id"), "saturated")


def near_vectors(vectors: DataFrame, threshold: float = 0.9, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing;
    of different lengths, the shorter counts as filled up with zeros. Rows of one vec_id are
    told apart by their vectors, copies among them link. Other columns are left out.
    """
    rows, nodes = nodes_of(vectors)
    below = slack(nodes, threshold)
    lists = descend(nodes, threshold, rounds, seed=1)
    links = exact_links(lists, nodes, threshold, below)
    extra = 0
    while (recall := audit(links, nodes, threshold, full := saturated(lists, threshold, below), extra)) < RECALL:
        if extra == EXTRA_ROUNDS:
            raise RuntimeError(f"recall of links is {recall:.4f} after {extra} added rounds, below {RECALL}")
        anew = first_lists(nodes, seed=2 + extra).withColumn("old", F.lit(0))
        extra += 1
        before = lists.select("id", "other", "sim", F.lit(1).alias("old"))
        lists = staged(_kept(before.unionByName(anew)), "lists")
        lists = descend(nodes, threshold, 1, rounds + extra, lists)
        links = staged(links.unionByName(exact_links(lists, nodes, threshold, below)).distinct(), "links")
    groups = connected(links).select(F.col("node").alias("id"), "root")
    members = full.join(nodes, "id").join(groups, "id", "left").withColumn("root", F.coalesce("root", "id"))
    opened = nodes.join(full.withColumn("full", F.lit(True)), "id", "left").withColumn("open", F.isnull("full"))
    found = staged(compared(members, opened, threshold), "found")
    roots = connected(links.unionAll(found.where("other is not null").select("id", "other")))
    # Links with a saturated node were counted exactly, on both sides; the others are in lists.
    both = links.unionAll(links.select("b", "a")).toDF("id", "other")
    direct = both.join(full, "id", "left_anti").join(full.select(F.col("id").alias("other")), "other", "left_anti")
    direct = direct.join(nodes.select(F.col("id").alias("other"), "size"), "other").select("id", F.col("size").alias("n"))
    counts = found.where("other is null").select("id", "n").unionByName(direct).groupBy("id").agg(F.sum("n").alias("n"))
    named = nodes.select("id", "vec", "low", "size").join(roots.select(F.col("node").alias("id"), "root"), "id", "left")
    named = named.withColumn("root", F.coalesce("root", "id")).join(counts, "id", "left")
    least = named.groupBy("root").agg(F.min("low").alias("component_id"))
    result = staged(
        named.join(least, "root").select("vec", "component_id", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links")),
        "classes",
    )
    return rows.join(result, "vec", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


#: Links and components of (vec_id, embedding), all pairs compared: for small tables only.
SQL = """
WITH RECURSIVE given AS (
  SELECT row_number() OVER () AS k, vec_id, embedding::DOUBLE[] AS e FROM embeddings
), usable AS MATERIALIZED (
  SELECT k, vec_id, list_resize(e, (SELECT max(len(embedding)) FROM embeddings), 0::DOUBLE) AS e FROM given
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), link AS MATERIALIZED (
  SELECT a.k AS a, b.k AS b, b.vec_id AS id FROM usable a JOIN usable b ON a.k <> b.k
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT k, vec_id AS low FROM usable
  UNION SELECT link.b, reach.low FROM reach JOIN link ON link.a = reach.k AND reach.low < link.id
), lowest AS (SELECT k, min(low) AS low FROM reach GROUP BY k),
counted AS (SELECT a AS k, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(low, vec_id) AS component_id,
  vec_id IS NOT DISTINCT FROM coalesce(low, vec_id) AS kept
FROM given LEFT JOIN lowest USING (k) LEFT JOIN counted USING (k)
"""
