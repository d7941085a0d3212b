"""Prefix tries of conversations: ternary search trees per range shard, merged at the edges.

A turn is encoded as a fixed-width key, a digest of role and text with the number of words, so a
conversation is a path of keys, and the order of paths as bytes is that of their sequences.
Equal paths are counted together first. The different ones are range-sorted, so that each shard
holds one stretch of the trie; it encodes its keys as small numbers in their order, inserts its
paths into a ternary search tree, the middle one first and so on in each half, which balances the
search for siblings, and goes over the tree without recursion, adding up from the leaves.

A node is in several shards only if it lies on the first or last path of one. Those nodes keep
what the rest of their own shard adds to them, and are merged in the order of shards: the nodes on
the current path are open, a node that the next shard goes on with is added to, one that it
leaves is closed and passes its sums to its parent. That is one row a node of two paths a shard.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from barscreen.llm.common import attach, staged

#: Bytes of a turn's key: of the digest, and of the number of words.
DIGEST, COUNT = 16, 4
KEY = DIGEST + COUNT
#: Turns of different paths a shard should hold.
SHARD_TURNS = 100_000
#: Conversations of one path whose ids go into one piece.
PIECE = 5_000
NONE = hashlib.sha256(b"").hexdigest()
#: What a shard says of a node. Nodes on edges have a `ref` and a `key`; `up` is the ref of the parent
#: of another node, if that is on an edge.
NODES = (
    "ref long, up long, key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, ends_sha256 string"
)
NODE_TYPES = (*[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 7, pa.string())


def turn_key(role: Column, text: Column) -> Column:
    """Hex of a turn's key. Null role and text are empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.concat(F.substring(F.sha2(said, 256), 1, 2 * DIGEST), F.lpad(F.hex(words), 2 * COUNT, "0"))


def paths(conversations: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """(conv_id, path) of every conversation rebuilt on another's beginning.

    Turns of (conv_id, turn, role, text) are ordered by turn, null first; equal turns by the digest
    of role and text, repeated rows stay. With h = crc32 of the id's digits modulo `heads`,
    conversation c becomes the first h turns of conversation c - c % `group` (all if it has fewer,
    none if it is absent) and its own turns after its first h. Rows without conv_id are left out,
    as are other columns. A conversation is a row: its keys, 20 bytes a turn, must fit a task.
    """
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_key(F.col("role"), F.col("text")).alias("key")
    )
    turns = F.sort_array(F.collect_list(F.struct("turn", "key")))
    own = staged(rows.groupBy("conv_id").agg(F.transform(turns, lambda t: t["key"]).alias("keys")), "turns")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    base = F.col("conv_id") - F.col("conv_id") % group
    shared = own.select(F.col("conv_id").alias("base"), F.slice("keys", 1, heads - 1).alias("head")).where(F.col("base") % group == 0)
    joined = own.select("conv_id", "keys", base.alias("base"), h.cast("int").alias("h")).join(shared, "base", "left")
    head = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    tail = F.slice("keys", F.col("h") + 1, F.size("keys"))
    return joined.select("conv_id", F.unhex(F.array_join(F.concat(head, tail), "")).alias("path"))


def classes(found: DataFrame, shards: int) -> DataFrame:
    """(path, n_convs, conv_id, ends_sha256) of every different path: its conversations, the
    smallest, and the digest of all of them in order.

    A path may have a third of all conversations: they are range-sorted by path and id, so many
    tasks share them, and each passes them on as pieces of up to PIECE ids. What then comes to
    one task a path is a row a piece, digested one after the other.
    """
    spread = found.repartitionByRange(shards, "path", "conv_id").sortWithinPartitions("path", "conv_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: bytes | None = None
        ids: list[int] = []

        def piece() -> tuple:
            return key, ids[0], len(ids), ",".join(map(str, ids))

        for batch in batches:
            done = []
            for path, conv in zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if ids and (path != key or len(ids) == PIECE):
                    done.append(piece())
                    ids = []
                key = path
                ids.append(conv)
            if done:
                yield _table(done, ("path", "conv_id", "n", "ids"), (pa.binary(), pa.int64(), pa.int64(), pa.string()))
        if ids:
            yield _table([piece()], ("path", "conv_id", "n", "ids"), (pa.binary(), pa.int64(), pa.int64(), pa.string()))

    pieces = spread.select("path", "conv_id").mapInArrow(cut, "path binary, conv_id long, n long, ids string")
    together = pieces.repartition("path").sortWithinPartitions("path", "conv_id")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("path", "n_convs", "conv_id", "ends_sha256")
        types = (pa.binary(), pa.int64(), pa.int64(), pa.string())
        key: bytes | None = None
        n = least = 0
        sha = hashlib.sha256()
        for batch in batches:
            done = []
            for path, first, size, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if path != key:
                    if key is not None:
                        done.append((key, n, least, sha.hexdigest()))
                    key, n, least, sha = path, 0, first, hashlib.sha256()
                else:
                    sha.update(b",")
                n += size
                sha.update(ids.encode())
            if done:
                yield _table(done, names, types)
        if key is not None:
            yield _table([(key, n, least, sha.hexdigest())], names, types)

    return together.mapInArrow(digest, "path binary, n_convs long, conv_id long, ends_sha256 string")


def _table(rows: list[tuple], names: tuple[str, ...], types: tuple[pa.DataType, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


class TernaryTree:
    """A trie of sequences of small numbers; the children of a node form a binary search tree.

    Node 0 is the root, and as a link it means that there is no node.
    """

    def __init__(self) -> None:
        self.label, self.parent, self.depth = [0], [0], [0]
        self.low, self.equal, self.high = [0], [0], [0]
        self.members, self.least, self.end = [0], [None], [None]

    def _new(self, label: int, parent: int) -> int:
        self.label.append(label)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        for links in (self.low, self.equal, self.high):
            links.append(0)
        self.members.append(0)
        self.least.append(None)
        self.end.append(None)
        return len(self.label) - 1

    def child(self, node: int, label: int, make: bool = False) -> int:
        """The child of a node by its label, made if it is missing and `make` is set, else 0."""
        links, at = self.equal, node
        while child := links[at]:
            if label == self.label[child]:
                return child
            links, at = (self.low if label < self.label[child] else self.high), child
        if make:
            links[at] = child = self._new(label, node)
        return child

    def insert(self, codes: list[int], n: int, least: int, end: object) -> None:
        node = 0
        self._add(node, n, least)
        for code in codes:
            node = self.child(node, code, make=True)
            self._add(node, n, least)
        self.end[node] = end

    def _add(self, node: int, n: int, least: int) -> None:
        self.members[node] += n
        if self.least[node] is None or least < self.least[node]:
            self.least[node] = least

    def along(self, codes: list[int]) -> list[int]:
        """The root and the nodes of a sequence that is in the tree."""
        nodes = [0]
        for code in codes:
            nodes.append(self.child(nodes[-1], code))
        return nodes

    def in_order(self) -> list[int]:
        """All nodes, a node before what is under it, siblings by their labels."""
        out = [0]
        todo = [self.equal[0]]
        while todo:
            node = todo.pop()
            if node < 0:  # its lower siblings are done
                out.append(-node)
                todo.append(self.equal[-node])
            elif node:
                todo += (self.high[node], -node, self.low[node])
        return out


def middles(n: int) -> Iterator[int]:
    """0 to n - 1, the middle first, then the middles of both halves, and so on."""
    todo = deque([(0, n)])
    while todo:
        lo, hi = todo.popleft()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            todo += ((lo, mid), (mid + 1, hi))


def shard_nodes(shard: int, rows: list[tuple[bytes, int, int, str]]) -> Iterator[tuple]:
    """Rows of NODES of one shard's paths, which come in order and differ."""
    cut = [[path[i : i + KEY] for i in range(0, len(path), KEY)] for path, *_ in rows]
    keys = sorted(set().union(*cut))
    code = {key: i for i, key in enumerate(keys)}
    coded = [[code[key] for key in path] for path in cut]
    words = [int.from_bytes(key[DIGEST:], "big") for key in keys]
    tree = TernaryTree()
    for i in middles(len(rows)):
        _, n, least, end = rows[i]
        tree.insert(coded[i], n, least, end)
    edge = {*tree.along(coded[0]), *tree.along(coded[-1])}
    size = len(tree.label)
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    order = tree.in_order()
    for node in reversed(order):
        if node in edge:
            continue
        up = tree.parent[node]
        leaves[node] += not children[node]
        saved[node] += (tree.members[node] - 1) * words[tree.label[node]]
        children[up] += 1
        leaves[up] += leaves[node]
        saved[up] += saved[node]
    refs: dict[int, int] = {}
    for place, node in enumerate(order):
        up = tree.parent[node]
        here = tree.least[node], tree.depth[node]
        sums = tree.members[node], children[node], leaves[node], saved[node]
        if node in edge:  # numbered by place: its parent and itself are told apart in order
            refs[node] = (shard << 32) + place
            yield (refs[node], None, keys[tree.label[node]] if node else b"", *here, None, *sums, tree.end[node])
        else:
            known = None if up in edge else tree.least[up]
            yield (None, refs.get(up), None, *here, known, *sums, tree.end[node] or NONE)


def _shards(found: DataFrame, shards: int) -> DataFrame:
    """Rows of NODES of all shards."""
    dealt = found.repartitionByRange(shards, "path").sortWithinPartitions("path")
    dealt = dealt.select("path", "n_convs", "conv_id", "ends_sha256", F.spark_partition_id().alias("shard"))
    names = tuple(f.name for f in StructType.fromDDL(NODES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        shard = 0
        for batch in batches:
            if batch.num_rows:
                shard = batch.column("shard")[0].as_py()
                rows += zip(*[c.to_pylist() for c in batch.columns[:4]], strict=True)
        if not rows:
            return
        out: list[tuple] = []
        for row in shard_nodes(shard, rows):
            out.append(row)
            if len(out) == 10_000:
                yield _table(out, names, NODE_TYPES)
                out = []
        if out:
            yield _table(out, names, NODE_TYPES)

    return dealt.mapInArrow(run, NODES)


def merged(edges: DataFrame) -> DataFrame:
    """Nodes on edges of shards, each once, and for every row of them the merged conv_id.

    Rows of NODES by `ref`; all but `ref` and `conv_id` are null in repeated rows of a node.
    """
    names = tuple(f.name for f in StructType.fromDDL(NODES))
    ordered = edges.repartition(1).sortWithinPartitions("ref")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[dict] = []
        done: list[tuple] = []

        def close() -> None:
            node = open_.pop()
            children, leaves, saved = node["children"], node["leaves"], node["saved"]
            words = int.from_bytes(node["key"][DIGEST:], "big")
            leaves += not children
            saved += (node["n"] - 1) * words
            up = None
            if open_:
                parent = open_[-1]
                up = parent["refs"][0]
                parent["children"] += 1
                parent["leaves"] += leaves
                parent["saved"] += saved
            first, *others = node["refs"]
            done.append(
                (first, up, node["key"], node["least"], len(open_), None, node["n"], children, leaves, saved, node["end"] or NONE)
            )
            done.extend((ref, None, None, node["least"], *[None] * 7) for ref in others)

        for batch in batches:
            for ref, _, key, least, depth, _, n, children, leaves, saved, end in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if depth < len(open_) and open_[depth]["key"] == key:
                    node = open_[depth]
                    node["refs"].append(ref)
                    node["least"] = min(node["least"], least)
                    node["n"] += n
                    node["children"] += children
                    node["leaves"] += leaves
                    node["saved"] += saved
                    node["end"] = node["end"] or end
                else:
                    while len(open_) > depth:
                        close()
                    open_.append(
                        {"refs": [ref], "key": key, "least": least, "n": n, "children": children, "leaves": leaves, "saved": saved, "end": end}
                    )
            if done:
                yield _table(done, names, NODE_TYPES)
                done = []
        while open_:
            close()
        if done:
            yield _table(done, names, NODE_TYPES)

    return ordered.mapInArrow(run, NODES)


def trie(found: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row a node of the trie of (conv_id, path), conv_id unique and not null.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), all
    but the last long. A conversation without turns ends in the root. No conversations, no nodes.
    """
    found = staged(found.select("conv_id", "path"), "paths")
    turns = F.coalesce(F.sum(F.octet_length("path") / KEY + 1), F.lit(0)).cast("long")
    shards = max(1, -(-found.agg(turns).first()[0] // shard_turns))
    different = staged(classes(found, shards), "classes")
    shards = max(1, -(-different.agg(turns).first()[0] // shard_turns))
    nodes = staged(_shards(different, shards), "nodes")
    edges = staged(merged(nodes.where("ref IS NOT NULL")), "edges")
    names = edges.select(F.col("ref").alias("up"), F.col("conv_id").alias("up_conv"))
    whole = nodes.where("ref IS NULL").unionByName(edges.where("key IS NOT NULL"))
    out = attach(whole, staged(names, "names"), ["up"])
    return out.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "up_conv").alias("parent_conv_id"), "n_convs",
        "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )


#: Comparison SQL: every prefix of every rebuilt conversation. The checksum of an id's digits is
#: worked out bit by bit.
SQL = """
WITH t AS (
  SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')]),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT conv_id, list(said ORDER BY own, pos) AS turns FROM (
    SELECT c.conv_id, false AS own, pos, said FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND pos <= h
    UNION ALL SELECT c.conv_id, true, pos, said FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h
  ) GROUP BY conv_id
), f AS (
  SELECT c.conv_id, coalesce(turns, []) AS turns FROM c LEFT JOIN r USING (conv_id)
), p AS (
  SELECT conv_id, len(turns) AS n, d AS depth, sha256(list_slice(turns, 1, d)::VARCHAR) AS node,
    CASE WHEN d > 0 THEN sha256(list_slice(turns, 1, d - 1)::VARCHAR) END AS up,
    CASE WHEN d > 0 THEN len(regexp_extract_all(turns[d].text, '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS words
  FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM f)
), g AS (
  SELECT node, depth, any_value(up) AS up, any_value(words) AS words, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM p GROUP BY node, depth
), k AS (
  SELECT a.*, b.conv_id AS parent_conv_id,
    (SELECT count(*) FROM g AS x WHERE x.up = a.node AND x.depth = a.depth + 1) AS n_children
  FROM g AS a LEFT JOIN g AS b ON b.node = a.up AND b.depth = a.depth - 1
), q AS (
  SELECT DISTINCT low.node, low.depth, high.node AS top, high.depth AS top_depth
  FROM p AS low JOIN p AS high ON high.conv_id = low.conv_id AND high.depth <= low.depth
), u AS (
  SELECT top AS node, top_depth AS depth, CAST(count(*) FILTER (WHERE n_children = 0) AS BIGINT) AS n_leaves,
    CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens
  FROM q JOIN k USING (node, depth) GROUP BY ALL
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM k JOIN u USING (node, depth)
"""
