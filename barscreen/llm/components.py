"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barscreen.llm.common import staged


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected edges (a, b), both long.

    Each round every node moves to the neighbour, or itself, of the least hash, and the edges
    are renamed; hashes change with the round, so a chain shrinks by a share, not by one. Rounds
    go on until no edge is left: logarithmic in the longest chain. Every round is written to the
    shared folder. Loops and repeated edges do no harm, nodes without an edge are not listed.
    """
    edges = staged(edges.where("a <> b").dropDuplicates(), "edges")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    named = staged(nodes.withColumn("root", F.col("node")), "named")
    turn = 0
    while not edges.isEmpty():
        turn += 1
        both = edges.unionAll(edges.select("b", "a"))
        order = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("v"))
        moved = both.groupBy("a").agg(F.min(F.least(order("b"), order("a"))).alias("m"))
        moved = staged(moved.select(F.col("a").alias("at"), F.col("m.v").alias("to")), "moved")
        named = staged(
            named.join(moved, named.root == moved["at"], "left").select("node", F.coalesce("to", "root").alias("root")),
            "named",
        )
        left = edges.join(moved, edges.a == moved["at"]).select(F.col("to").alias("a"), "b")
        right = left.join(moved, left.b == moved["at"]).select("a", F.col("to").alias("b"))
        edges = staged(right.where("a <> b").dropDuplicates(), "edges")
    return named
