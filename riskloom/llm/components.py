"""Connected components by contraction, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the undirected edges (a, b); roots are the same within a component.

    Each round, every node merges into the smallest of itself and its neighbours by a hash that changes with the
    round, and the edges are redrawn between the merged nodes. Whatever the nodes are called, a share
    of them vanishes in each round, so the number of rounds is logarithmic, on paths too. Links
    stay distributed; each round is written to the shared folder.
    """

    def smallest(edges: DataFrame, turn: int) -> DataFrame:
        of = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("node"))
        return edges.groupBy(F.col("a").alias("node")).agg(F.least(of("node"), F.min(of("b")))["node"].alias("root"))

    turn = 0
    both = edges.select("a", "b").filter("a <> b")
    both = materialize(both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    nodes = materialize(smallest(both, turn), "roots")
    step = nodes
    while True:
        m1, m2 = (step.select(F.col("node").alias(c), F.col("root").alias(f"{c}2")) for c in "ab")
        both = both.join(m1, "a").join(m2, "b").select(F.col("a2").alias("a"), F.col("b2").alias("b")).filter("a <> b").distinct()
        both = materialize(both, "edges")
        if both.isEmpty():
            return nodes
        turn += 1
        step = materialize(smallest(both, turn), "step")
        nxt = step.select(F.col("node").alias("root"), F.col("root").alias("root2"))
        nodes = materialize(nodes.join(nxt, "root", "left").select("node", F.coalesce("root2", "root").alias("root")), "roots")
