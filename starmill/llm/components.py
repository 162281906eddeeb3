"""Connected components of a graph that is larger than any machine.

Large stars and small stars alternate: every node hangs its larger neighbours, then itself
and its smaller ones, below the smallest node it sees. Edges never multiply, a node with
very many neighbours is only ever reduced to its minimum, and the rounds grow with the
logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.sources.stage import stage


# Edges per partition of a table between rounds.
_PART_EDGES = 200_000


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for the nodes of edges (a, b) that are not the smallest of their component:
    root is that smallest node.

    Loops and repeated edges are fine; edges with a null end are left out.
    """
    u, v = F.greatest("a", "b"), F.least("a", "b")
    current, n = stage(
        edges.filter(F.col("a") != F.col("b")).select(u.alias("u"), v.alias("v")).distinct(), name)
    before = (n, None)
    while before[0]:
        parts = max(8, before[0] // _PART_EDGES)
        # Every node is hung below the smallest node that its smaller neighbour sees. A
        # neighbour with very many nodes above it sees few or none below.
        least = current.groupBy("u").agg(F.min("v").alias("m"))
        # The key is computed, so both sides are exchanged and adaptive execution can cut
        # the edges of such a neighbour.
        least = least.select(F.coalesce("u", F.lit(0)).alias("below"), "m")
        large = current.join(least, F.col("v") == F.col("below"), "left").select(
            "u", F.coalesce("m", "v").alias("v"))
        # Nodes now hang below few others each, which meet here.
        large = large.repartition("u").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        current, _ = stage(hung.select("e.u", "e.v").filter("u > v").coalesce(parts), name)
        after = _checksum(current)
        if after == before:
            break
        before = after
    return current.distinct().select(F.col("u").alias("node"), F.col("v").alias("root"))
