"""Connected components of a large graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import stored


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.crc32(F.concat_ws(" ", "a", "b")))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the node's least neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below are tied to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    lower = down.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return lower.union(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of the undirected edges ``(a, b)``.

    The root is the least node of the component; it has no row of its own.
    Self loops and rows with a null are ignored, repeated edges do no harm.
    Each round's edges go to the shared folder. Rounds grow with the logarithm
    of the nodes; a node's least neighbour is found by a partial aggregate, so
    a hub costs its rows once and no list of neighbours is ever built.
    """
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = _signature(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges)), "edges")
        after = _signature(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
