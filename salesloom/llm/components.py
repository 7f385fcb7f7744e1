"""Connected components of a large graph, by alternating star contractions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom import scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie each node's larger neighbours to the smallest node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return (
        both.join(least, "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a > b").union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; a component is its smallest node.

    Direction, repeated edges, loops and edges with a null end do not matter; a node that has only
    loops is not in the result. Each round is a table in the shared folder, so lineage stays short,
    and only one row of figures per round reaches the driver. Minima are combined before the
    shuffle and the joins carry the edges on the long side, which Spark splits at a node with many.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    current = scratch.materialize(
        edges.select("a", "b").dropna().select(a.alias("a"), b.alias("b")).where("a > b").distinct(),
        "edges",
    )
    before = None
    for _ in range(rounds):
        figures = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if figures == before or figures[0] == 0:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = figures
        current = scratch.materialize(_small_star(_large_star(current)), "edges")
    raise RuntimeError(f"components did not settle in {rounds} rounds")
