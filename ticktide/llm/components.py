"""Connected components of a graph given by its edges, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, materialize


def _print(edges: DataFrame) -> tuple:
    """What tells one set of edges from another: number, sum and exclusive or of hashes."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first())


def connected_components(edges: DataFrame, a: str, b: str, most: int | None = None) -> DataFrame:
    """(node, root): the smallest node that each node with an edge can reach.

    Alternating large-star and small-star steps: a number of rounds that grows with the
    logarithm of the graph, each a group-by whose result is written and read back, so a
    lost executor costs one round at most. No node gathers its neighbours in memory: all
    that a step needs of a neighbourhood is its minimum. An empty graph gives no rows. With ``most``
    it stops after so many rounds: nodes of one root are then connected, but a component may have several roots.
    """
    clean = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    current = materialize(clean, "edges")
    seen, done = (_print(current) if most is None else None), 0
    while most is None or done < most:
        done += 1
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: every greater neighbour is joined to the least
        large = both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: a node and its smaller neighbours are joined to the least of them
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least.hint("merge"), "u")
        linked = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        after = materialize(linked.where("u <> v").distinct(), "edges")
        # settled: all edges end in nodes that have no smaller neighbour, and nothing moved
        forget(current)
        current = after
        if most is None:
            before, seen = seen, _print(after)
            if seen == before:
                break
    both = current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")))
    return both.groupBy("node").agg(F.min("root").alias("root"))
