"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.llm.tables import join_groups, stored


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """`node` and `root`, the smallest node of its component, for every node of an edge.

    Alternates two steps until nothing changes: each node's larger neighbours are tied to the
    smallest node around it, then its smaller ones are. Both keep components whole, and the number
    of rounds grows with the logarithm of their size. A node with many neighbours is not gathered
    in one task: its minimum is taken before edges move, and the join treats it as hot. Loops and
    repeated edges do no harm; edges of a null node are dropped.
    """
    pairs = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u <> v")
    pairs = stored(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        pairs = _tied(both, F.col("v") > F.col("u"))
        pairs = _tied(pairs, F.lit(True))
        mark = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("sum")).first()
        if mark == before:
            break
        before = mark
    inner = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return inner.unionByName(inner.select(F.col("root").alias("node"), "root").distinct())


def _tied(pairs: DataFrame, moved) -> DataFrame:
    """Each edge's other end, where `moved`, tied to the smallest node around u; u itself is tied to it too."""
    around = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    around = stored(around.select("u", F.least("u", "m").alias("m"), "n"), "around")
    ends = join_groups(pairs.filter(moved), around, ["u"], "n", "inner").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = around.select("u", F.col("m").alias("v"))
    return stored(ends.unionByName(own).filter("u <> v").distinct(), "edges")
