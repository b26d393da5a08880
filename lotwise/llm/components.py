"""Connected components of an edge table by alternating large and small stars.

Each step is a minimum per node (combined before the shuffle) and a join back, so no task gathers a
node's neighbours; steps pass through written tables, which cuts lineage. A star of any size stays
a star, and the number of steps grows with the logarithm of the number of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import dematerialize, materialize

EDGES = "a bigint, b bigint"


def _star(pairs: DataFrame) -> DataFrame:
    """(u, v, least): each u's pairs with the least of u and its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("least"))
    # The hash in the key gives both sides a shuffle of their own, so a hub's pairs can be split.
    same = F.xxhash64("u")
    return pairs.withColumn("same", same).join(least.withColumn("same", same), ["u", "same"]).drop("same")


def _edges(df: DataFrame, u: str, v: str) -> DataFrame:
    return df.where(F.col(u) != F.col(v)).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge (a, b); the root is its component's least node."""
    now = materialize(_edges(edges, "a", "b"), "edges")
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u")
        mid = _edges(large, "v", "least")
        small = _star(mid)
        out = _edges(small.select(F.col("v").alias("x"), "least")
                     .union(small.select("u", "least")), "x", "least")
        new = materialize(out, "edges")
        # Both tables have distinct edges: equally many and none that the other lacks.
        same = new.count() == now.count() and new.join(now, ["u", "v"], "left_anti").isEmpty()
        dematerialize(now)
        now = new
        if same:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots).distinct()
