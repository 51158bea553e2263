"""Connected components of an edge table, without collecting any group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import cut

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node with an edge (columns ``a``, ``b``; long), ``root`` the
    smallest node of its component.

    Alternating large-star and small-star steps: each step links nodes to the smallest
    neighbour by one aggregation and one join, never holding a node's neighbours together, so
    hubs are ordinary skewed keys. Every round is written to the shared folder.
    """
    def spread(e: DataFrame) -> DataFrame:
        return e.union(e.select("b", "a")).toDF("u", "v").filter("u != v")

    now = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
              .filter("u != v").distinct(), "edges")
    mark = None
    for _ in range(MAX_ROUNDS):
        both = spread(now.toDF("a", "b"))
        least = both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.col("w")).alias("m"))
        # large star: greater neighbours of u get u's least neighbour
        now = (both.join(least, F.col("u") == F.col("w")).filter("v > u")
               .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct())
        # small star: smaller neighbours of u, and u, get u's least neighbour
        least = now.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        near = now.join(least, F.col("u") == F.col("w"))
        now = cut(near.select("v", "m").union(near.select("u", "m")).toDF("u", "v")
                  .filter("u != v").distinct(), "edges")
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == tuple(seen):
            roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            own = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return roots.union(own)
        mark = tuple(seen)
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
