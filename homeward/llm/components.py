"""Connected components of an edge table by alternating star contraction.

Large-star links every larger neighbour of a vertex to its least one,
small-star every smaller one.  Both are an aggregate, combined before its
shuffle and written, and a join with that table: the join is a stage of its
own, so a vertex with very many edges can be split there.  Rounds grow with
the logarithm of the diameter and go on until nothing changes; each is
written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage_table


def connected_components(edges: DataFrame) -> DataFrame:
    """(vertex, root) of all vertices of ``edges`` (a, b: bigint); the root
    is the least vertex of the component.  Loops are vertices without other
    edges; an empty table has no component."""
    now = stage_table(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before or not state["n"]:
            break
        before = state
        both = now.union(now.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(stage_table(least, "least"), "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = stage_table(large, "stars")
        lowest = stage_table(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(lowest, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage_table(small.union(lowest).distinct(), "edges")
    roots = now.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("vertex"), F.col("b").alias("root")).union(roots)
