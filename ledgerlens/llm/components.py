"""Connected components of a distributed edge list by alternating large-star and small-star rounds.

Every round is two joins with a partial-aggregated minimum; a hot node is split by the adaptive
skew join, and nothing is collected but two numbers that tell whether the edges still change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored


def _star(sym: DataFrame, small: bool) -> DataFrame:
    """One star round on directed edges (u, v): links neighbours of u to u's least neighbour."""
    least = sym.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = sym.join(least, "u")
    if small:  # only smaller neighbours take part, and u itself follows its least one
        moved = joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
    else:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node on an edge; component is the least reachable node (a long).

    Null ends and loops are dropped; an empty edge list gives an empty table.
    """
    e = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
               .where("u is not null and v is not null and u <> v").distinct(), "cc")
    state = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        e = stored(_star(_star(both, small=False), small=True), "cc")
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == state or not now["n"]:
            break
        state = now
    members = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
