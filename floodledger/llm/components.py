"""Connected components of an edge table in logarithmically many rounds.

Rounds of large and small stars: every vertex hands its neighbours the smallest vertex it knows.
The smallest neighbour is an aggregate with partial sums, so a vertex of any degree is no hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodledger.llm.store import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` holds (u, v) with u > v. Large: every u sees all its neighbours, small: lower ones."""
    seen = edges
    if large:
        seen = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = seen.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    out = seen.join(least, "u")
    if large:
        out = out.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # a lower neighbour and the vertex itself both point to the smallest
        out = out.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        out = out.select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every vertex of ``edges(u, v)`` but the roots; the root is the smallest.

    Loops and repeated edges change nothing; no edges give an empty table.
    """
    edges = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    while True:
        edges = cut(_star(_star(edges, True), False), "stars")
        row = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.count_distinct("u")
        ).first()
        if row[0] == 0 or tuple(row) == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(row)
