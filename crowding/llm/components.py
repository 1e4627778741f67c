"""Connected components by alternating large and small stars.

Each round is a few joins and aggregations of the edge table, which is written
to the shared store after it; the rounds needed grow with the logarithm of the
number of nodes. A node with very many edges is pre-aggregated, and its rows
of the join can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import stored


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, stored, and their number and sum, observed as they are written."""
    seen = Observation()
    both = F.xxhash64("u", "v").cast("decimal(38,0)")
    out = stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(both).alias("s")), "edges")
    return out, (seen.get.get("n", 0), seen.get.get("s"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    m = F.least("u", "m")
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), m.alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    # Edges point from the larger end u to the smaller v.
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).unionByName(moved)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node that has a link to another; root is the
    component's smallest node. Links with a null end or equal ends count for
    nothing; no links give no rows."""
    x, y = F.col(a), F.col(b)
    edges = links.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    edges, now = _written(edges)
    before = None
    while now != before and now[0]:
        before = now
        edges, now = _written(_small_star(_large_star(edges)).distinct())
    root = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(root)
