"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (u, v), u > v. Large star: each node's larger neighbours go to its smallest one; small star: its smaller
    neighbours and itself do. The smallest is found by a grouped minimum, summed up before the shuffle."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    rows = both.join(least, both.u == least.w)
    if large:
        out = rows.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    else:
        out = rows.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame, tables: Tables, max_rounds: int = 60) -> DataFrame:
    """(node, root) for each node with a link, root being the smallest node of its component. links: (a, b) of longs."""
    ordered = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = tables.put(ordered)
    state = None
    for _ in range(max_rounds):
        after = tables.put(_star(_star(edges, True), False))
        tables.drop(edges)
        edges = after
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("s")).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
