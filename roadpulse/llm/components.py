"""Connected components of a distributed edge list by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import cut


def _mark(edges: DataFrame) -> tuple:
    """Tells whether a round changed anything: two numbers, whatever the size."""
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    row = edges.agg(F.count("*").alias("n"), F.sum(hashed).alias("h")).first()
    return row["n"], row["h"]


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v), u > v, hooked to the smallest neighbour. The smallest neighbour is a
    combined aggregate and the look-up is a plain join, so a hub is no single group."""
    if large:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hooked = edges.join(least.withColumn("m", F.least("u", "m")), "u")
    if large:
        out = hooked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hooked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            hooked.select("u", F.col("m").alias("v"))
        )
    return out.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """`node`, `root` (the smallest node reachable) for each node of undirected edges
    (`u`, `v`). Rounds grow with the logarithm of the longest path."""
    edges = cut(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter("u <> v")
        .distinct()
    )
    mark = _mark(edges)
    while mark[0]:
        edges = cut(_star(_star(edges, large=True), large=False))
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
