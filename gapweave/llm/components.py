"""Connected components by alternating large and small stars, as Spark aggregations and joins.

A hub's neighbours are reduced to their minimum by partial aggregation and reached again by a
join, whose large partitions Spark splits; nothing of the graph comes to the driver but its counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.shared import written


def large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked with the smallest of its neighbourhood, or with it; u > v in all edges."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "v")
    return edges.join(least, "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and itself, are linked with the smallest; u > v in all edges."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).unionAll(rest).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes but the smallest of each component; ``links`` has longs u, v.

    The links are written before the first step, whose plan would hold what makes them several times over.
    """
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges, seen = written(edges.distinct(), "edges"), None
    while True:
        edges = written(small_star(large_star(edges)), "star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(F.xxhash64("u", "v"), 20))).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = now
