"""Connected components of a table of links, by alternating star contractions.

Every step is a grouped minimum (partial sums on the map side) and an equi join, so a node with very many
links is no hot task: the minimum is pre-aggregated and adaptive execution may split the join.
Links and labels stay distributed; each round is cut off by a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.sources.staging import materialize


def _star(directed: DataFrame) -> DataFrame:
    """For each row (u, v): v and the least of u and all its v."""
    least = directed.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return directed.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v) that has a link to another; root is the least node reachable.

    Rows with a null end, or of a node with itself, are no links.
    """
    edges = links.where(F.col("u") != F.col("v"))
    edges = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        pairs = _star(large).select(F.explode(F.array("v", "u")).alias("u"), F.col("m").alias("v"))
        edges = materialize(pairs.where("u != v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    ends = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("root")), F.struct(F.col("v").alias("node"), F.col("v").alias("root")))
    return edges.select(F.explode(ends).alias("n")).select("n.*").distinct()
