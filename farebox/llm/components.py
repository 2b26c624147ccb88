"""Connected components of a link table by large-star and small-star rounds over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.sources.scratch import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b); root is the smallest node reachable.

    Both stars turn the links into fewer, shorter ones without losing connectivity (Kiveris et
    al.), and the rounds end when nothing changes, after about log(longest path) of them. Minima
    combine map-side, so a hub with very many links costs one partial row per task, and the joins
    back are plain equi-joins of written tables, whose large keys AQE splits. Every round is
    checkpointed; only two numbers per round reach the driver. No links: no rows. Nulls and self-links are dropped.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    edges, state = cut_lineage(edges), None
    while True:
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == state or now[0] == 0:
            break
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut_lineage(large)
        lower = cut_lineage(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(lower, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(small.unionByName(lower.select("u", F.col("m").alias("v"))).distinct())
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
