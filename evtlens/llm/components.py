"""Connected components of a link table, by alternating large and small stars.

Labels only ever move through joins and partially combined aggregations, so a vertex
with very many links is split like any other skewed join key. Each round is written to
the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _both(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour is linked to the least of the neighbourhood."""
    both = _both(links)
    least = both.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    return (both.where("v > u").join(least, F.col("u") == F.col("c"))
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u <> v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour, and the vertex, is linked to the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    moved = down.join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select(F.col("c").alias("u"), F.col("m").alias("v"))
    return moved.union(own).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """links: u, v (any ordered type, not null). Gives vertex, root (the least vertex of
    its component) for every linked vertex that isn't its own root."""
    links = written(links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = None
    while True:
        state = links.agg(F.count(F.lit(1)).alias("n"),
                          F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (state["n"], state["h"]) == mark:
            return links.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
        mark = (state["n"], state["h"])
        if not state["n"]:
            return links.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
        links = written(_small_star(_large_star(links)), "links")
