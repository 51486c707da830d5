"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: every node links its larger (large) or smaller (small) neighbours to the smallest one around it.

    The smallest neighbour comes from an aggregation with partial minima, and goes back by an equality join, so a hub
    with many links is spread by Spark's skew handling and never gathered.
    """
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")) if large else both.groupBy("u").agg(F.min("v").alias("m"))
    joined = both.join(low, "u")
    if large:
        made = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        made = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    return made.filter("u <> v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges (u, v: long) -> node, component: one row per linked node, component being the smallest node reachable.

    Nodes without a link to another node are not listed. Repeated and reversed links and loops are allowed; links with a null end are ignored.
    """
    now = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct())
    mark = None
    for _ in range(max_rounds):
        now = cut(_star(_star(now, True), False))
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = tuple(seen)
    raise RuntimeError(f"links did not settle in {max_rounds} rounds")
