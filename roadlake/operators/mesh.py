"""Meshes as two tables, vertices (vertex numbers from 0 in each mesh) and triangles (a, b, c), joined into one mesh for each map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Mesh ids in one block of a prefix sum.
BLOCK = 10_000


def prefix_sum(meshes: DataFrame, value: str, out: str) -> DataFrame:
    """Sum of value over the meshes (map_id, mesh_id long) of a map with smaller ids.

    Two levels: sums within blocks of ids, and sums over the blocks' totals, so a map with most of the meshes is many tasks.
    """
    blocked = meshes.withColumn("block", F.floor(F.col("mesh_id") / BLOCK))
    before = lambda *keys: W.partitionBy(*keys).rowsBetween(W.unboundedPreceding, -1)
    totals = blocked.groupBy("map_id", "block").agg(F.sum(value).alias("total"))
    starts = totals.select("map_id", "block", F.coalesce(F.sum("total").over(before("map_id").orderBy("block")), F.lit(0)).alias("start"))
    within = blocked.withColumn("within", F.coalesce(F.sum(value).over(before("map_id", "block").orderBy("mesh_id")), F.lit(0)))
    return within.join(starts, ["map_id", "block"]).withColumn(out, F.col("start") + F.col("within")).drop("block", "start", "within")


def mesh_offsets(vertices: DataFrame, triangles: DataFrame, link: int = 0) -> DataFrame:
    """For each mesh its first vertex (v0), its first triangle (t0) and the triangles of the strip before it (n_strip) in the joined mesh.

    Counts are summed in the map tasks, so a mesh with most of the vertices is one row here.
    """
    keys = ["map_id", "mesh_id"]
    own = vertices.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_v"))
    own = own.join(triangles.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_t")), keys, "left").fillna(0, ["n_t"])
    at = prefix_sum(own, "n_v", "v0")
    linked = (F.col("v0") >= link) & (F.col("n_v") >= link) & (F.col("v0") > 0)
    at = at.withColumn("n_strip", F.when(linked, F.lit(max(0, 2 * (link - 1)))).otherwise(0)).withColumn("n_all", F.col("n_t") + F.col("n_strip"))
    return prefix_sum(at, "n_all", "t0").drop("n_all")


def concat_meshes(vertices: DataFrame, triangles: DataFrame, link: int = 0) -> tuple[DataFrame, DataFrame]:
    """Join the meshes of each map in the order of their ids: vertices (map_id, vertex, other columns), triangles (map_id, tri, a, b, c).

    With link > 1 a strip ties the last link vertices so far to the first link vertices of the next mesh; its triangles come before that mesh's own.
    No strip where either side has fewer vertices than link. Triangles of a mesh without vertices are left out. Rows with a null mesh id take no part.
    """
    keys = ["map_id", "mesh_id"]
    offsets = mesh_offsets(vertices, triangles, link)
    rest = [c for c in vertices.columns if c not in (*keys, "vertex")]
    points = vertices.join(offsets.select(*keys, "v0"), keys).select("map_id", (F.col("v0") + F.col("vertex")).alias("vertex"), *rest)
    met = triangles.join(offsets.select(*keys, "v0", "t0", "n_strip"), keys)
    own = met.select("map_id", (F.col("t0") + F.col("n_strip") + F.col("tri")).alias("tri"), *[(F.col("v0") + F.col(c)).alias(c) for c in "abc"])
    if link < 2:
        return points, own
    pair = offsets.filter("n_strip > 0").select("map_id", "t0", "v0", (F.col("v0") - link).alias("u0"), F.explode(F.sequence(F.lit(0), F.lit(link - 2))).alias("i"))
    u, v = F.col("u0") + F.col("i"), F.col("v0") + F.col("i")
    sides = F.array(F.struct(u.alias("a"), (u + 1).alias("b"), v.alias("c")), F.struct((u + 1).alias("a"), (v + 1).alias("b"), v.alias("c")))
    strip = pair.select("map_id", "t0", "i", F.posexplode(sides).alias("half", "t")).select("map_id", (F.col("t0") + 2 * F.col("i") + F.col("half")).alias("tri"), "t.*")
    return points, own.unionByName(strip)


def mesh_validity(meshes: DataFrame, vertices: DataFrame, indices: DataFrame, materials: DataFrame) -> DataFrame:
    """meshes (map_id, mesh_id) with valid: one vertex at least, a number of index rows that three divides, and the last material (by seq) closed (index_end not 0)."""
    keys = ["map_id", "mesh_id"]
    n_v = vertices.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_v"))
    n_i = indices.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_i"))
    last = materials.groupBy(*keys).agg(F.max(F.struct("seq", "index_end"))["index_end"].alias("end"))
    at = meshes.join(n_v, keys, "left").join(n_i, keys, "left").join(last, keys, "left")
    return at.select(*keys, ((F.coalesce("n_v", F.lit(0)) > 0) & (F.coalesce("n_i", F.lit(0)) % 3 == 0) & (F.coalesce("end", F.lit(1)) != 0)).alias("valid"))
