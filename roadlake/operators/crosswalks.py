"""Crosswalk outlines: corners in the world frame, rings that close at a repeated corner, and their fans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from roadlake.functions.scalar import Rot, Vec, transform_point
from roadlake.operators.reference_line import lane_transforms

OBJECT = ["map_id", "road_id", "object_id"]
RING = [*OBJECT, "ring"]
#: Corners are moved outwards by so many metres along the crosswalk, so that it meets the sidewalk.
WIDER = 1.0


def crosswalk_rings(crosswalks: DataFrame) -> DataFrame:
    """Rings of crosswalks (OBJECT, corners array<struct<u, v, z>>, ...): the other columns, ring (from 0), first and last (places of its corners in the array).

    A ring begins at the first corner, or after the ring before it, and ends at the next corner equal to its own first one, which is not part of it. Corners that no
    equal one follows make no ring, and rings of fewer than three corners none either; both are left out but numbered on. Rings never pass from one object to the next.
    A null array or corner gives no ring; corners after a null one still count, and a null number within a corner is equal to another null.
    """
    at = F.sequence(F.lit(0), F.size("known") - 1)
    empty = F.array().cast("array<struct<first: int, last: int>>")
    state = F.struct(F.lit(0).alias("start"), empty.alias("rings"))

    def step(s, i):
        own, here = F.get("known", s["start"]), F.get("known", i)
        closes = (i > s["start"]) & own.eqNullSafe(here)
        return F.struct(F.when(closes, i + 1).otherwise(s["start"]).alias("start"), F.when(closes, F.concat(s["rings"], F.array(F.struct(s["start"].alias("first"), (i - 1).alias("last"))))).otherwise(s["rings"]).alias("rings"))

    # From an array, and outer: else the optimizer takes all of this into filters, with the corners made anew at each step.
    known = crosswalks.withColumn("known", F.explode(F.array(F.filter("corners", lambda c: c.isNotNull())))).filter(F.size("known") > 0)
    rings = F.aggregate(at, state, step)["rings"]
    out = known.withColumn("rings", rings).select(*[c for c in known.columns if c != "corners"], F.posexplode_outer("rings").alias("ring", "r"))
    out = out.withColumns({"first": F.col("r.first"), "last": F.col("r.last")}).filter("last - first >= 2").drop("r")
    return out.withColumnRenamed("known", "corners")


def crosswalk_corners(crosswalks: DataFrame, widths: DataFrame, geometry: DataFrame, offsets: DataFrame | None = None, elevation: DataFrame | None = None) -> DataFrame:
    """Corners of every ring in the world (y southwards): RING, vertex (from 0), x, y, z.

    crosswalks: OBJECT, s, t, hdg, corners. The pivot is the reference line's place at s, moved by t across the crosswalk's heading; the corners' u runs along that heading, v across it, and
    u is widened away from 0. A crosswalk of a road without geometry, or with a null s, gives none; null t, hdg or corner numbers count as 0.
    """
    rings = crosswalk_rings(crosswalks.select(*OBJECT, "s", "t", "hdg", "corners"))
    zero = F.lit(0.0)
    asked = rings.select(*RING, F.col("s").cast("double").alias("s"), F.coalesce("t", zero).alias("across"), F.coalesce("hdg", zero).alias("turn"), F.slice("corners", F.col("first") + 1, F.col("last") - F.col("first") + 1).alias("corners"))
    # One place for each object, as the middle line's transform is the same for its rings; not from the rings, which would be found twice.
    places = crosswalks.select(*OBJECT, F.col("s").cast("double").alias("s")).distinct().withColumns({"section_id": F.lit(0), "lane_id": F.lit(0)})
    level = elevation if elevation is not None else geometry.limit(0).select("map_id", "road_id", "s0", F.col("s0").alias("s1"), *[zero.alias(c) for c in "abcd"])
    base = lane_transforms(places, widths, geometry, offsets, level, few=True).select(*[F.col(c).alias(f"at_{c}") for c in (*OBJECT, "s")], "x", "y", "z", "yaw", "pitch")
    same = [F.col(c).eqNullSafe(F.col(f"at_{c}")) if c == "object_id" else F.col(c) == F.col(f"at_{c}") for c in (*OBJECT, "s")]
    met = asked.join(base, same).select(*RING, "across", "turn", "corners", "x", "y", "z", "yaw", "pitch")
    heading = F.col("yaw") - F.degrees("turn")
    pivot = transform_point(Vec(F.col("across"), zero, zero), Vec(F.col("x"), F.col("y"), F.col("z")), Rot(F.col("pitch"), heading - 90.0, zero))
    turned = met.withColumns({"px": pivot.x, "py": pivot.y, "pz": pivot.z, "yaw": heading})
    each = turned.select(*RING, "px", "py", "pz", "yaw", "pitch", F.posexplode("corners").alias("vertex", "c"))
    u, v, z = (F.coalesce(F.col(f"c.{n}").cast("double"), zero) for n in "uvz")
    out = transform_point(Vec(F.when(u < 0, u - WIDER).otherwise(u + WIDER), v, z), Vec(F.col("px"), F.col("py"), F.col("pz")), Rot(F.col("pitch"), F.col("yaw"), zero))
    return each.select(*RING, "vertex", out.x.alias("x"), out.y.alias("y"), out.z.alias("z"))


def fan_triangles(corners: DataFrame, keys: list[str]) -> DataFrame:
    """Triangles of a fan around vertex 0 of each group: keys, tri, a, b, c. corners: keys, vertex from 0. Fewer than three vertices give none."""
    last = corners.groupBy(*keys).agg(F.max("vertex").alias("last")).filter("last >= 2")
    tri = last.withColumn("tri", F.explode(F.sequence(F.lit(0), F.col("last") - 2)))
    return tri.select(*keys, "tri", F.lit(0).alias("a"), (F.col("tri") + 1).alias("b"), (F.col("tri") + 2).alias("c"))


def fans(corners: DataFrame, keys: list[str]) -> DataFrame:
    """fan_triangles with the places of their corners (ax, ay, bx, by, cx, cy). corners: keys, vertex from 0 without gaps, x, y.

    A corner knows the first and the next one of its group, so the corners are made and read once.
    """
    along = W.partitionBy(*keys).orderBy("vertex")
    met = corners.select(*keys, "vertex", *[F.col(c).alias(f"b{c}") for c in "xy"], *[F.first(c).over(along).alias(f"a{c}") for c in "xy"], *[F.lead(c).over(along).alias(f"c{c}") for c in "xy"], F.lead("vertex").over(along).alias("c"))
    return met.filter("vertex > 0 AND c IS NOT NULL").select(*keys, (F.col("vertex") - 1).alias("tri"), F.lit(0).alias("a"), F.col("vertex").alias("b"), "c", "ax", "ay", "bx", "by", "cx", "cy")
