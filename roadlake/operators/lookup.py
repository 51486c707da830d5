"""Waypoints by key, their lane marks, and roads or junctions inside bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.operators.asof import as_of, section_ends, with_ends
from roadlake.operators.linref import lane_points
from roadlake.operators.spatial import cells


def waypoint_by_key(keys: DataFrame, roads: DataFrame, sections: DataFrame, lanes: DataFrame) -> DataFrame:
    """Every distinct key (map_id, road_id, lane_id, s) with its section_id; null where the road is unknown, s is not within [0, length), or no section there has the lane.

    Where sections start at the same s, the first one that has the lane counts.
    """
    names = ["map_id", "road_id", "lane_id", "s"]
    inside = keys.select(*names).distinct()
    ends = section_ends(sections, roads).select("map_id", "road_id", "section_id", "s0", "s1")
    on = as_of(inside.filter("s >= 0"), ends, ["map_id", "road_id"], "inner")
    held = on.join(lanes.select("map_id", "road_id", "section_id", "lane_id"), ["map_id", "road_id", "section_id", "lane_id"])
    found = held.groupBy(*names).agg(F.min("section_id").alias("section_id"))
    same = [F.col(f"k.{c}").eqNullSafe(F.col(f"f.{c}")) for c in names]
    return inside.alias("k").join(found.alias("f"), same, "left").select(*[F.col(f"k.{c}") for c in names], "section_id")


def in_bounds(anchors: DataFrame, boxes: DataFrame, side: float = 500.0) -> DataFrame:
    """Anchors (map_id, x, y, y southwards) strictly inside boxes (map_id, box_id, min_x, min_y, max_x, max_y), whose y falls from min_y to max_y."""
    asked = boxes.withColumn("cell", F.explode(cells(F.col("min_x"), F.col("min_y"), F.col("max_x"), F.col("max_y"), side)))
    own = F.struct(F.floor(F.col("x") / side).cast("long").alias("cx"), F.floor(F.col("y") / side).cast("long").alias("cy"))
    met = anchors.withColumn("cell", own).join(asked, ["map_id", "cell"]).drop("cell")
    return met.filter("min_x < x AND x < max_x AND min_y > y AND y > max_y").drop("min_x", "min_y", "max_x", "max_y")


def road_anchors(roads: DataFrame, sections: DataFrame, lanes: DataFrame, widths: DataFrame, geometry: DataFrame) -> DataFrame:
    """Centre of lane -1 in the middle of each road's first section: map_id, road_id, x, y (southwards). Roads without that lane there have none."""
    ends = section_ends(sections, roads).groupBy("map_id", "road_id").agg(F.min(F.struct("s0", "section_id", "s1")).alias("e"))
    at = ends.select("map_id", "road_id", "e.section_id", F.lit(-1).alias("lane_id"), ((F.col("e.s0") + F.col("e.s1")) / 2).alias("s"))
    has = at.join(lanes.select("map_id", "road_id", "section_id", "lane_id"), ["map_id", "road_id", "section_id", "lane_id"], "left_semi")
    return lane_points(has, widths, geometry).select("map_id", "road_id", "x", (-F.col("y")).alias("y"))


def marks_at(waypoints: DataFrame, marks: DataFrame) -> DataFrame:
    """waypoints (map_id, road_id, section_id, lane_id, s, ...) with the kinds of mark in force: own_mark, and inner_mark of the next lane towards the middle.

    marks: map_id, road_id, section_id, lane_id, s0, kind. Null where no record has begun; both null on lane 0.
    """
    keys = ["map_id", "road_id", "section_id", "lane_id"]
    records = with_ends(marks.select(*keys, "s0", "kind"), keys)
    own = as_of(waypoints, records.withColumnRenamed("kind", "own_mark"), keys).drop("s0", "s1")
    inner = records.withColumnsRenamed({"kind": "inner_mark", "lane_id": "inner_id"})
    at = own.withColumn("inner_id", F.col("lane_id") - F.signum("lane_id").cast("int"))
    both = as_of(at, inner, [*keys[:3], "inner_id"]).drop("s0", "s1", "inner_id")
    off_centre = lambda c: F.when(F.col("lane_id") != 0, F.col(c))
    return both.withColumns({c: off_centre(c) for c in ("own_mark", "inner_mark")})
