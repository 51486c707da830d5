"""Linear referencing: from (road, lane, s) to coordinates. x, y are those of the source document (y northwards)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from roadlake.operators.asof import as_of, lane_width_at


def line_position(x: Column, y: Column, heading: Column, ds: Column) -> tuple[Column, Column]:
    return x + ds * F.cos(heading), y + ds * F.sin(heading)


def arc_position(x: Column, y: Column, heading: Column, curvature: Column, ds: Column) -> tuple[Column, Column, Column]:
    """(x, y, heading) after ds along an arc; curvature 0 is a line."""
    turned = heading + curvature * ds
    straight = F.abs(curvature) < 1e-15
    return (
        F.when(straight, x + ds * F.cos(heading)).otherwise(x + (F.sin(turned) - F.sin(heading)) / curvature),
        F.when(straight, y + ds * F.sin(heading)).otherwise(y - (F.cos(turned) - F.cos(heading)) / curvature),
        turned,
    )


def shift_left(x: Column, y: Column, heading: Column, t: Column) -> tuple[Column, Column]:
    return x - t * F.sin(heading), y + t * F.cos(heading)


def road_points(points: DataFrame, geometry: DataFrame, elevation: DataFrame | None = None) -> DataFrame:
    """points (map_id, road_id, s, ...) with x, y, hdg of the reference line (lines) and, if given, z and slope."""
    geo = geometry.select("map_id", "road_id", "s0", "s1", F.col("x").alias("gx"), F.col("y").alias("gy"), "hdg")
    at = as_of(points, geo, ["map_id", "road_id"], "inner")
    x, y = line_position(F.col("gx"), F.col("gy"), F.col("hdg"), F.col("s") - F.col("s0"))
    out = at.withColumns({"x": x, "y": y}).drop("gx", "gy", "s0", "s1")
    if elevation is not None:
        up = as_of(out, elevation.select("map_id", "road_id", "s0", "s1", "a", "b", "c", "d"), ["map_id", "road_id"])
        ds = F.col("s") - F.col("s0")
        z = F.col("a") + ds * (F.col("b") + ds * (F.col("c") + ds * F.col("d")))
        out = up.withColumns({"z": z, "slope": F.col("b") + ds * (2.0 * F.col("c") + 3.0 * F.col("d") * ds)}).drop("a", "b", "c", "d", "s0", "s1")
    return out


def lane_offsets(at: DataFrame, widths: DataFrame) -> DataFrame:
    """at: one row for each lane at a place (map_id, road_id, section_id, lane_id, s) -> width and t, the lane centre's offset to the left.

    t is the running sum of the widths from the reference line outwards, less half of the lane's own.
    """
    wide = lane_width_at(at, widths)
    out = W.partitionBy("map_id", "road_id", "section_id", "s", F.signum("lane_id")).orderBy(F.abs("lane_id")).rowsBetween(W.unboundedPreceding, W.currentRow)
    return wide.withColumn("t", F.signum("lane_id") * (F.sum("width").over(out) - F.col("width") / 2.0))


def lane_points(at: DataFrame, widths: DataFrame, geometry: DataFrame) -> DataFrame:
    """Lane centres: x, y, yaw (degrees in the flipped frame, 180 more on left lanes), with the edges' offsets t_right and t_left."""
    placed = road_points(lane_offsets(at, widths), geometry)
    x, y = shift_left(F.col("x"), F.col("y"), F.col("hdg"), F.col("t"))
    yaw = -F.degrees("hdg") + F.when(F.col("lane_id") > 0, 180.0).otherwise(0.0)
    return placed.withColumns({"x": x, "y": y, "yaw": yaw, "t_right": F.col("t") - F.col("width") / 2.0, "t_left": F.col("t") + F.col("width") / 2.0})
