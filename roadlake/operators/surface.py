"""Surface features as rows: lane strips, triangles, lane marks, trees and heights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions.scalar import of_lane_type
from roadlake.operators.linref import lane_points, shift_left

LANE = ["map_id", "road_id", "section_id", "lane_id"]
SECTION = LANE[:3]
#: The last row of a lane is taken so far before its end that the lane's own records are in force.
BEFORE_END = 1e-6


def straight_sections(ends: DataFrame, geometry: DataFrame, elevation: DataFrame) -> DataFrame:
    """ends (map_id, road_id, section_id, s0, s1) with straight: one line of the plan covers the section and the road's heights are linear."""
    lines = geometry.filter("kind = 'line'").select("map_id", "road_id", F.col("s0").alias("g0"), F.col("s1").alias("g1"))
    covered = ends.join(lines, ["map_id", "road_id"]).filter("g0 <= s0 AND s1 <= g1").select(*SECTION).distinct().withColumn("on_line", F.lit(True))
    bent = elevation.groupBy("map_id", "road_id").agg(F.bool_or((F.col("c") != 0) | (F.col("d") != 0)).alias("bent"))
    out = ends.join(covered, SECTION, "left").join(bent, ["map_id", "road_id"], "left")
    return out.withColumn("straight", F.coalesce("on_line", F.lit(False)) & ~F.coalesce("bent", F.lit(False))).drop("on_line", "bent")


def lane_strip(ends: DataFrame, lanes: DataFrame, widths: DataFrame, geometry: DataFrame, step: float, mask: int = 2) -> DataFrame:
    """Pairs of edge points along each lane of the mask: LANE, row, s, right_x, right_y, left_x, left_y.

    Rows at every step from the section's start and one at its end; straight sections (column straight of ends) have these two only.
    """
    n = F.when(F.col("straight"), F.lit(1)).otherwise(F.greatest(F.ceil((F.col("s1") - F.col("s0")) / step), F.lit(1)).cast("int"))
    rows = ends.withColumn("n", n).withColumn("row", F.explode(F.sequence(F.lit(0), F.col("n"))))
    rows = rows.select(*SECTION, "row", F.when(F.col("row") == F.col("n"), F.col("s1") - BEFORE_END).otherwise(F.col("s0") + F.col("row") * step).alias("s"))
    at = lane_points(rows.join(lanes.select(*LANE, "type_mask"), SECTION), widths, geometry).filter(of_lane_type(F.col("type_mask"), mask))
    half = F.col("width") / 2.0
    edges = dict(zip(("right_x", "right_y", "left_x", "left_y"), (*shift_left(F.col("x"), F.col("y"), F.col("hdg"), -half), *shift_left(F.col("x"), F.col("y"), F.col("hdg"), half)), strict=True))
    return at.withColumns(edges).select(*LANE, "row", "s", *edges)


def strip_triangles(strip: DataFrame, keys: list[str] = LANE) -> DataFrame:
    """Triangles of a strip whose row r has the vertices 2r (right) and 2r + 1 (left): keys, tri, a, b, c; every other one turned, so all face up."""
    rows = strip.groupBy(*keys).agg(F.max("row").alias("last"))
    tri = rows.withColumn("tri", F.explode(F.when(F.col("last") > 0, F.sequence(F.lit(0), 2 * F.col("last") - 1)).otherwise(F.array().cast("array<int>"))))
    odd = F.col("tri") % 2
    return tri.select(*keys, "tri", F.col("tri").alias("a"), (F.col("tri") + 1 + odd).alias("b"), (F.col("tri") + 2 - odd).alias("c"))


def tessellated(strip: DataFrame, across: int = 4) -> DataFrame:
    """across vertices in each row of a strip, from right to left: keys of the strip, col, x, y."""
    part = F.col("col") / (across - 1)
    out = strip.withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    return out.select(*LANE, "row", "col", *[(F.col(f"right_{a}") + (F.col(f"left_{a}") - F.col(f"right_{a}")) * part).alias(a) for a in "xy"])


def mark_samples(ends: DataFrame, marks: DataFrame, step: float) -> DataFrame:
    """Places that carry paint: marks (LANE, kind) at every step from the section's start; solid ones all over, broken ones three steps on and three off, others none."""
    k = F.sequence(F.lit(0), F.greatest(F.ceil((F.col("s1") - F.col("s0")) / step), F.lit(1)).cast("int") - 1)
    along = ends.select(*SECTION, "s0", F.explode(k).alias("k"))
    painted = (F.col("kind") == "solid") | ((F.col("kind") == "broken") & (F.col("k") % 6 < 3))
    return along.join(marks.select(*LANE, "kind"), SECTION).filter(painted).select(*LANE, "kind", (F.col("s0") + F.col("k") * step).alias("s"))


def tree_places(ends: DataFrame, roads: DataFrame, lanes: DataFrame, widths: DataFrame, geometry: DataFrame, step: float, beside: float, offset: float = 0.0) -> DataFrame:
    """A tree at every step along the outermost right driving lane of each section outside junctions, beside its right edge; no tree where the lane has no width."""
    outer = lanes.filter((F.col("lane_id") < 0) & of_lane_type(F.col("type_mask"), 2)).groupBy(*SECTION).agg(F.min("lane_id").alias("outer"))
    free = ends.join(roads.filter("junction_id = -1").select("map_id", "road_id"), ["map_id", "road_id"], "left_semi")
    n = F.ceil((F.col("s1") - F.col("s0") - offset) / step).cast("int")
    along = free.withColumn("n", n).filter("n > 0").withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select(*SECTION, (F.col("s0") + offset + F.col("k") * step).alias("s"))
    at = along.join(outer, SECTION).join(lanes.select(*LANE), SECTION).filter("lane_id < 0 AND lane_id >= outer")
    placed = lane_points(at, widths, geometry).filter("lane_id = outer AND width <> 0")
    x, y = shift_left(F.col("x"), F.col("y"), F.col("hdg"), -(F.col("width") / 2.0 + beside))
    return placed.select(*LANE, "s", x.alias("x"), y.alias("y"), "yaw", F.lit("urban").alias("speed_class"))


def lane_changes(marks: DataFrame) -> DataFrame:
    """marks (LANE, change: 1 right, 2 left, 3 both, 0 none; lane 0 included) -> allowed: right by the lane's own mark, left by the inner lane's.

    Left lanes run the other way, so their flags trade places; a missing mark allows both. Lane 0 has no row.
    """
    own = marks.filter("lane_id <> 0").withColumn("inner_id", F.col("lane_id") - F.signum("lane_id").cast("int"))
    inner = marks.select(*SECTION, F.col("lane_id").alias("inner_id"), F.col("change").alias("inner"))
    turned = lambda c: F.when(F.col("lane_id") < 0, c).otherwise(F.shiftright(c, 1) + F.shiftleft(c.bitwiseAND(F.lit(1)), 1))
    both = lambda c: turned(F.coalesce(F.col(c), F.lit(3)))
    met = own.join(inner, [*SECTION, "inner_id"], "left")
    return met.select(*LANE, both("change").bitwiseAND(F.lit(1)).bitwiseOR(both("inner").bitwiseAND(F.lit(2))).alias("allowed"))


# Fixed values of the formula for heights: amplitude, phase, factors of x and y of two waves; spacing, reach and height of bumps.
WAVES = ((0.6, 1000.0, 0.035, -0.08), (1.1, -1500.0, 0.02, 0.05))
BUMP_X, BUMP_Y, BUMP_REACH, BUMP_HEIGHT = 17.0, 12.0, 2.0, 0.1


def wave_height(x: Column, y: Column) -> Column:
    total = [a * F.sin(x * kx + y * ky + phase) for a, phase, kx, ky in WAVES]
    return total[0] + total[1]


def bump_height(x: Column, y: Column) -> Column:
    d = F.hypot(F.ceil(x / BUMP_X) * BUMP_X - x, F.floor(y / BUMP_Y) * BUMP_Y - y)
    return F.when(d <= BUMP_REACH, F.sin(d) * BUMP_HEIGHT).otherwise(0.0)


def terrain_triangles(tiles: DataFrame, n: int) -> DataFrame:
    """Two triangles for each cell of an n x n grid of every tile; vertex (i, j) has number i * (n + 1) + j."""
    cells = tiles.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    at = F.col("i") * (n + 1) + F.col("j")
    pair = F.array(F.struct(at.alias("a"), (at + 1).alias("b"), (at + n + 1).alias("c")), F.struct((at + 1).alias("a"), (at + n + 2).alias("b"), (at + n + 1).alias("c")))
    return cells.select("map_id", "tx", "ty", "i", "j", F.posexplode(pair).alias("half", "t")).select("map_id", "tx", "ty", "i", "j", "half", "t.*")
