"""Queries over joined meshes, thinned marks, waypoints by key and bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.functions.scalar import tidy
from roadlake.operators import lookup, mesh, surface, thinning, tiles
from roadlake.operators.asof import as_of, section_ends
from roadlake.plans.derived import VIEWS, derived
from roadlake.plans.road_queries import ENDS, query

# Marks of all lanes, lane 0 included: a record from the section's start (lane 2 has none there) and one 20 m on.
VIEWS["m_marks"] = (
    ["d_sections"],
    """
SELECT s.map_id, s.road_id, s.section_id, t.lane_id, CAST(s.s0 AS DOUBLE) + k.d AS s0,
       CASE (s.road_id + t.lane_id + CAST(k.d AS INT)) % 3 WHEN 0 THEN 'solid' WHEN 1 THEN 'broken' ELSE 'none' END AS kind
FROM d_sections s CROSS JOIN (VALUES (-3), (-2), (-1), (0), (1), (2), (3)) AS t(lane_id) CROSS JOIN (VALUES (0e0), (2e1)) AS k(d) WHERE NOT (t.lane_id = 2 AND k.d = 0)
""",
)


@query(
    "more n AS (SELECT map_id, road_id, count(*) AS n FROM d_geometry GROUP BY map_id, road_id), "
    "o AS (SELECT *, 2 * (sum(n) OVER w - n) AS v0, 2 * (n - 1) AS n_t FROM n WINDOW w AS (PARTITION BY map_id ORDER BY road_id)), "
    "f AS (SELECT *, CASE WHEN v0 > 0 THEN 2 ELSE 0 END AS n_s FROM o), h AS (SELECT *, sum(n_t + n_s) OVER (PARTITION BY map_id ORDER BY road_id) - n_t - n_s AS t0 FROM f), "
    "tr AS (SELECT map_id, t0 + n_s + k AS tri, v0 + k AS a, v0 + k + 1 + k % 2 AS b, v0 + k + 2 - k % 2 AS c FROM (SELECT *, unnest(range(0, CAST(n_t AS BIGINT))) AS k FROM h) "
    "UNION ALL SELECT map_id, t0, v0 - 2, v0 - 1, v0 FROM h WHERE n_s > 0 UNION ALL SELECT map_id, t0 + 1, v0 - 1, v0 + 1, v0 FROM h WHERE n_s > 0), "
    "ve AS (SELECT g.map_id, v0 + 2 * seq + e.i AS vertex, x + (3 - 6 * e.i) * sin(hdg) AS x, y - (3 - 6 * e.i) * cos(hdg) AS y FROM d_geometry g JOIN h ON h.map_id = g.map_id AND h.road_id = g.road_id CROSS JOIN (VALUES (0), (1)) AS e(i)) "
    "SELECT tr.map_id, CAST(tri AS BIGINT) AS tri, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b, CAST(c AS BIGINT) AS c, round(x, 4) + 0e0 AS x, round(y, 4) + 0e0 AS y FROM tr JOIN ve ON ve.map_id = tr.map_id AND ve.vertex = tr.a",
    "d_geometry",
)
def sf16_joined_strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A strip 6 m wide along each road, joined to one mesh a map with linking strips: every triangle with the place of its first vertex."""
    (geometry,) = derived(spark, sf_dir, "d_geometry")
    sides = geometry.withColumn("i", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("t", 6.0 * F.col("i") - 3.0)
    vertices = sides.select("map_id", F.col("road_id").alias("mesh_id"), (2 * F.col("seq") + F.col("i")).alias("vertex"), (F.col("x") - F.col("t") * F.sin("hdg")).alias("x"), (F.col("y") + F.col("t") * F.cos("hdg")).alias("y"))
    triangles = surface.strip_triangles(geometry.select("map_id", F.col("road_id").alias("mesh_id"), F.col("seq").alias("row")), ["map_id", "mesh_id"])
    points, joined = mesh.concat_meshes(vertices, triangles, link=2)
    met = joined.join(points.withColumnRenamed("vertex", "a"), ["map_id", "a"])
    return met.select("map_id", *[F.col(c).cast("long").alias(c) for c in ("tri", "a", "b", "c")], tidy(F.col("x")).alias("x"), tidy(F.col("y")).alias("y"))


@query()
def sp12_kept_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks of a double centre line, two in each record, thinned in their order. Sequential, so without SQL; held to a loop in tests."""
    (geometry,) = derived(spark, sf_dir, "d_geometry")
    sides = geometry.withColumn("i", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("t", 0.3 * F.col("i") - 0.15)
    middle = F.col("length").cast("double") / 2
    x, y = F.col("x") + middle * F.cos("hdg") - F.col("t") * F.sin("hdg"), F.col("y") + middle * F.sin("hdg") + F.col("t") * F.cos("hdg")
    marks = sides.select("map_id", F.struct("road_id", "seq", "i").alias("mark_id"), x.alias("x"), y.alias("y"), F.lit(0.0).alias("z"))
    return thinning.dedupe_marks(marks, 2.5).select("map_id", "mark_id.road_id", "mark_id.seq", F.col("mark_id.i").alias("side"), tidy(F.col("x")).alias("x"), tidy(F.col("y")).alias("y"))


@query(
    "more e AS (SELECT s.map_id, s.road_id, s.section_id, s.s0, coalesce(lead(s.s0) OVER (PARTITION BY s.map_id, s.road_id ORDER BY s.s0), r.length) AS s1 FROM v_sections s JOIN v_roads r ON r.map_id = s.map_id AND r.road_id = s.road_id), "
    "k AS (SELECT DISTINCT g.map_id + m.d AS map_id, g.road_id, CAST(g.road_id % 9 AS INT) - 4 AS lane_id, CAST(g.s AS DOUBLE) - 5 AS s FROM d_signal_refs g CROSS JOIN (VALUES (0), (8)) AS m(d)) "
    "SELECT k.map_id, k.road_id, k.lane_id, k.s, min(l.section_id) AS section_id FROM k LEFT JOIN e ON e.map_id = k.map_id AND e.road_id = k.road_id AND k.s >= 0 AND k.s >= e.s0 AND k.s < e.s1 "
    "LEFT JOIN v_lanes l ON l.map_id = e.map_id AND l.road_id = e.road_id AND l.section_id = e.section_id AND l.lane_id = k.lane_id GROUP BY ALL",
    "v_sections", "v_roads", "v_lanes", "d_signal_refs", roads=True,
)
def wg6_waypoints_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys 5 m before each signal on two maps that share road ids; some lanes, roads' ends and places do not exist."""
    sections, roads, lanes, refs = derived(spark, sf_dir, "v_sections", "v_roads", "v_lanes", "d_signal_refs")
    keys = refs.withColumn("d", F.explode(F.array(F.lit(0), F.lit(8)))).select((F.col("map_id") + F.col("d")).alias("map_id"), "road_id", ((F.col("road_id") % 9).cast("int") - 4).alias("lane_id"), (F.col("s").cast("double") - 5).alias("s"))
    return lookup.waypoint_by_key(keys, roads, sections, lanes)


def tile_boxes(grid: DataFrame) -> DataFrame:
    x, y = F.col("tx") * 500.0, F.col("ty") * -500.0
    return grid.select("map_id", F.struct("tx", "ty").alias("box_id"), x.alias("min_x"), y.alias("min_y"), (x + 500.0).alias("max_x"), (y - 500.0).alias("max_y"))


INSIDE = "t.map_id = p.map_id AND t.tx * 5e2 < p.x AND p.x < t.tx * 5e2 + 5e2 AND -t.ty * 5e2 > p.y AND p.y > -t.ty * 5e2 - 5e2"


@query(
    f"{ENDS}, f AS (SELECT e.map_id, e.road_id, (e.s0 + e.s1) / 2 AS s FROM ends e JOIN d_lanes l ON l.map_id = e.map_id AND l.road_id = e.road_id AND l.section_id = e.section_id AND l.lane_id = -1 WHERE e.section_id = 0), "
    "p AS (SELECT f.map_id, f.road_id, g.x + (f.s - g.s0) * cos(g.hdg) + (w.a + (f.s - w.s0) * w.b) / 2 * sin(g.hdg) AS x, -(g.y + (f.s - g.s0) * sin(g.hdg) - (w.a + (f.s - w.s0) * w.b) / 2 * cos(g.hdg)) AS y "
    "FROM f JOIN d_geometry g ON g.road_id = f.road_id AND f.s >= g.s0 AND f.s < g.s1 JOIN d_lane_width w ON w.road_id = f.road_id AND w.lane_id = -1 AND f.s >= w.s0 AND f.s < w.s1) "
    f"SELECT p.map_id, p.road_id, t.tx, t.ty FROM p JOIN d_tiles t ON {INSIDE}",
    "d_sections", "d_roads", "d_lanes", "d_lane_width", "d_geometry", "d_tiles",
)
def pf3_roads_in_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    roads, sections, lanes, widths, geometry, grid = derived(spark, sf_dir, "d_roads", "d_sections", "d_lanes", "d_lane_width", "d_geometry", "d_tiles")
    met = lookup.in_bounds(lookup.road_anchors(roads, sections, lanes, widths, geometry), tile_boxes(grid))
    return met.select("map_id", "road_id", "box_id.tx", "box_id.ty")


@query(
    "more p AS (SELECT g.map_id, r.junction_id, (min(g.x) + max(g.x)) / 2 AS x, -(min(g.y) + max(g.y)) / 2 AS y FROM d_geometry g JOIN d_roads r ON r.map_id = g.map_id AND r.road_id = g.road_id WHERE r.junction_id <> -1 GROUP BY g.map_id, r.junction_id) "
    f"SELECT p.map_id, p.junction_id, t.tx, t.ty FROM p JOIN d_tiles t ON {INSIDE}",
    "d_roads", "d_geometry", "d_tiles",
)
def pf4_junctions_in_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    roads, geometry, grid = derived(spark, sf_dir, "d_roads", "d_geometry", "d_tiles")
    points = geometry.join(roads.filter("junction_id <> -1").select("map_id", "road_id", "junction_id"), ["map_id", "road_id"])
    anchors = tiles.bounds(points, ["map_id", "junction_id"]).select("map_id", "junction_id", F.col("cx").alias("x"), (-F.col("cy")).alias("y"))
    return lookup.in_bounds(anchors, tile_boxes(grid)).select("map_id", "junction_id", "box_id.tx", "box_id.ty")


@query(
    f"{ENDS}, w AS (SELECT g.signal_id, g.map_id, g.road_id, e.section_id, t.lane_id, CAST(g.s AS DOUBLE) AS s FROM d_signal_refs g JOIN ends e ON e.map_id = g.map_id AND e.road_id = g.road_id AND g.s >= e.s0 AND g.s < e.s1 CROSS JOIN (VALUES (-2), (-1), (0), (1), (2)) AS t(lane_id)), "
    "m AS (SELECT w.signal_id, w.lane_id, r.lane_id AS at, max_by(r.kind, r.s0) AS kind FROM w JOIN m_marks r ON r.map_id = w.map_id AND r.road_id = w.road_id AND r.section_id = w.section_id AND r.s0 <= w.s AND r.lane_id IN (w.lane_id, w.lane_id - CAST(sign(w.lane_id) AS INT)) GROUP BY ALL) "
    "SELECT w.signal_id, w.lane_id, CASE WHEN w.lane_id <> 0 THEN o.kind END AS own_mark, CASE WHEN w.lane_id <> 0 THEN i.kind END AS inner_mark FROM w LEFT JOIN m o ON o.signal_id = w.signal_id AND o.lane_id = w.lane_id AND o.at = w.lane_id "
    "LEFT JOIN m i ON i.signal_id = w.signal_id AND i.lane_id = w.lane_id AND i.at = w.lane_id - CAST(sign(w.lane_id) AS INT)",
    "d_sections", "d_roads", "d_signal_refs", "m_marks", roads=True,
)
def ao10_marks_at_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks on both sides of the lanes -2 to 2 beside each signal."""
    sections, roads, refs, marks = derived(spark, sf_dir, "d_sections", "d_roads", "d_signal_refs", "m_marks")
    ends = section_ends(sections, roads).select("map_id", "road_id", "section_id", "s0", "s1")
    at = as_of(refs.select("map_id", "road_id", "signal_id", F.col("s").cast("double").alias("s")), ends, ["map_id", "road_id"], "inner").drop("s0", "s1")
    points = at.withColumn("lane_id", F.explode(F.array(*[F.lit(k) for k in range(-2, 3)])))
    return lookup.marks_at(points, marks).select("signal_id", "lane_id", "own_mark", "inner_mark")
