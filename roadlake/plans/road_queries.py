"""Registered road queries over the derived tables, each with its oracle."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.functions import geo, scalar
from roadlake.functions.scalar import tidy
from roadlake.operators import asof, generate, graph, linref, spatial, tiles
from roadlake.plans.derived import by_road, chain, derived

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *views: str, roads: bool = False, rows: int = 1):
    """Registers a query with its oracle; with roads it is built by_road, for so many rows a record."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with by_road(spark, roads, rows):
                return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            head = chain(*views)
            head = head.replace("WITH ", "WITH RECURSIVE ", 1) if " FROM go " in sql else head
            ORACLES[f.__name__] = (head + (", " if sql.startswith("more ") else " ") + sql.removeprefix("more ")) if views else sql
        return run

    return add


def lane_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One straight centre-line segment for each driving lane and geometry: map_id, road_id, lane_id, seq, s0, length, x0..y1, width."""
    geometry, widths = derived(spark, sf_dir, "d_geometry", "d_lane_width")
    near = widths.filter("abs(lane_id) = 1").select("map_id", "road_id", "lane_id", "s0", F.col("a").alias("width"))
    at = geometry.select("map_id", "road_id", "seq", "s0", "length", "x", "y", "hdg").join(near, ["map_id", "road_id", "s0"])
    t = F.signum("lane_id") * F.col("width") / 2.0
    x0, y0 = linref.shift_left(F.col("x"), F.col("y"), F.col("hdg"), t)
    x1, y1 = linref.line_position(x0, y0, F.col("hdg"), F.col("length"))
    return at.select("map_id", "road_id", "seq", F.col("lane_id").cast("int").alias("lane_id"), "s0", "length", "width", x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))


SEGMENTS = """seg AS (
  SELECT g.map_id, g.road_id, g.seq, w.lane_id, g.s0, g.length, w.a AS width,
         g.x - sign(w.lane_id) * w.a / 2e0 * sin(g.hdg) AS x0, g.y + sign(w.lane_id) * w.a / 2e0 * cos(g.hdg) AS y0,
         g.x - sign(w.lane_id) * w.a / 2e0 * sin(g.hdg) + g.length * cos(g.hdg) AS x1, g.y + sign(w.lane_id) * w.a / 2e0 * cos(g.hdg) + g.length * sin(g.hdg) AS y1
  FROM d_geometry g JOIN d_lane_width w ON w.map_id = g.map_id AND w.road_id = g.road_id AND w.s0 = g.s0 WHERE abs(w.lane_id) = 1)"""

NEAREST = f"""more {SEGMENTS}, p AS (SELECT map_id, event_id, x AS px, y AS py FROM d_pings),
m AS (SELECT p.*, seg.*, greatest(0e0, least(1e0, ((px - x0) * (x1 - x0) + (py - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS t FROM p JOIN seg ON seg.map_id = p.map_id),
d AS (SELECT *, round(sqrt((x0 + t * (x1 - x0) - px) ** 2 + (y0 + t * (y1 - y0) - py) ** 2), 6) AS d2 FROM m),
b AS (SELECT event_id, min(struct_pack(d2 := d2, road_id := road_id, seq := seq, lane_id := lane_id)) AS k FROM d GROUP BY event_id),
n AS (SELECT d.* FROM d JOIN b ON b.event_id = d.event_id AND b.k.d2 = d.d2 AND b.k.road_id = d.road_id AND b.k.seq = d.seq AND b.k.lane_id = d.lane_id)
"""


def closest(spark: SparkSession, sf_dir: str) -> DataFrame:
    (pings,) = derived(spark, sf_dir, "d_pings")
    points = pings.select("map_id", F.col("event_id").alias("point_id"), "x", "y")
    return spatial.nearest_segments(points, lane_segments(spark, sf_dir), ["road_id", "seq", "lane_id"])


@query(NEAREST + "SELECT event_id, road_id, lane_id, round(s0 + t * length, 6) + 0e0 AS s, d2 + 0e0 AS distance FROM n", "d_geometry", "d_lane_width", "d_pings", roads=True)
def sp2_closest_waypoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = closest(spark, sf_dir)
    return near.select(F.col("point_id").alias("event_id"), "road_id", "lane_id", tidy(F.col("s0") + F.col("along"), 6).alias("s"), F.col("d2").alias("distance"))


@query(NEAREST + "SELECT event_id, road_id, lane_id FROM n WHERE d2 < width / 2e0", "d_geometry", "d_lane_width", "d_pings", roads=True)
def sp3_on_road(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closest(spark, sf_dir).filter(F.col("d2") < F.col("width") / 2.0).select(F.col("point_id").alias("event_id"), "road_id", "lane_id")


@query(NEAREST + "SELECT p.event_id, coalesce(round(d2 - width, 6), 1e5) + 0e0 AS border FROM p LEFT JOIN n ON n.event_id = p.event_id", "d_geometry", "d_lane_width", "d_pings", roads=True)
def sp7_border_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point on a map without lanes is 100,000 m from any border."""
    near = closest(spark, sf_dir).select(F.col("point_id").alias("event_id"), tidy(F.col("d2") - F.col("width"), 6).alias("found"))
    (pings,) = derived(spark, sf_dir, "d_pings")
    return pings.select("event_id").join(near, "event_id", "left").select("event_id", F.coalesce("found", F.lit(100_000.0)).alias("border"))


@query(
    f"more {SEGMENTS} SELECT t.map_id, t.tx, t.ty, count(*) AS n, count(DISTINCT seg.road_id) AS n_roads FROM d_tiles t JOIN seg ON seg.map_id = t.map_id AND greatest(x0, x1) >= t.tx * 5e2 AND least(x0, x1) <= t.tx * 5e2 + 5e2 AND greatest(y0, y1) >= t.ty * 5e2 AND least(y0, y1) <= t.ty * 5e2 + 5e2 GROUP BY t.map_id, t.tx, t.ty",
    "d_geometry", "d_lane_width", "d_tiles",
)
def sp6_segments_in_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    (grid,) = derived(spark, sf_dir, "d_tiles")
    side = 500.0
    boxes = grid.withColumns({"bx0": F.col("tx") * side, "by0": F.col("ty") * side, "bx1": F.col("tx") * side + side, "by1": F.col("ty") * side + side})
    return spatial.segments_in_boxes(boxes, lane_segments(spark, sf_dir), side).groupBy("map_id", "tx", "ty").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("road_id").alias("n_roads"))


@query("SELECT g.signal_id, g.s, e.a + (g.s - e.s0) * e.b AS z FROM d_signal_refs g JOIN d_elevation e ON e.map_id = g.map_id AND e.road_id = g.road_id AND g.s >= e.s0 AND g.s < e.s1".replace("e.a + (g.s - e.s0) * e.b", "round(e.a + (g.s - e.s0) * e.b, 4) + 0e0"), "d_signal_refs", "d_elevation")
def ao8_elevation_at_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    signals, elevation = derived(spark, sf_dir, "d_signal_refs", "d_elevation")
    at = asof.as_of(signals.select("map_id", "signal_id", "road_id", "s"), elevation, ["map_id", "road_id"], "inner")
    return at.select("signal_id", "s", tidy(scalar.poly_eval(F.col("a"), F.col("b"), F.col("c"), F.col("d"), F.col("s") - F.col("s0"))).alias("z"))


@query("SELECT s.map_id, s.road_id, s.section_id, s.s0, coalesce(lead(s.s0) OVER (PARTITION BY s.road_id ORDER BY s.s0), r.length) AS s1 FROM d_sections s JOIN d_roads r ON r.road_id = s.road_id", "d_sections", "d_roads")
def ao6_section_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections, roads = derived(spark, sf_dir, "d_sections", "d_roads")
    return asof.section_ends(sections, roads).select("map_id", "road_id", "section_id", "s0", "s1")


ENDS = "more ends AS (SELECT s.map_id, s.road_id, s.section_id, s.s0, coalesce(lead(s.s0) OVER (PARTITION BY s.road_id ORDER BY s.s0), r.length) AS s1, r.length FROM d_sections s JOIN d_roads r ON r.road_id = s.road_id)"


@query(ENDS + " SELECT g.signal_id, e.section_id, count(*) AS n_lanes FROM d_signal_refs g JOIN ends e ON e.road_id = g.road_id AND g.s >= e.s0 AND g.s < e.s1 JOIN d_lanes l ON l.road_id = e.road_id AND l.section_id = e.section_id GROUP BY g.signal_id, e.section_id", "d_sections", "d_roads", "d_lanes", "d_signal_refs")
def ao5_lanes_at_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    signals, sections, roads, lanes = derived(spark, sf_dir, "d_signal_refs", "d_sections", "d_roads", "d_lanes")
    ends = asof.section_ends(sections, roads).select("map_id", "road_id", "section_id", "s0", "s1")
    at = asof.as_of(signals.select("map_id", "signal_id", "road_id", "s"), ends, ["map_id", "road_id"], "inner")
    return at.join(lanes.select("road_id", "section_id", "lane_id"), ["road_id", "section_id"]).groupBy("signal_id", "section_id").agg(F.count(F.lit(1)).alias("n_lanes"))


@query(
    "more r AS (SELECT map_id, road_id, CASE WHEN road_id % 2 = 0 THEN 0e0 ELSE length / 2 END AS lo, CASE WHEN road_id % 2 = 0 THEN length / 2 ELSE 0e0 END AS hi FROM d_roads) SELECT r.road_id, g.signal_id, CAST(row_number() OVER (PARTITION BY r.road_id ORDER BY CASE WHEN lo <= hi THEN g.s ELSE -g.s END) AS INT) AS ord FROM r JOIN d_signal_refs g ON g.map_id = r.map_id AND g.road_id = r.road_id AND g.s >= least(lo, hi) AND g.s <= greatest(lo, hi)",
    "d_roads", "d_signal_refs",
)
def ao3_signals_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    signals, roads = derived(spark, sf_dir, "d_signal_refs", "d_roads")
    half, even = F.col("length") / 2, F.col("road_id") % 2 == 0
    ranges = roads.select("map_id", "road_id", F.col("road_id").alias("range_id"), F.when(even, 0.0).otherwise(half).alias("lo"), F.when(even, half).otherwise(0.0).alias("hi"))
    return asof.records_between(signals.select("map_id", "road_id", "signal_id", F.col("s").alias("s0")), ranges, ["map_id", "road_id"]).select("road_id", "signal_id", "ord")


@query("SELECT l.road_id, l.lane_id, min_by(l.section_id, s.s0) AS first_section, max_by(l.section_id, s.s0) AS last_section FROM d_lanes l JOIN d_sections s ON s.road_id = l.road_id AND s.section_id = l.section_id GROUP BY l.road_id, l.lane_id", "d_lanes", "d_sections")
def ao7_lane_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections, lanes = derived(spark, sf_dir, "d_sections", "d_lanes")
    return asof.lane_extent(sections, lanes).select("road_id", "lane_id", "first_section", "last_section")


LANE_AT = """more at_s AS (SELECT l.map_id, l.road_id, l.section_id, l.lane_id, g.s FROM d_lanes l JOIN d_geometry x ON x.road_id = l.road_id AND x.seq = l.section_id * 3
  JOIN (SELECT road_id, seq, s0 + 1e0 AS s FROM d_geometry) g ON g.road_id = x.road_id AND g.seq = x.seq),
wd AS (SELECT a.*, w.a + (a.s - w.s0) * w.b AS width FROM at_s a JOIN d_lane_width w ON w.road_id = a.road_id AND w.lane_id = a.lane_id AND a.s >= w.s0 AND a.s < w.s1),
o AS (SELECT *, sign(lane_id) * (sum(width) OVER (PARTITION BY road_id, section_id, sign(lane_id) ORDER BY abs(lane_id) ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - width / 2e0) AS t FROM wd),
pl AS (SELECT o.*, g.x + (o.s - g.s0) * cos(g.hdg) - t * sin(g.hdg) AS px, g.y + (o.s - g.s0) * sin(g.hdg) + t * cos(g.hdg) AS py, g.hdg FROM o JOIN d_geometry g ON g.road_id = o.road_id AND o.s >= g.s0 AND o.s < g.s1)"""


@query(LANE_AT + " SELECT road_id, section_id, lane_id, round(width, 4) + 0e0 AS width, round(px, 4) + 0e0 AS x, round(py, 4) + 0e0 AS y, round(-degrees(hdg) + CASE WHEN lane_id > 0 THEN 18e1 ELSE 0e0 END, 4) + 0e0 AS yaw, round(t - width / 2e0, 4) + 0e0 AS t_right, round(t + width / 2e0, 4) + 0e0 AS t_left FROM pl", "d_lanes", "d_geometry", "d_lane_width", roads=True)
def lr9_lane_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    lanes, geometry, widths = derived(spark, sf_dir, "d_lanes", "d_geometry", "d_lane_width")
    starts = geometry.filter("seq % 3 = 0").select("map_id", "road_id", (F.col("seq") / 3).cast("int").alias("section_id"), (F.col("s0") + 1.0).alias("s"))
    at = lanes.select("map_id", "road_id", "section_id", "lane_id").join(starts, ["map_id", "road_id", "section_id"])
    out = linref.lane_points(at, widths, geometry)
    return out.select("road_id", "section_id", "lane_id", *[tidy(F.col(c)).alias(c) for c in ("width", "x", "y", "yaw", "t_right", "t_left")])


@query("SELECT road_id, round(g.x + length / 2 * cos(hdg), 4) + 0e0 AS x, round(g.y + length / 2 * sin(hdg), 4) + 0e0 AS y, round(e.a + length / 2 * e.b, 4) + 0e0 AS z, round(e.b, 4) + 0e0 AS slope FROM d_geometry g JOIN d_elevation e USING (map_id, road_id, s0)", "d_geometry", "d_elevation")
def lr7_road_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    geometry, elevation = derived(spark, sf_dir, "d_geometry", "d_elevation")
    points = geometry.select("map_id", "road_id", (F.col("s0") + F.col("length") / 2).alias("s"))
    return linref.road_points(points, geometry, elevation).select("road_id", *[tidy(F.col(c)).alias(c) for c in ("x", "y", "z", "slope")])


@query("SELECT road_id, seq, round(CASE WHEN curvature = 0 THEN x + length * cos(hdg) ELSE x + (sin(hdg + curvature * length) - sin(hdg)) / curvature END, 4) + 0e0 AS x, round(CASE WHEN curvature = 0 THEN y + length * sin(hdg) ELSE y - (cos(hdg + curvature * length) - cos(hdg)) / curvature END, 4) + 0e0 AS y FROM d_geometry", "d_geometry")
def lr2_arc_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    (g,) = derived(spark, sf_dir, "d_geometry")
    x, y, _ = linref.arc_position(F.col("x"), F.col("y"), F.col("hdg"), F.col("curvature"), F.col("length"))
    return g.select("road_id", "seq", tidy(x).alias("x"), tidy(y).alias("y"))


@query(ENDS + ", k AS (SELECT r.map_id, r.road_id, r.length, unnest(range(0, CAST(ceil(r.length / 1e1) AS BIGINT))) * 1e1 AS s FROM d_roads r) SELECT k.road_id, e.section_id, l.lane_id, k.s FROM k JOIN ends e ON e.road_id = k.road_id AND k.s >= e.s0 AND k.s < e.s1 JOIN d_lanes l ON l.road_id = e.road_id AND l.section_id = e.section_id WHERE (l.type_mask & 2) <> 0", "d_sections", "d_roads", "d_lanes")
def wg1_waypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    roads, sections, lanes = derived(spark, sf_dir, "d_roads", "d_sections", "d_lanes")
    return generate.waypoints(roads, sections, lanes, 10.0).select("road_id", "section_id", "lane_id", "s")


@query("more e AS (SELECT road_id, min(section_id) AS f, max(section_id) AS z FROM d_sections GROUP BY road_id) SELECT l.road_id, l.section_id, l.lane_id, CASE WHEN l.lane_id < 0 THEN 0e0 ELSE CAST(r.length AS DOUBLE) END AS s FROM d_lanes l JOIN e ON e.road_id = l.road_id JOIN d_roads r ON r.road_id = l.road_id WHERE (l.type_mask & 2) <> 0 AND ((l.lane_id < 0 AND l.section_id = e.f) OR (l.lane_id > 0 AND l.section_id = e.z))", "d_sections", "d_roads", "d_lanes")
def wg2_road_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    roads, sections, lanes = derived(spark, sf_dir, "d_roads", "d_sections", "d_lanes")
    return generate.road_entries(roads, sections, lanes).select("road_id", "section_id", "lane_id", F.col("s").cast("double").alias("s"))


@query(ENDS + " SELECT l.road_id, l.section_id, l.lane_id, CAST(CASE WHEN l.lane_id <= 0 THEN e.s0 ELSE e.s1 END AS DOUBLE) AS s_start, CAST(CASE WHEN l.lane_id <= 0 THEN e.s1 ELSE e.s0 END AS DOUBLE) AS s_end FROM d_lanes l JOIN ends e ON e.road_id = l.road_id AND e.section_id = l.section_id", "d_sections", "d_roads", "d_lanes")
def wg4_lane_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    roads, sections, lanes = derived(spark, sf_dir, "d_roads", "d_sections", "d_lanes")
    return generate.lane_starts(roads, sections, lanes).select("road_id", "section_id", "lane_id", F.col("s_start").cast("double").alias("s_start"), F.col("s_end").cast("double").alias("s_end"))


EDGES = """more st AS (SELECT *, lead(section_id) OVER (PARTITION BY road_id, lane_id ORDER BY section_id) AS nx, lag(section_id) OVER (PARTITION BY road_id, lane_id ORDER BY section_id) AS pv FROM d_lanes),
ow AS (SELECT *, CASE WHEN lane_id < 0 THEN succ ELSE pred END AS next_lane, CASE WHEN lane_id < 0 THEN nx ELSE pv END AS ahead FROM st),
ex AS (SELECT road_id, lane_id, min(section_id) AS f, max(section_id) AS z FROM d_lanes GROUP BY road_id, lane_id),
ed AS (SELECT road_id, section_id, lane_id, road_id AS next_road, ahead AS next_section, next_lane FROM ow WHERE ahead IS NOT NULL
  UNION ALL SELECT o.road_id, o.section_id, o.lane_id, ex.road_id, CASE WHEN o.lane_id < 0 THEN ex.f ELSE ex.z END, o.next_lane
  FROM ow o JOIN d_roads r ON r.road_id = o.road_id JOIN ex ON ex.road_id = CASE WHEN o.lane_id < 0 THEN r.succ ELSE r.pred END AND ex.lane_id = o.next_lane WHERE o.ahead IS NULL)"""


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.lane_edges(*derived(spark, sf_dir, "d_roads", "d_sections", "d_lanes"))


@query(EDGES + " SELECT road_id, section_id, lane_id, next_road, next_section, next_lane FROM ed", "d_roads", "d_lanes", roads=True)
def jg1_lane_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges(spark, sf_dir).select("road_id", "section_id", "lane_id", "next_road", "next_section", "next_lane")


@query(EDGES + " SELECT DISTINCT road_id, next_road FROM ed WHERE road_id <> next_road", "d_roads", "d_lanes", roads=True)
def jg4_road_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.road_neighbours(edges(spark, sf_dir)).select("road_id", "next_road")


@query(EDGES + " SELECT l.road_id, l.section_id, l.lane_id, coalesce(ed.next_road, l.road_id) AS next_road, coalesce(ed.next_section, l.section_id) AS next_section, coalesce(ed.next_lane, l.lane_id) AS next_lane FROM d_lanes l LEFT JOIN ed ON ed.road_id = l.road_id AND ed.section_id = l.section_id AND ed.lane_id = l.lane_id", "d_roads", "d_lanes", roads=True)
def jg9_topology(spark: SparkSession, sf_dir: str) -> DataFrame:
    (lanes,) = derived(spark, sf_dir, "d_lanes")
    return graph.topology(edges(spark, sf_dir), lanes).drop("map_id")


@query("SELECT map_id, junction_id, incoming_road AS road_id, link_from AS lane_id, connecting_road AS next_road, link_to AS next_lane FROM d_connections WHERE link_from <> 0", "d_connections")
def jg2_junction_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.junction_options(*derived(spark, sf_dir, "d_connections"))


@query("more o AS (SELECT road_id, section_id, lane_id, lane_id + CAST(sign(lane_id) AS INT) AS r, CASE WHEN abs(lane_id) = 1 THEN -lane_id ELSE lane_id - CAST(sign(lane_id) AS INT) END AS f, list(lane_id) OVER (PARTITION BY map_id, road_id, section_id) AS held FROM d_lanes) SELECT road_id, section_id, lane_id, CASE WHEN list_contains(held, r) THEN r END AS right_lane, CASE WHEN list_contains(held, f) THEN f END AS left_lane FROM o", "d_lanes")
def jg8_side_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.side_lanes(*derived(spark, sf_dir, "d_lanes")).drop("map_id")


AHEAD = ENDS.replace("more ends", "ends") + """, en AS MATERIALIZED (SELECT road_id, section_id, s0, s1 FROM ends), eg AS MATERIALIZED (SELECT * FROM ed),
z AS (SELECT road_id, min(section_id) AS f, max(section_id) AS z FROM d_sections GROUP BY road_id),
st0 AS (SELECT concat(l.road_id, '_', l.lane_id) AS id, l.road_id, l.section_id, l.lane_id, CASE WHEN l.lane_id < 0 THEN 0e0 ELSE CAST(r.length AS DOUBLE) END AS s
  FROM d_lanes l JOIN z ON z.road_id = l.road_id JOIN d_roads r ON r.road_id = l.road_id WHERE (l.type_mask & 2) <> 0 AND ((l.lane_id < 0 AND l.section_id = z.f) OR (l.lane_id > 0 AND l.section_id = z.z))),
go AS (SELECT id, road_id, section_id, lane_id, s, 6e1 AS lft, CAST(NULL AS BIGINT) AS fr, CAST(NULL AS INT) AS fs FROM st0
  UNION ALL SELECT g.id, eg.next_road, eg.next_section, eg.next_lane, CASE WHEN eg.next_lane <= 0 THEN n.s0 ELSE n.s1 END, g.lft - CASE WHEN g.lane_id <= 0 THEN e.s1 - g.s ELSE g.s - e.s0 END, g.road_id, g.section_id
  FROM go g JOIN en e ON e.road_id = g.road_id AND e.section_id = g.section_id JOIN eg ON eg.road_id = g.road_id AND eg.section_id = g.section_id AND eg.lane_id = g.lane_id JOIN en n ON n.road_id = eg.next_road AND n.section_id = eg.next_section
  WHERE g.lft > CASE WHEN g.lane_id <= 0 THEN e.s1 - g.s ELSE g.s - e.s0 END AND (g.fr IS NULL OR NOT (eg.next_road = g.fr AND eg.next_section = g.fs)))
SELECT g.id, g.road_id, g.section_id, g.lane_id, round(CASE WHEN g.lane_id <= 0 THEN g.s + g.lft ELSE g.s - g.lft END, 4) + 0e0 AS s FROM go g JOIN en e ON e.road_id = g.road_id AND e.section_id = g.section_id
WHERE g.lft <= CASE WHEN g.lane_id <= 0 THEN e.s1 - g.s ELSE g.s - e.s0 END"""


@query(f"{EDGES}, {AHEAD}", "d_roads", "d_sections", "d_lanes", roads=True)
def jg6_waypoints_ahead(spark: SparkSession, sf_dir: str) -> DataFrame:
    roads, sections, lanes = derived(spark, sf_dir, "d_roads", "d_sections", "d_lanes")
    entries = generate.road_entries(roads, sections, lanes).withColumn("id", F.concat_ws("_", "road_id", "lane_id"))
    return graph.advance(entries, edges(spark, sf_dir), roads, sections, 60.0).select("id", "road_id", "section_id", "lane_id", tidy(F.col("s")).alias("s"))


@query("SELECT map_id, junction_id, round((max(x) + min(x)) / 2, 4) + 0e0 AS cx, round((max(y) + min(y)) / 2, 4) + 0e0 AS cy, round((max(x) - min(x)) / 2 * 15e-1, 4) + 0e0 AS ex, round((max(y) - min(y)) / 2 * 15e-1, 4) + 0e0 AS ey FROM (SELECT r.map_id, r.junction_id, g.x, g.y FROM d_roads r JOIN d_geometry g ON g.road_id = r.road_id WHERE r.junction_id <> -1) GROUP BY map_id, junction_id", "d_roads", "d_geometry")
def ag1_junction_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    roads, geometry = derived(spark, sf_dir, "d_roads", "d_geometry")
    points = roads.filter("junction_id <> -1").select("map_id", "road_id", "junction_id").join(geometry.select("map_id", "road_id", "x", "y"), ["map_id", "road_id"])
    return tiles.bounds(points, ["map_id", "junction_id"], 1.5).select("map_id", "junction_id", *[tidy(F.col(c)).alias(c) for c in ("cx", "cy", "ex", "ey")])


@query("more p AS (SELECT *, CAST(floor(x / 5e2) AS INT) AS tx, CAST(floor(y / 5e2) AS INT) AS ty FROM d_pings) SELECT p.event_id, p.tx, p.ty, t.map_id IS NOT NULL AS inside, round(CASE WHEN t.map_id IS NOT NULL THEN x - p.tx * 5e2 END, 6) + 0e0 AS local_x FROM p LEFT JOIN d_tiles t ON t.map_id = p.map_id AND t.tx = p.tx AND t.ty = p.ty", "d_pings", "d_tiles")
def ag9_features_by_tile(spark: SparkSession, sf_dir: str) -> DataFrame:
    pings, grid = derived(spark, sf_dir, "d_pings", "d_tiles")
    inside, outside = tiles.owned(pings, grid, 500.0)
    cols = lambda df, known, x: df.select("event_id", "tx", "ty", F.lit(known).alias("inside"), x.alias("local_x"))
    return cols(inside, True, tidy(F.col("local_x"), 6)).unionByName(cols(outside, False, F.lit(None).cast("double")))


@query("SELECT map_id, CAST(greatest(max(tx), 0) - least(min(tx), 0) + 1 AS INT) AS n_x, CAST(greatest(max(ty), 0) - least(min(ty), 0) + 1 AS INT) AS n_y FROM d_tiles GROUP BY map_id", "d_tiles")
def ag8_tile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.tile_counts(*derived(spark, sf_dir, "d_tiles"))


@query("SELECT p.event_id, t.tx, t.ty FROM d_pings p JOIN d_tiles t ON t.map_id = p.map_id AND t.tx BETWEEN CAST(floor((x - 3e2) / 5e2) AS INT) AND CAST(floor((x + 3e2) / 5e2) AS INT) AND t.ty BETWEEN CAST(floor((y - 3e2) / 5e2) AS INT) AND CAST(floor((y + 3e2) / 5e2) AS INT)", "d_pings", "d_tiles")
def st1_tiles_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    pings, grid = derived(spark, sf_dir, "d_pings", "d_tiles")
    return tiles.tiles_near(pings, grid, 500.0, 300.0).select("event_id", "tx", "ty")


@query("SELECT p.event_id, h.r, round(h.r / 255e0 * 4e1 + 1e1, 4) + 0e0 AS z FROM d_pings p LEFT JOIN d_heightmap h ON h.px = ((CAST(floor(x / 5e3 * 64) AS INT) % 64) + 64) % 64 AND h.py = ((CAST(floor(y / 5e3 * 64) AS INT) % 64) + 64) % 64", "d_pings", "d_heightmap")
def te1_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    pings, raster = derived(spark, sf_dir, "d_pings", "d_heightmap")
    return tiles.height_at(pings, raster, 5000.0, 64, 10.0, 50.0).select("event_id", "r", tidy(F.col("z")).alias("z"))


@query("more k AS (SELECT event_id, cos(radians(42e0)) AS sc, x, y FROM d_pings), m AS (SELECT *, sc * radians(2e0) * 6378137e0 + x AS mx, sc * 6378137e0 * ln(tan(radians(9e1 + 42e0) / 2e0)) - y AS my FROM k) SELECT event_id, round(degrees(2e0 * atan(exp(my / (6378137e0 * sc)))) - 9e1, 8) AS lat, round(degrees(mx / (6378137e0 * sc)), 8) AS lon FROM m", "d_pings")
def ge1_local_to_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    (pings,) = derived(spark, sf_dir, "d_pings")
    lat, lon, _ = geo.local_to_geo(F.lit(42.0), F.lit(2.0), F.lit(0.0), F.col("x"), F.col("y"), F.col("z"))
    return pings.select("event_id", F.round(lat, 8).alias("lat"), F.round(lon, 8).alias("lon"))


@query("more b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS px, l_discount * 1e2 AS py, l_tax * 1e2 AS bx, l_discount * 5e1 AS by_ FROM lineitem), t AS (SELECT *, CASE WHEN bx * bx + by_ * by_ > 0 THEN greatest(0e0, least(1e0, (px * bx + py * by_) / (bx * bx + by_ * by_))) ELSE 0e0 END AS t FROM b) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(t * sqrt(bx * bx + by_ * by_), 4) + 0e0 AS along, round(sqrt((t * bx - px) ** 2 + (t * by_ - py) ** 2), 4) + 0e0 AS distance FROM t".replace("more b AS", "WITH b AS"))
def sc8_point_to_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    along, d = scalar.point_to_segment(F.col("l_quantity"), F.col("l_discount") * 100.0, F.lit(0.0), F.lit(0.0), F.col("l_tax") * 100.0, F.col("l_discount") * 50.0)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", tidy(along).alias("along"), tidy(d).alias("distance"))


@query("more p AS (SELECT event_id, CAST(floor(x / 5e2) AS BIGINT) - 4 AS tx, CAST(floor(y / 5e2) AS BIGINT) - 4 AS ty FROM d_pings) SELECT event_id, tx * 4294967296 + CASE WHEN ty < 0 THEN ty + 4294967296 ELSE ty END AS tile, concat('Map_Tile_', tx, '_', ty) AS name FROM p", "d_pings")
def sc28_tile_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    (pings,) = derived(spark, sf_dir, "d_pings")
    tx, ty = F.floor(F.col("x") / 500.0) - 4, F.floor(F.col("y") / 500.0) - 4
    return pings.select("event_id", scalar.tile_pack(tx, ty).alias("tile"), scalar.tile_name(tx, ty).alias("name"))


@query("SELECT road_id, section_id, lane_id, CASE lower(type) WHEN 'driving' THEN 2 WHEN 'parking' THEN 256 WHEN 'biking' THEN 16 WHEN 'sidewalk' THEN 32 ELSE 1 END AS bit, concat(upper(type[1]), type[2:]) AS shown FROM d_lanes", "d_lanes")
def sc19_lane_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    (lanes,) = derived(spark, sf_dir, "d_lanes")
    bit = scalar.lane_type_bit(F.col("type"))
    return lanes.select("road_id", "section_id", "lane_id", bit.alias("bit"), scalar.lane_type_name(bit).alias("shown"))


@query("SELECT map_id, tx, ty, i, j, tx * 5e2 + i * 1e2 AS x, ty * 5e2 + j * 1e2 AS y FROM d_tiles, (SELECT unnest(range(0, 6)) AS i), (SELECT unnest(range(0, 6)) AS j)", "d_tiles")
def wg13_terrain_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    (grid,) = derived(spark, sf_dir, "d_tiles")
    return generate.terrain_grid(grid, 500.0, 100.0).select("map_id", "tx", "ty", "i", "j", "x", "y")


CONFLICTS = f"""more {SEGMENTS}, j AS (SELECT seg.*, r.junction_id FROM seg JOIN d_roads r ON r.road_id = seg.road_id WHERE r.junction_id <> -1),
pr AS (SELECT a.map_id, a.junction_id, a.road_id AS ra, b.road_id AS rb, a.x0 AS ax0, a.y0 AS ay0, a.x1 AS ax1, a.y1 AS ay1, b.x0 AS bx0, b.y0 AS by0, b.x1 AS bx1, b.y1 AS by1
  FROM j a JOIN j b ON b.map_id = a.map_id AND b.junction_id = a.junction_id AND a.road_id < b.road_id),
e AS (SELECT *, unnest([[ax0, ay0, bx0, by0, bx1, by1], [ax1, ay1, bx0, by0, bx1, by1], [bx0, by0, ax0, ay0, ax1, ay1], [bx1, by1, ax0, ay0, ax1, ay1]]) AS q FROM pr),
f AS (SELECT *, greatest(0e0, least(1e0, ((q[1] - q[3]) * (q[5] - q[3]) + (q[2] - q[4]) * (q[6] - q[4])) / ((q[5] - q[3]) ** 2 + (q[6] - q[4]) ** 2))) AS t FROM e),
g AS (SELECT DISTINCT map_id, junction_id, ra, rb FROM f WHERE sqrt((q[3] + t * (q[5] - q[3]) - q[1]) ** 2 + (q[4] + t * (q[6] - q[4]) - q[2]) ** 2) <= 2e0
  OR (((bx1 - bx0) * (ay0 - by0) - (by1 - by0) * (ax0 - bx0)) * ((bx1 - bx0) * (ay1 - by0) - (by1 - by0) * (ax1 - bx0)) < 0 AND ((ax1 - ax0) * (by0 - ay0) - (ay1 - ay0) * (bx0 - ax0)) * ((ax1 - ax0) * (by1 - ay0) - (ay1 - ay0) * (bx1 - ax0)) < 0))
SELECT map_id, junction_id, ra AS road_id, rb AS other_road FROM g UNION ALL SELECT map_id, junction_id, rb, ra FROM g"""


@query(CONFLICTS, "d_geometry", "d_lane_width", "d_roads", roads=True)
def sp8_junction_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    (roads,) = derived(spark, sf_dir, "d_roads")
    segments = lane_segments(spark, sf_dir).join(roads.filter("junction_id <> -1").select("map_id", "road_id", "junction_id"), ["map_id", "road_id"])
    return spatial.junction_conflicts(segments)


@query()
def st4_movement_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadlake.streaming.gate import movement_gate

    (pings,) = derived(spark, sf_dir, "d_pings")
    return movement_gate(pings.select("actor_id", "event_id", "ts", "x", "y", "z", "yaw"))


@query("SELECT DISTINCT road_id, last_value(s0) OVER (PARTITION BY road_id ORDER BY s0 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_s FROM d_sections", "d_sections")
def ao5_last_section_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    (sections,) = derived(spark, sf_dir, "d_sections")
    return sections.groupBy("road_id").agg(F.max("s0").alias("last_s"))
