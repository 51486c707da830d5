"""Registered queries of curves, signals, surfaces, terrain and tiles over the derived tables, each with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.functions.scalar import ANY_LANE, tidy
from roadlake.operators import asof, curves, generate, graph, signals, spatial, surface, tiles
from roadlake.plans.derived import derived
from roadlake.plans.road_queries import EDGES, ENDS, ORACLES, edges, query

LANE = "road_id, section_id, lane_id"


def section_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections, roads = derived(spark, sf_dir, "d_sections", "d_roads")
    return asof.section_ends(sections, roads).select("map_id", "road_id", "section_id", "s0", "s1")


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.road_entries(*derived(spark, sf_dir, "d_roads", "d_sections", "d_lanes"))


def starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.lane_starts(*derived(spark, sf_dir, "d_roads", "d_sections", "d_lanes"))


@query("SELECT l.road_id, l.section_id, l.lane_id, lead(l.section_id) OVER w AS next_section, lag(l.section_id) OVER w AS prev_section FROM d_lanes l JOIN d_sections s ON s.road_id = l.road_id AND s.section_id = l.section_id WINDOW w AS (PARTITION BY l.road_id, l.lane_id ORDER BY s.s0)", "d_lanes", "d_sections")
def ao4_adjacent_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections, lanes = derived(spark, sf_dir, "d_sections", "d_lanes")
    return asof.next_section_of_lane(sections, lanes).select("road_id", "section_id", "lane_id", "next_section", "prev_section")


MARKS = "m AS (SELECT map_id, road_id, section_id, lane_id, CASE abs(lane_id) WHEN 1 THEN 1 WHEN 2 THEN CASE WHEN road_id % 2 = 0 THEN 2 ELSE 3 END ELSE 0 END AS change FROM d_lanes UNION ALL SELECT map_id, road_id, section_id, 0, CAST(road_id % 4 AS INT) FROM d_sections WHERE road_id % 5 <> 0)"


@query(
    f"more {MARKS}, k AS (SELECT *, list(struct_pack(lane := lane_id, change := change)) OVER (PARTITION BY map_id, road_id, section_id) AS held, lane_id - CAST(sign(lane_id) AS INT) AS inner_lane FROM m), "
    "o AS (SELECT *, list_filter(held, lambda h: h.lane = inner_lane)[1].change AS inner_change FROM k WHERE lane_id <> 0) "
    "SELECT road_id, section_id, lane_id, CASE WHEN lane_id < 0 THEN change & 1 ELSE change >> 1 END + CASE WHEN lane_id < 0 THEN coalesce(inner_change, 3) & 2 ELSE (coalesce(inner_change, 3) & 1) * 2 END AS allowed FROM o",
    "d_lanes", "d_sections",
)
def ao12_lane_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived(spark, sf_dir, "d_lanes", "d_sections")
    marks = spark.sql(f"WITH {MARKS} SELECT * FROM m")
    return surface.lane_changes(marks).select("road_id", "section_id", "lane_id", "allowed")


@query(
    "more k AS (SELECT road_id, seq, x, y, hdg, length, curvature, i, CASE WHEN i IN (0, 32) THEN 1e0 WHEN i % 2 = 1 THEN 4e0 ELSE 2e0 END AS w, length / 32 * i AS u FROM d_geometry, (SELECT unnest(range(0, 33)) AS i)), "
    "c AS (SELECT *, hdg + curvature * u - curvature / length * u * u AS a FROM k) SELECT road_id, seq, round(any_value(x) + sum(w * cos(a)) * any_value(length) / 96e0, 4) + 0e0 AS x, round(any_value(y) + sum(w * sin(a)) * any_value(length) / 96e0, 4) + 0e0 AS y, round(any_value(hdg), 4) + 0e0 AS heading FROM c GROUP BY road_id, seq",
    "d_geometry",
)
def lr3_spiral_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spirals whose curvature goes from the record's to its negative, so that they end in the direction of their start."""
    (g,) = derived(spark, sf_dir, "d_geometry")
    x, y, heading = curves.spiral_position(F.col("x"), F.col("y"), F.col("hdg"), F.col("curvature"), -F.col("curvature"), F.col("length"), F.col("length"))
    return g.select("road_id", "seq", tidy(x).alias("x"), tidy(y).alias("y"), tidy(heading).alias("heading"))


CHORDS = """q AS (SELECT *, sum(sqrt((u1 - u0) ** 2 + (v1 - v0) ** 2)) OVER (PARTITION BY road_id, seq ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s1 FROM p),
r AS (SELECT *, coalesce(lag(s1) OVER (PARTITION BY road_id, seq ORDER BY k), 0e0) AS s0 FROM q),
h AS (SELECT *, (ds - s0) / (s1 - s0) AS f FROM r WHERE s0 <= ds AND (ds < s1 OR k = n)),
o AS (SELECT *, u0 + (u1 - u0) * f AS u, v0 + (v1 - v0) * f AS v FROM h)
SELECT road_id, seq, round(x + u * cos(hdg) - v * sin(hdg), 4) + 0e0 AS x, round(y + u * sin(hdg) + v * cos(hdg), 4) + 0e0 AS y FROM o"""


@query(
    "more p0 AS (SELECT road_id, seq, x, y, hdg, length / 2 AS ds, curvature / 5 AS c, CAST(ceil(length / 3e-1) AS INT) + 2 AS n FROM d_geometry), "
    f"p AS (SELECT *, (k - 1) * 3e-1 AS u0, k * 3e-1 AS u1, c * ((k - 1) * 3e-1) ** 2 AS v0, c * (k * 3e-1) ** 2 AS v1 FROM (SELECT *, unnest(range(1, n + 1)) AS k FROM p0)), {CHORDS}",
    "d_geometry", roads=True,
)
def lr4_poly3_middles(spark: SparkSession, sf_dir: str) -> DataFrame:
    (g,) = derived(spark, sf_dir, "d_geometry")
    shaped = g.select("road_id", "seq", "x", "y", "hdg", "length", (F.col("length") / 2).alias("ds"), F.lit(0.0).alias("va"), F.lit(0.0).alias("vb"), (F.col("curvature") / 5).alias("vc"), F.lit(0.0).alias("vd"))
    return curves.poly3_positions(shaped, ["road_id", "seq"]).select("road_id", "seq", tidy(F.col("px")).alias("x"), tidy(F.col("py")).alias("y"))


@query(
    "more p0 AS (SELECT road_id, seq, x, y, hdg, length, length / 2 AS ds, curvature * length AS c, greatest(CAST(floor(length / 5e-1) AS INT), 5) AS n FROM d_geometry), "
    "p1 AS (SELECT *, unnest(range(1, n + 1)) AS k FROM p0), p2 AS (SELECT *, (k - 1) * (1e0 / n) AS a, k * (1e0 / n) AS b FROM p1), "
    f"p AS (SELECT *, length * a AS u0, length * b AS u1, c * a * a - c / 2 * a * a * a AS v0, c * b * b - c / 2 * b * b * b AS v1 FROM p2), {CHORDS}",
    "d_geometry", roads=True,
)
def lr5_param_poly3_middles(spark: SparkSession, sf_dir: str) -> DataFrame:
    (g,) = derived(spark, sf_dir, "d_geometry")
    c = F.col("curvature") * F.col("length")
    coefs = {"ua": F.lit(0.0), "ub": F.col("length"), "uc": F.lit(0.0), "ud": F.lit(0.0), "va": F.lit(0.0), "vb": F.lit(0.0), "vc": c, "vd": -c / 2}
    shaped = g.select("road_id", "seq", "x", "y", "hdg", "length", (F.col("length") / 2).alias("ds"), *[v.alias(k) for k, v in coefs.items()])
    return curves.param_poly3_positions(shaped, ["road_id", "seq"], by_length=False).select("road_id", "seq", tidy(F.col("px")).alias("x"), tidy(F.col("py")).alias("y"))


def placed_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs, geometry, elevation = derived(spark, sf_dir, "d_signal_refs", "d_geometry", "d_elevation")
    return signals.signal_places(refs, geometry, elevation)


@query("SELECT g.signal_id, round(x.x + (g.s - x.s0 + k) * cos(x.hdg) - g.t * sin(x.hdg), 4) + 0e0 AS x, round(x.y + (g.s - x.s0 + k) * sin(x.hdg) + g.t * cos(x.hdg), 4) + 0e0 AS y, round(e.a + (g.s - e.s0) * e.b, 4) + 0e0 AS z, round(-degrees(x.hdg), 4) + 0e0 AS yaw FROM (SELECT *, CASE WHEN type LIKE '10000__' THEN 25e-2 ELSE 0e0 END AS k FROM d_signal_refs) g JOIN d_geometry x ON x.road_id = g.road_id AND g.s >= x.s0 AND g.s < x.s1 JOIN d_elevation e ON e.road_id = g.road_id AND g.s >= e.s0 AND g.s < e.s1", "d_signal_refs", "d_geometry", "d_elevation")
def lr13_signal_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed_signals(spark, sf_dir).select("signal_id", *[tidy(F.col(c)).alias(c) for c in ("x", "y", "z", "yaw")])


@query("SELECT signal_id, round(s + CASE WHEN type LIKE '10000__' THEN 25e-2 ELSE 0e0 END, 4) + 0e0 AS s, abs(t) AS distance FROM d_signal_refs", "d_signal_refs")
def lr15_signals_to_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placed signals projected back to their roads: closed form, since the derived roads are straight."""
    (geometry,) = derived(spark, sf_dir, "d_geometry")
    points = placed_signals(spark, sf_dir).select("map_id", "road_id", F.col("signal_id").alias("point_id"), "x", "y")
    return signals.project_to_road(points, geometry).select(F.col("point_id").alias("signal_id"), tidy(F.col("s")).alias("s"), tidy(F.col("distance")).alias("distance"))


@query(
    ENDS + ", a AS (SELECT g.signal_id, g.s, g.t AS own, CASE WHEN g.type LIKE '10000__' THEN 25e-2 ELSE 0e0 END AS k, l.road_id, l.lane_id FROM d_signal_refs g JOIN ends e ON e.road_id = g.road_id AND g.s >= e.s0 AND g.s < e.s1 JOIN d_lanes l ON l.road_id = e.road_id AND l.section_id = e.section_id), "
    "w AS (SELECT a.*, w.a + (a.s - w.s0) * w.b AS width FROM a JOIN d_lane_width w ON w.road_id = a.road_id AND w.lane_id = a.lane_id AND a.s >= w.s0 AND a.s < w.s1), "
    "o AS (SELECT *, sign(lane_id) * (sum(width) OVER (PARTITION BY signal_id, sign(lane_id) ORDER BY abs(lane_id) ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - width / 2e0) AS t FROM w), "
    "d AS (SELECT *, round(sqrt((t - own) ** 2 + k ** 2), 6) AS d FROM o) SELECT signal_id, lane_id, d + 0e0 AS distance FROM d QUALIFY row_number() OVER (PARTITION BY signal_id ORDER BY d, -sign(lane_id), -abs(lane_id)) = 1",
    "d_sections", "d_roads", "d_lanes", "d_lane_width", "d_signal_refs", roads=True,
)
def lr16_nearest_lanes_at_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections, roads, lanes, widths, geometry = derived(spark, sf_dir, "d_sections", "d_roads", "d_lanes", "d_lane_width", "d_geometry")
    points = placed_signals(spark, sf_dir).select("map_id", "road_id", F.col("signal_id").alias("point_id"), "s", "x", "y")
    near = signals.nearest_lane_at(points, sections, roads, lanes, widths, geometry, ANY_LANE)
    return near.select(F.col("point_id").alias("signal_id"), "lane_id", "distance")


@query(ENDS + ", g AS (SELECT l.road_id, l.section_id, l.lane_id, CASE WHEN l.lane_id < 0 THEN e.s0 ELSE e.s1 END AS a, CASE WHEN l.lane_id < 0 THEN 1 ELSE -1 END AS way, CASE WHEN l.lane_id < 0 THEN e.s1 ELSE e.s0 END AS b FROM d_lanes l JOIN ends e ON e.road_id = l.road_id AND e.section_id = l.section_id WHERE abs(l.lane_id) = 1) SELECT road_id, section_id, lane_id, a + way * 2e1 * unnest(range(0, greatest(CAST(ceil(abs(b - a) / 2e1) AS INT), 1))) AS s, false AS last FROM g UNION ALL SELECT road_id, section_id, lane_id, CAST(b AS DOUBLE), true FROM g", "d_sections", "d_roads", "d_lanes")
def wg7_to_lane_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.to_lane_end(starts(spark, sf_dir).filter("abs(lane_id) = 1"), 20.0).drop("map_id")


@query(
    ENDS + ", k AS (SELECT e.*, e.s0 + 2e0 + 1e1 * unnest(range(0, CAST(ceil((e.s1 - e.s0 - 2e0) / 1e1) AS INT))) AS s FROM ends e JOIN d_roads r ON r.road_id = e.road_id WHERE r.junction_id = -1), "
    "w AS (SELECT k.*, w.a + (k.s - w.s0) * w.b + 15e-1 AS t FROM k JOIN d_lane_width w ON w.road_id = k.road_id AND w.lane_id = -1 AND k.s >= w.s0 AND k.s < w.s1) SELECT w.road_id, w.section_id, w.s, round(g.x + (w.s - g.s0) * cos(g.hdg) + t * sin(g.hdg), 4) + 0e0 AS x, round(g.y + (w.s - g.s0) * sin(g.hdg) - t * cos(g.hdg), 4) + 0e0 AS y FROM w JOIN d_geometry g ON g.road_id = w.road_id AND w.s >= g.s0 AND w.s < g.s1",
    "d_sections", "d_roads", "d_lane_width", roads=True,
)
def wg10_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    roads, lanes, widths, geometry = derived(spark, sf_dir, "d_roads", "d_lanes", "d_lane_width", "d_geometry")
    trees = surface.tree_places(section_table(spark, sf_dir), roads, lanes, widths, geometry, 10.0, 1.5, 2.0)
    return trees.select("road_id", "section_id", "s", tidy(F.col("x")).alias("x"), tidy(F.col("y")).alias("y"))


@query("more b AS (SELECT r.map_id, r.junction_id, (max(g.x) + min(g.x)) / 2 AS cx, (max(g.y) + min(g.y)) / 2 AS cy, (max(g.x) - min(g.x)) / 2 AS ex, (max(g.y) - min(g.y)) / 2 AS ey FROM d_roads r JOIN d_geometry g ON g.road_id = r.road_id WHERE r.junction_id <> -1 GROUP BY ALL) SELECT map_id, junction_id, corner, round(cx + CASE WHEN corner % 2 = 1 THEN ex ELSE -ex END, 4) + 0e0 AS x, round(cy + CASE WHEN corner // 2 % 2 = 1 THEN ey ELSE -ey END, 4) + 0e0 AS y, CASE WHEN corner >= 4 THEN 5e0 ELSE -5e0 END AS z FROM b, (SELECT CAST(unnest(range(0, 8)) AS INT) AS corner)", "d_roads", "d_geometry")
def wg12_box_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    roads, geometry = derived(spark, sf_dir, "d_roads", "d_geometry")
    points = roads.filter("junction_id <> -1").select("map_id", "road_id", "junction_id").join(geometry.select("map_id", "road_id", "x", "y"), ["map_id", "road_id"])
    boxes = tiles.bounds(points, ["map_id", "junction_id"]).withColumns({"cz": F.lit(0.0), "ez": F.lit(5.0)})
    return generate.box_corners(boxes).select("map_id", "junction_id", "corner", *[tidy(F.col(f"corner_{c}")).alias(c) for c in "xyz"])


@query(EDGES + ENDS.replace("more", ",", 1) + " SELECT ed.road_id, ed.section_id, ed.lane_id, ed.next_road, ed.next_section, ed.next_lane, CAST(CASE WHEN ed.next_lane <= 0 THEN e.s0 ELSE e.s1 END AS DOUBLE) AS next_s FROM ed JOIN ends e ON e.road_id = ed.next_road AND e.section_id = ed.next_section", "d_roads", "d_sections", "d_lanes", roads=True)
def jg5_successors(spark: SparkSession, sf_dir: str) -> DataFrame:
    met = graph.successors(edges(spark, sf_dir), starts(spark, sf_dir))
    return met.select("road_id", "section_id", "lane_id", "next_road", "next_section", "next_lane", F.col("next_s").cast("double").alias("next_s"))


@query(ENDS + " SELECT c.map_id, c.junction_id, l.road_id, l.section_id, l.lane_id, CAST(CASE WHEN l.lane_id <= 0 THEN e.s0 ELSE e.s1 END AS DOUBLE) AS s_start, CAST(CASE WHEN l.lane_id <= 0 THEN e.s1 ELSE e.s0 END AS DOUBLE) AS s_end FROM (SELECT DISTINCT map_id, junction_id, connecting_road FROM d_connections) c JOIN d_lanes l ON l.road_id = c.connecting_road AND (l.type_mask & 2) <> 0 JOIN ends e ON e.road_id = l.road_id AND e.section_id = l.section_id", "d_sections", "d_roads", "d_lanes", "d_connections")
def jg10_junction_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    (connections,) = derived(spark, sf_dir, "d_connections")
    out = graph.junction_lanes(connections, starts(spark, sf_dir))
    return out.withColumns({c: F.col(c).cast("double") for c in ("s_start", "s_end")})


VALID = "v AS (SELECT g.map_id, g.road_id, g.signal_id, g.s, g.orientation, z.low, z.high FROM d_signal_refs g JOIN ends e ON e.road_id = g.road_id AND g.s >= e.s0 AND g.s < e.s1 JOIN (SELECT road_id, section_id, min(lane_id) AS low, max(lane_id) AS high FROM d_lanes GROUP BY road_id, section_id) z ON z.road_id = e.road_id AND z.section_id = e.section_id), va AS (SELECT road_id, signal_id, s, 1 AS from_lane, high AS to_lane FROM v WHERE orientation <> '-' UNION ALL SELECT road_id, signal_id, s, low, -1 FROM v WHERE orientation <> '+')"


def valid_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs, sections, roads, lanes = derived(spark, sf_dir, "d_signal_refs", "d_sections", "d_roads", "d_lanes")
    return signals.default_validities(refs.select("map_id", "road_id", "signal_id", "s", "orientation"), sections, roads, lanes)


@query(f"{ENDS}, {VALID} SELECT signal_id, from_lane, to_lane FROM va", "d_sections", "d_roads", "d_lanes", "d_signal_refs")
def jg17_default_validities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_signals(spark, sf_dir).select("signal_id", "from_lane", "to_lane")


@query(
    EDGES + ENDS.replace("more", ",", 1) + f", {VALID}, fr AS (SELECT e.road_id AS start_road, l.lane_id AS start_lane, e.road_id, e.section_id, l.lane_id, CASE WHEN l.lane_id < 0 THEN e.s0 ELSE e.s1 END AS s, e.s0, e.s1, 0e0 AS gone FROM ends e JOIN ex ON ex.road_id = e.road_id JOIN d_lanes l ON l.road_id = e.road_id AND l.section_id = e.section_id AND l.lane_id = ex.lane_id WHERE abs(l.lane_id) = 1 AND e.section_id = CASE WHEN l.lane_id < 0 THEN ex.f ELSE ex.z END "
    "UNION ALL SELECT f.start_road, f.start_lane, ed.next_road, ed.next_section, ed.next_lane, CASE WHEN ed.next_lane < 0 THEN e.s0 ELSE e.s1 END, e.s0, e.s1, f.gone + f.s1 - f.s0 FROM fr f JOIN ed ON ed.road_id = f.road_id AND ed.section_id = f.section_id AND ed.lane_id = f.lane_id JOIN ends e ON e.road_id = ed.next_road AND e.section_id = ed.next_section WHERE f.gone + f.s1 - f.s0 < 15e1) "
    "SELECT f.start_road AS road_id, f.start_lane AS lane_id, va.signal_id, round(min(f.gone + abs(va.s - f.s)), 4) + 0e0 AS distance FROM fr f JOIN va ON va.road_id = f.road_id AND va.s >= f.s0 AND va.s <= f.s1 AND f.lane_id BETWEEN va.from_lane AND va.to_lane WHERE f.gone + abs(va.s - f.s) <= 15e1 GROUP BY ALL",
    "d_roads", "d_sections", "d_lanes", "d_signal_refs", roads=True,
)
def jg12_signals_ahead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals on the 150 m ahead of every road entry, valid for the lane, each once (JG11 is the search, JG12 the removal of repeats)."""
    roads, sections = derived(spark, sf_dir, "d_roads", "d_sections")
    points = entries(spark, sf_dir).withColumn("id", F.struct("road_id", "lane_id"))
    met = signals.signals_ahead(points, edges(spark, sf_dir), roads, sections, valid_signals(spark, sf_dir), 150.0)
    return met.select("id.road_id", "id.lane_id", "signal_id", tidy(F.col("distance")).alias("distance"))


ORACLES["jg12_signals_ahead"] = ORACLES["jg12_signals_ahead"].replace("WITH", "WITH RECURSIVE", 1)


@query("more c AS (SELECT g.map_id, r.junction_id AS controller_id, g.signal_id FROM d_signal_refs g JOIN d_roads r ON r.road_id = g.road_id WHERE r.junction_id <> -1) SELECT map_id, controller_id, signal_id, count(*) OVER (PARTITION BY map_id, controller_id) - 1 AS n_others FROM c", "d_signal_refs", "d_roads")
def jg14_signal_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The signals of a junction's roads stand for those of a controller."""
    refs, roads = derived(spark, sf_dir, "d_signal_refs", "d_roads")
    return graph.signal_groups(refs.join(roads.filter("junction_id <> -1").select("map_id", "road_id", F.col("junction_id").alias("controller_id")), ["map_id", "road_id"]).select("map_id", "controller_id", "signal_id"))


@query(
    "more s AS (SELECT g.map_id, g.signal_id, x.x + (g.s - x.s0 + CASE WHEN g.type LIKE '10000__' THEN 25e-2 ELSE 0e0 END) * cos(x.hdg) - g.t * sin(x.hdg) AS sx, x.y + (g.s - x.s0 + CASE WHEN g.type LIKE '10000__' THEN 25e-2 ELSE 0e0 END) * sin(x.hdg) + g.t * cos(x.hdg) AS sy FROM d_signal_refs g JOIN d_geometry x ON x.road_id = g.road_id AND g.s >= x.s0 AND g.s < x.s1), "
    "d AS (SELECT p.event_id, s.signal_id, round(sqrt((s.sx - p.x) ** 2 + (s.sy - p.y) ** 2), 6) AS d FROM d_pings p JOIN s ON s.map_id = p.map_id), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY event_id ORDER BY d, signal_id) AS INT) AS rank FROM d QUALIFY rank <= 3) SELECT event_id, rank, signal_id, d + 0e0 AS distance FROM r",
    "d_signal_refs", "d_geometry", "d_pings",
)
def sp5_nearest_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    (pings,) = derived(spark, sf_dir, "d_pings")
    sites = placed_signals(spark, sf_dir).select("map_id", F.col("signal_id").alias("site_id"), "x", "y")
    near = spatial.nearest_points(pings.select("map_id", F.col("event_id").alias("point_id"), "x", "y"), sites, 3)
    return near.select(F.col("point_id").alias("event_id"), "rank", F.col("site_id").alias("signal_id"), F.col("d").alias("distance"))


@query("SELECT road_id, section_id, min(lane_id) AS low, max(lane_id) AS high, min(CASE WHEN type = 'driving' THEN lane_id END) AS low_driving, max(CASE WHEN type = 'driving' THEN lane_id END) AS high_driving FROM d_lanes GROUP BY road_id, section_id", "d_lanes")
def ag3_outer_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    (lanes,) = derived(spark, sf_dir, "d_lanes")
    driving = F.when(F.col("type") == "driving", F.col("lane_id"))
    return lanes.groupBy("road_id", "section_id").agg(F.min("lane_id").alias("low"), F.max("lane_id").alias("high"), F.min(driving).alias("low_driving"), F.max(driving).alias("high_driving"))


@query("SELECT road_id, seq, round(avg(x) OVER w, 3) + 0e0 AS centre_x, round(x - avg(x) OVER w, 3) + 0e0 AS off_x, round(y - avg(y) OVER w, 3) + 0e0 AS off_y FROM d_geometry WINDOW w AS (PARTITION BY road_id)", "d_geometry")
def ag4_centred_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    (g,) = derived(spark, sf_dir, "d_geometry")
    return tiles.centred(g.select("road_id", "seq", "x", "y"), ["road_id"]).select("road_id", "seq", *[tidy(F.col(c), 3).alias(c) for c in ("centre_x", "off_x", "off_y")])


@query("more c AS (SELECT map_id, min(x) AS lx, min(y) AS ly FROM d_geometry GROUP BY map_id) SELECT g.road_id, CAST(floor((g.x - lx) / 5e2) AS INT) AS chunk_x, CAST(floor((g.y - ly) / 5e2) AS INT) AS chunk_y FROM d_geometry g JOIN c ON c.map_id = g.map_id WHERE g.seq = 0", "d_geometry")
def ag11_road_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    (g,) = derived(spark, sf_dir, "d_geometry")
    return tiles.chunks(g.select("map_id", "road_id", "seq", "x", "y"), ["road_id"], "seq", 500.0).drop("map_id")


@query("SELECT map_id, tx, ty, ty * 8 + tx AS number FROM d_tiles", "d_tiles")
def ag12_numbered_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.numbered(*derived(spark, sf_dir, "d_tiles"))


STRAIGHT = "stg AS (SELECT e.*, EXISTS (SELECT 1 FROM d_geometry g WHERE g.road_id = e.road_id AND g.s0 <= e.s0 AND e.s1 <= g.s1) AS straight FROM ends e)"


def straight(spark: SparkSession, sf_dir: str) -> DataFrame:
    geometry, elevation = derived(spark, sf_dir, "d_geometry", "d_elevation")
    return surface.straight_sections(section_table(spark, sf_dir), geometry, elevation)


@query(f"{ENDS}, {STRAIGHT} SELECT road_id, section_id, straight FROM stg", "d_sections", "d_roads")
def pf9_straight_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return straight(spark, sf_dir).select("road_id", "section_id", "straight")


ROWS = f"{STRAIGHT}, rn AS (SELECT *, CASE WHEN straight THEN 1 ELSE CAST(ceil((s1 - s0) / 1e1) AS INT) END AS n FROM stg), rw AS (SELECT *, CAST(unnest(range(0, n + 1)) AS INT) AS row FROM rn), rs AS (SELECT *, CASE WHEN row = n THEN s1 - 1e-6 ELSE s0 + row * 1e1 END AS s FROM rw)"


def strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    lanes, widths, geometry = derived(spark, sf_dir, "d_lanes", "d_lane_width", "d_geometry")
    return surface.lane_strip(straight(spark, sf_dir), lanes, widths, geometry, 10.0)


# Driving lanes are those next to the reference line, so one edge is the line itself and the other is a width away.
EDGE_POINTS = f"{ENDS}, {ROWS}, ep AS (SELECT r.road_id, r.section_id, w.lane_id, r.row, r.n, g.x + (r.s - g.s0) * cos(g.hdg) AS bx, g.y + (r.s - g.s0) * sin(g.hdg) AS by_, g.hdg, CASE WHEN w.lane_id < 0 THEN -(w.a + (r.s - w.s0) * w.b) ELSE 0e0 END AS tr, CASE WHEN w.lane_id < 0 THEN 0e0 ELSE w.a + (r.s - w.s0) * w.b END AS tl FROM rs r JOIN d_geometry g ON g.road_id = r.road_id AND r.s >= g.s0 AND r.s < g.s1 JOIN d_lane_width w ON w.road_id = r.road_id AND abs(w.lane_id) = 1 AND r.s >= w.s0 AND r.s < w.s1)"


@query(EDGE_POINTS + " SELECT road_id, section_id, lane_id, row, round(bx - tr * sin(hdg), 3) + 0e0 AS right_x, round(by_ + tr * cos(hdg), 3) + 0e0 AS right_y, round(bx - tl * sin(hdg), 3) + 0e0 AS left_x, round(by_ + tl * cos(hdg), 3) + 0e0 AS left_y FROM ep", "d_sections", "d_roads", "d_lane_width", roads=True)
def sf1_lane_strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strips(spark, sf_dir).select("road_id", "section_id", "lane_id", "row", *[tidy(F.col(c), 3).alias(c) for c in ("right_x", "right_y", "left_x", "left_y")])


@query(EDGE_POINTS + ", v AS (SELECT *, bx - (tr + (tl - tr) * c / 3e0) * sin(hdg) AS x FROM ep, (SELECT unnest(range(0, 4)) AS c)) SELECT road_id, section_id, lane_id, count(*) AS n_vertices, round(min(x), 3) + 0e0 AS low_x, round(max(x), 3) + 0e0 AS high_x FROM v GROUP BY road_id, section_id, lane_id", "d_sections", "d_roads", "d_lane_width", roads=True)
def sf3_tessellated_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = surface.tessellated(strips(spark, sf_dir), 4)
    return grid.groupBy("road_id", "section_id", "lane_id").agg(F.count(F.lit(1)).alias("n_vertices"), tidy(F.min("x"), 3).alias("low_x"), tidy(F.max("x"), 3).alias("high_x"))


@query(f"{ENDS}, {ROWS}, t AS (SELECT road_id, section_id, lane_id, CAST(unnest(range(0, 2 * n)) AS INT) AS tri FROM rn, (VALUES (-1), (1)) AS l(lane_id)) SELECT road_id, section_id, lane_id, tri, tri AS a, CASE WHEN tri % 2 = 0 THEN tri + 1 ELSE tri + 2 END AS b, CASE WHEN tri % 2 = 0 THEN tri + 2 ELSE tri + 1 END AS c FROM t", "d_sections", "d_roads", roads=True)
def sf14_strip_triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surface.strip_triangles(strips(spark, sf_dir)).drop("map_id")


@query(ENDS + ", k AS (SELECT road_id, section_id, s0, unnest(range(0, CAST(ceil((s1 - s0) / 2e0) AS INT))) AS k FROM ends) SELECT k.road_id, k.section_id, l.lane_id, CASE abs(l.lane_id) WHEN 1 THEN 'broken' ELSE 'solid' END AS kind, s0 + k.k * 2e0 AS s FROM k JOIN d_lanes l ON l.road_id = k.road_id AND l.section_id = k.section_id WHERE abs(l.lane_id) = 3 OR (abs(l.lane_id) = 1 AND k.k % 6 < 3)", "d_sections", "d_roads", "d_lanes", roads=True)
def sf10_lane_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    (lanes,) = derived(spark, sf_dir, "d_lanes")
    kind = F.when(F.abs("lane_id") == 1, "broken").when(F.abs("lane_id") == 3, "solid").otherwise("none")
    return surface.mark_samples(section_table(spark, sf_dir), lanes.withColumn("kind", kind), 2.0).drop("map_id")


@query("more h AS (SELECT event_id, 6e-1 * sin(35e-3 * x - 8e-2 * y + 1e3) + 11e-1 * sin(2e-2 * x + 5e-2 * y - 15e2) AS wave, sqrt((ceil(x / 17e0) * 17e0 - x) ** 2 + (floor(y / 12e0) * 12e0 - y) ** 2) AS d FROM d_pings) SELECT event_id, round(7e-1 * wave, 4) + 0e0 AS wave, round(wave + CASE WHEN d <= 2e0 THEN sin(d) * 1e-1 ELSE 0e0 END, 4) + 0e0 AS z FROM h", "d_pings")
def te7_map_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heights by formula: waves alone, scaled (TE2), and waves with bumps (TE3, TE7)."""
    (pings,) = derived(spark, sf_dir, "d_pings")
    wave = surface.wave_height(F.col("x"), F.col("y"))
    return pings.select("event_id", tidy(wave * 0.7).alias("wave"), tidy(wave + surface.bump_height(F.col("x"), F.col("y"))).alias("z"))


@query("SELECT map_id, tx, ty, i, j, half, CASE half WHEN 0 THEN i * 6 + j ELSE i * 6 + j + 1 END AS a, CASE half WHEN 0 THEN i * 6 + j + 1 ELSE i * 6 + j + 7 END AS b, i * 6 + j + 6 AS c FROM d_tiles, (SELECT CAST(unnest(range(0, 5)) AS INT) AS i), (SELECT CAST(unnest(range(0, 5)) AS INT) AS j), (SELECT CAST(unnest(range(0, 2)) AS INT) AS half)", "d_tiles")
def te6_terrain_triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surface.terrain_triangles(*derived(spark, sf_dir, "d_tiles"), 5)


@query(
    "more n AS (SELECT p.map_id, p.actor_id, p.event_id, p.ts, list(t.ty * 8 + t.tx) AS now FROM d_pings p JOIN d_tiles t ON t.map_id = p.map_id AND t.tx BETWEEN CAST(floor((x - 3e2) / 5e2) AS INT) AND CAST(floor((x + 3e2) / 5e2) AS INT) AND t.ty BETWEEN CAST(floor((y - 3e2) / 5e2) AS INT) AND CAST(floor((y + 3e2) / 5e2) AS INT) GROUP BY ALL), "
    "b AS (SELECT p.map_id, p.actor_id, p.event_id, coalesce(now, []) AS now, coalesce(lag(coalesce(now, [])) OVER (PARTITION BY p.map_id, p.actor_id ORDER BY p.ts, p.event_id), []) AS before FROM d_pings p LEFT JOIN n ON n.event_id = p.event_id) "
    "SELECT actor_id, event_id, len(now) - len(list_intersect(now, before)) AS n_loads, len(before) - len(list_intersect(now, before)) AS n_unloads FROM b",
    "d_pings", "d_tiles",
)
def st2_tile_residency(spark: SparkSession, sf_dir: str) -> DataFrame:
    pings, grid = derived(spark, sf_dir, "d_pings", "d_tiles")
    out = tiles.residency(pings, grid, 500.0, 300.0)
    return out.select("actor_id", "event_id", F.size("loads").cast("long").alias("n_loads"), F.size("unloads").cast("long").alias("n_unloads"))
