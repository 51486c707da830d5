"""Registered queries of points, filters, scalar functions and linked lanes over the derived tables, each with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.functions import geo, scalar
from roadlake.functions.scalar import Rot, Vec, tidy
from roadlake.operators import asof, generate, graph
from roadlake.operators.signals import is_traffic_light
from roadlake.plans.derived import derived
from roadlake.plans.road_queries import AHEAD, CONFLICTS, EDGES, QUERIES, edges, query

OWN = "map_id, road_id, section_id, lane_id"

LINKED = """more l AS MATERIALIZED (SELECT v.*, s.s0, CASE WHEN v.lane_id <= 0 THEN v.succ ELSE v.pred END AS link, max(s.s0) OVER (PARTITION BY v.map_id, v.road_id) AS held_last
  FROM v_lanes v JOIN v_sections s ON s.map_id = v.map_id AND s.road_id = v.road_id AND s.section_id = v.section_id),
mx AS MATERIALIZED (SELECT map_id, road_id, max(s0) AS last FROM v_sections GROUP BY map_id, road_id),
own AS MATERIALIZED (SELECT l.*, CASE WHEN l.lane_id <= 0 THEN l.s0 < mx.last ELSE l.s0 > 0 END AS mid FROM l JOIN mx ON mx.map_id = l.map_id AND mx.road_id = l.road_id),
ex AS MATERIALIZED (SELECT map_id, road_id, lane_id, CASE WHEN lane_id <= 0 THEN min_by(section_id, s0) ELSE max_by(section_id, s0) END AS edge FROM l GROUP BY map_id, road_id, lane_id),
inside AS (SELECT o.map_id, o.road_id, o.section_id, o.lane_id, o.road_id AS next_road, min_by(n.section_id, abs(n.s0 - o.s0)) AS next_section, o.link AS next_lane FROM own o
  JOIN l n ON n.map_id = o.map_id AND n.road_id = o.road_id AND n.lane_id = o.link WHERE o.mid AND o.link <> 0 AND ((o.lane_id <= 0 AND n.s0 > o.s0) OR (o.lane_id > 0 AND n.s0 < o.s0)) GROUP BY ALL),
fin AS MATERIALIZED (SELECT o.map_id, o.road_id, o.section_id, o.lane_id, o.link, CASE WHEN o.lane_id <= 0 THEN r.succ ELSE r.pred END AS target FROM own o JOIN v_roads r ON r.map_id = o.map_id AND r.road_id = o.road_id WHERE NOT o.mid),
across AS (SELECT f.map_id, f.road_id, f.section_id, f.lane_id, f.target AS next_road, ex.edge AS next_section, f.link AS next_lane FROM fin f JOIN ex ON ex.map_id = f.map_id AND ex.road_id = f.target AND ex.lane_id = f.link WHERE f.link <> 0),
turns AS (SELECT f.map_id, f.road_id, f.section_id, f.lane_id, c.connecting_road AS next_road, ex.edge AS next_section, c.link_to AS next_lane FROM fin f LEFT JOIN v_roads k ON k.map_id = f.map_id AND k.road_id = f.target
  JOIN v_connections c ON c.map_id = f.map_id AND c.junction_id = f.target AND c.incoming_road = f.road_id AND c.link_from = f.lane_id JOIN ex ON ex.map_id = f.map_id AND ex.road_id = c.connecting_road AND ex.lane_id = c.link_to WHERE k.road_id IS NULL),
ed AS MATERIALIZED (SELECT * FROM inside UNION ALL SELECT * FROM across UNION ALL SELECT * FROM turns)"""
NETWORK = ("v_roads", "v_sections", "v_lanes", "v_connections")


def network_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.lane_edges(*derived(spark, sf_dir, *NETWORK))


@query(f"{LINKED} SELECT {OWN}, next_road, next_section, next_lane FROM ed", *NETWORK, roads=True)
def jg1_linked_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lane edges of two maps with the same road ids, changing and missing links, roads head to head and junctions."""
    return network_edges(spark, sf_dir)


@query(f"{LINKED} SELECT DISTINCT map_id, road_id, next_road FROM ed WHERE road_id <> next_road", *NETWORK, roads=True)
def jg4_linked_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.road_neighbours(network_edges(spark, sf_dir))


@query(f"{LINKED} SELECT l.map_id, l.road_id, l.section_id, l.lane_id, coalesce(ed.next_road, l.road_id) AS next_road, coalesce(ed.next_section, l.section_id) AS next_section, coalesce(ed.next_lane, l.lane_id) AS next_lane FROM l LEFT JOIN ed ON ed.map_id = l.map_id AND ed.road_id = l.road_id AND ed.section_id = l.section_id AND ed.lane_id = l.lane_id", *NETWORK, roads=True)
def jg9_linked_topology(spark: SparkSession, sf_dir: str) -> DataFrame:
    (lanes,) = derived(spark, sf_dir, "v_lanes")
    return graph.topology(network_edges(spark, sf_dir), lanes)


@query("SELECT s.map_id, s.road_id, s.section_id, s.s0, coalesce(lead(s.s0) OVER (PARTITION BY s.map_id, s.road_id ORDER BY s.s0), r.length) AS s1 FROM v_sections s JOIN v_roads r ON r.map_id = s.map_id AND r.road_id = s.road_id", "v_sections", "v_roads")
def ao6_section_ends_of_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.section_ends(*derived(spark, sf_dir, "v_sections", "v_roads")).select("map_id", "road_id", "section_id", "s0", "s1")


@query("SELECT l.map_id, l.road_id, l.lane_id, min_by(l.section_id, s.s0) AS first_section, max_by(l.section_id, s.s0) AS last_section FROM v_lanes l JOIN v_sections s ON s.map_id = l.map_id AND s.road_id = l.road_id AND s.section_id = l.section_id GROUP BY ALL", "v_lanes", "v_sections")
def jg3_edge_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections, lanes = derived(spark, sf_dir, "v_sections", "v_lanes")
    return asof.lane_extent(sections, lanes)


@query("more o AS (SELECT *, lane_id + CAST(sign(lane_id) AS INT) AS r, CASE WHEN abs(lane_id) = 1 THEN -lane_id ELSE lane_id - CAST(sign(lane_id) AS INT) END AS f, list(lane_id) OVER (PARTITION BY map_id, road_id, section_id) AS held FROM v_lanes) SELECT map_id, road_id, section_id, lane_id, CASE WHEN list_contains(held, r) THEN r END AS right_lane, CASE WHEN list_contains(held, f) THEN f END AS left_lane FROM o", "v_lanes", roads=True)
def jg8_side_lanes_of_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.side_lanes(*derived(spark, sf_dir, "v_lanes"))


@query("SELECT l.map_id, l.road_id, l.section_id, l.lane_id, l.type FROM d_lanes l JOIN (SELECT road_id, min(section_id) AS f FROM d_sections GROUP BY road_id) s ON s.road_id = l.road_id AND s.f = l.section_id WHERE l.lane_id = -1", "d_lanes", "d_sections")
def pf1_lane_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lane types of the waypoints where right lanes begin."""
    roads, sections, lanes = derived(spark, sf_dir, "d_roads", "d_sections", "d_lanes")
    key = ["map_id", "road_id", "section_id", "lane_id"]
    return generate.road_entries(roads, sections, lanes).filter("lane_id < 0").join(lanes.select(*key, "type"), key).select(*key, "type")


@query("SELECT map_id, road_id, junction_id, junction_id <> -1 AS is_junction FROM d_roads", "d_roads")
def pf2_junctions_of_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    (roads,) = derived(spark, sf_dir, "d_roads")
    return roads.select("map_id", "road_id", "junction_id", (F.col("junction_id") != -1).alias("is_junction"))


@query(f"SELECT {OWN} FROM d_lanes WHERE (type_mask & 304) <> 0", "d_lanes")
def pf5_lanes_of_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parking, biking and sidewalk lanes."""
    (lanes,) = derived(spark, sf_dir, "d_lanes")
    return lanes.filter(scalar.of_lane_type(F.col("type_mask"), 256 | 32 | 16)).select("map_id", "road_id", "section_id", "lane_id")


AT_MIDDLE = "ends AS (SELECT s.map_id, s.road_id, s.section_id, s.s0, coalesce(lead(s.s0) OVER (PARTITION BY s.map_id, s.road_id ORDER BY s.s0), r.length) AS s1, r.length FROM v_sections s JOIN v_roads r ON r.map_id = s.map_id AND r.road_id = s.road_id), mid AS (SELECT map_id, road_id, section_id, length / 2 AS s FROM ends WHERE length / 2 >= s0 AND length / 2 < s1)"


def at_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    roads, sections = derived(spark, sf_dir, "v_roads", "v_sections")
    ends = asof.section_ends(sections, roads).select("map_id", "road_id", "section_id", "s0", "s1")
    return asof.as_of(roads.select("map_id", "road_id", (F.col("length") / 2).alias("s")), ends, ["map_id", "road_id"], "inner").select("map_id", "road_id", "section_id", "s")


@query(f"more {AT_MIDDLE} SELECT mid.map_id, mid.road_id, mid.section_id, l.lane_id IS NOT NULL AS present, l.type_mask FROM mid LEFT JOIN v_lanes l ON l.map_id = mid.map_id AND l.road_id = mid.road_id AND l.section_id = mid.section_id AND l.lane_id = -3", "v_roads", "v_sections", "v_lanes")
def pf7_third_lane_at_the_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lane -3 at the middle of each road, where there is one."""
    (lanes,) = derived(spark, sf_dir, "v_lanes")
    own = lanes.filter("lane_id = -3").select("map_id", "road_id", "section_id", "type_mask", F.lit(True).alias("there"))
    return at_middle(spark, sf_dir).join(own, ["map_id", "road_id", "section_id"], "left").select("map_id", "road_id", "section_id", F.coalesce("there", F.lit(False)).alias("present"), "type_mask")


@query(f"more {AT_MIDDLE} SELECT mid.map_id, mid.road_id, mid.section_id FROM mid SEMI JOIN v_lanes l ON l.map_id = mid.map_id AND l.road_id = mid.road_id AND l.section_id = mid.section_id AND l.lane_id = 3", "v_roads", "v_sections", "v_lanes")
def pf8_lane_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    (lanes,) = derived(spark, sf_dir, "v_lanes")
    return at_middle(spark, sf_dir).join(lanes.filter("lane_id = 3"), ["map_id", "road_id", "section_id"], "left_semi").select("map_id", "road_id", "section_id")


@query("SELECT map_id, road_id, signal_id, s, t, type, orientation FROM d_signal_refs", "d_signal_refs")
def pf10_signal_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    (refs,) = derived(spark, sf_dir, "d_signal_refs")
    return refs.select("map_id", "road_id", "signal_id", "s", "t", "type", "orientation")


@query("SELECT map_id, signal_id, road_id, s FROM d_signal_refs WHERE type = '206'", "d_signal_refs")
def pf11_landmarks_of_a_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    (refs,) = derived(spark, sf_dir, "d_signal_refs")
    return refs.filter("type = '206'").select("map_id", "signal_id", "road_id", "s")


@query("SELECT signal_id, type IN ('1000001', 'F', 'W', 'A') AS light, CASE orientation WHEN '+' THEN 'positive' WHEN '-' THEN 'negative' ELSE 'both' END AS side FROM d_signal_refs", "d_signal_refs")
def sc24_traffic_lights(spark: SparkSession, sf_dir: str) -> DataFrame:
    (refs,) = derived(spark, sf_dir, "d_signal_refs")
    return refs.select("signal_id", is_traffic_light(F.col("type")).alias("light"), scalar.signal_side(F.col("orientation")).alias("side"))


@query("SELECT map_id, road_id, seq, s0, s1, length FROM d_geometry", "d_geometry")
def ao2_plan_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    (g,) = derived(spark, sf_dir, "d_geometry")
    return g.select("map_id", "road_id", "seq", "s0", "s1", "length")


@query("more p AS (SELECT map_id, road_id, lane_id, length / 2 AS s FROM d_roads CROSS JOIN (VALUES (-2), (4)) AS t(lane_id)) SELECT p.map_id, p.road_id, p.lane_id, round(coalesce(w.a + (p.s - w.s0) * w.b, 0e0), 6) + 0e0 AS width FROM p LEFT JOIN d_lane_width w ON w.map_id = p.map_id AND w.road_id = p.road_id AND w.lane_id = p.lane_id AND p.s >= w.s0 AND p.s < w.s1", "d_roads", "d_lane_width")
def ao9_lane_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Widths at the middle of each road of a lane that it has and of one that it has not (0)."""
    roads, widths = derived(spark, sf_dir, "d_roads", "d_lane_width")
    points = roads.select("map_id", "road_id", F.explode(F.array(F.lit(-2), F.lit(4))).alias("lane_id"), (F.col("length") / 2).alias("s"))
    return asof.lane_width_at(points, widths).select("map_id", "road_id", "lane_id", tidy(F.col("width"), 6).alias("width"))


@query("more e AS (SELECT map_id, road_id, min(section_id) AS f, max(section_id) AS z FROM d_sections GROUP BY map_id, road_id) SELECT l.road_id, l.section_id, l.lane_id, CASE WHEN l.lane_id < 0 THEN 0e0 ELSE CAST(r.length AS DOUBLE) END AS s FROM d_lanes l JOIN e ON e.map_id = l.map_id AND e.road_id = l.road_id JOIN d_roads r ON r.map_id = l.map_id AND r.road_id = l.road_id WHERE r.name = '1-URGENT' AND (l.type_mask & 2) <> 0 AND ((l.lane_id < 0 AND l.section_id = e.f) OR (l.lane_id > 0 AND l.section_id = e.z))", "d_sections", "d_roads", "d_lanes")
def wg3_entries_of_named_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    roads, sections, lanes = derived(spark, sf_dir, "d_roads", "d_sections", "d_lanes")
    return generate.road_entries(roads.filter("name = '1-URGENT'"), sections, lanes).select("road_id", "section_id", "lane_id", F.col("s").cast("double").alias("s"))


@query(f"more {AT_MIDDLE} SELECT mid.map_id, mid.road_id, mid.section_id, l.lane_id, round(CASE WHEN l.lane_id <= 0 THEN e.s1 - mid.s ELSE mid.s - e.s0 END, 6) + 0e0 AS remaining FROM mid JOIN ends e ON e.map_id = mid.map_id AND e.road_id = mid.road_id AND e.section_id = mid.section_id JOIN v_lanes l ON l.map_id = mid.map_id AND l.road_id = mid.road_id AND l.section_id = mid.section_id", "v_roads", "v_sections", "v_lanes", roads=True)
def wg9_remaining_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    roads, sections, lanes = derived(spark, sf_dir, "v_roads", "v_sections", "v_lanes")
    starts = generate.lane_starts(roads, sections, lanes)
    key = ["map_id", "road_id", "section_id"]
    return at_middle(spark, sf_dir).join(starts, key).select(*key, "lane_id", tidy(F.abs(F.col("s_end") - F.col("s")), 6).alias("remaining"))


@query("SELECT l.road_id, l.section_id, l.lane_id, r.junction_id FROM d_lanes l JOIN d_roads r ON r.map_id = l.map_id AND r.road_id = l.road_id WHERE r.junction_id <> -1", "d_lanes", "d_roads")
def jg18_junctions_of_waypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    roads, lanes = derived(spark, sf_dir, "d_roads", "d_lanes")
    return lanes.join(roads.filter("junction_id <> -1").select("map_id", "road_id", "junction_id"), ["map_id", "road_id"]).select("road_id", "section_id", "lane_id", "junction_id")


@query(CONFLICTS.replace("SELECT map_id, junction_id, ra AS road_id, rb AS other_road FROM g UNION ALL SELECT map_id, junction_id, rb, ra FROM g", "SELECT r.map_id, r.road_id FROM d_roads r SEMI JOIN (SELECT map_id, ra AS road_id FROM g UNION ALL SELECT map_id, rb FROM g) c ON c.map_id = r.map_id AND c.road_id = r.road_id"), "d_geometry", "d_lane_width", "d_roads", roads=True)
def sp9_roads_with_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    (roads,) = derived(spark, sf_dir, "d_roads")
    return roads.join(QUERIES["sp8_junction_conflicts"](spark, sf_dir), ["map_id", "road_id"], "left_semi").select("map_id", "road_id")


@query("SELECT map_id, type, round(avg(s), 6) + 0e0 AS s, round(avg(t), 6) + 0e0 AS t, count(*) AS n FROM d_signal_refs GROUP BY map_id, type", "d_signal_refs")
def ag5_centres_of_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    (refs,) = derived(spark, sf_dir, "d_signal_refs")
    return refs.groupBy("map_id", "type").agg(tidy(F.avg("s"), 6).alias("s"), tidy(F.avg("t"), 6).alias("t"), F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, (CAST(floor(x / 5e2) AS BIGINT) - 4) * 5e2 AS ox, (CAST(floor(y / 5e2) AS BIGINT) - 4) * 5e2 AS oy FROM d_pings", "d_pings")
def ag7_tile_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Origins of tiles from their packed ids."""
    (pings,) = derived(spark, sf_dir, "d_pings")
    tx, ty = scalar.tile_unpack(scalar.tile_pack(F.floor(F.col("x") / 500.0) - 4, F.floor(F.col("y") / 500.0) - 4))
    return pings.select("event_id", (tx * 500.0).alias("ox"), (ty * 500.0).alias("oy"))


GEO = "more k AS (SELECT event_id, 4e1 + map_id AS lat, 2e0 + map_id / 1e1 AS lon, x, y FROM d_pings), m AS (SELECT *, cos(radians(lat)) AS sc FROM k), f AS (SELECT *, sc * radians(lon) * 6378137e0 AS mx, sc * 6378137e0 * ln(tan(radians(9e1 + lat) / 2e0)) AS my FROM m)"


@query(f"{GEO} SELECT event_id, round(sc, 10) AS scale, round(mx, 4) AS mx, round(my, 4) AS my FROM f", "d_pings")
def ge2_mercator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale and Mercator place of each ping's map origin (40 degrees and one for each map number)."""
    (pings,) = derived(spark, sf_dir, "d_pings")
    lat, lon = 40.0 + F.col("map_id"), 2.0 + F.col("map_id") / 10.0
    scale = geo.latitude_scale(lat)
    x, y = geo.mercator(lat, lon, scale)
    return pings.select("event_id", F.round(scale, 10).alias("scale"), F.round(x, 4).alias("mx"), F.round(y, 4).alias("my"))


@query(f"{GEO} SELECT event_id, round(degrees(2e0 * atan(exp((my - y) / (6378137e0 * sc)))) - 9e1, 8) AS lat, round(degrees((mx + x) / (6378137e0 * sc)), 8) AS lon FROM f", "d_pings")
def ge5_local_to_geo_by_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings georeferenced by the header row of their own map (GE5), by adding metres (GE6)."""
    (pings,) = derived(spark, sf_dir, "d_pings")
    header = pings.select("map_id").distinct().select("map_id", (40.0 + F.col("map_id")).alias("lat0"), (2.0 + F.col("map_id") / 10.0).alias("lon0"))
    lat, lon, _ = geo.local_to_geo(F.col("lat0"), F.col("lon0"), F.lit(0.0), F.col("x"), F.col("y"), F.col("z"))
    return pings.join(header, "map_id").select("event_id", F.round(lat, 8).alias("lat"), F.round(lon, 8).alias("lon"))


@query("SELECT road_id, seq, round(l_tax + 2e0 * (length * (l_discount + length * (l_tax / 1e1 + length * 1e-3))), 6) + 0e0 AS value, round(l_discount + length * (2e0 * l_tax / 1e1 + 3e0 * 1e-3 * length), 6) + 0e0 AS slope FROM d_geometry".replace("l_tax + 2e0 * (length * (l_discount + length * (l_tax / 1e1 + length * 1e-3)))", "2e0 * (l_tax + length * (l_discount + length * (l_tax / 1e1 + length * 1e-3)))"), "d_geometry")
def sc2_polynomials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twice a cubic (SC1, SC3) and the cubic's tangent (SC2) at each record's length."""
    (g,) = derived(spark, sf_dir, "d_geometry")
    p = [F.col("l_tax"), F.col("l_discount"), F.col("l_tax") / 10.0, F.lit(1e-3)]
    return g.select("road_id", "seq", tidy(scalar.poly_eval(*scalar.poly_add(p, p), F.col("length")), 6).alias("value"), tidy(scalar.poly_tangent(*p[1:], F.col("length")), 6).alias("slope"))


@query("SELECT event_id, round(x * 3e0 - y * 2e0, 6) + 0e0 AS dot, round(sqrt((x - 1e3) ** 2 + (y - 1e3) ** 2), 6) AS distance, round(acos(greatest(-1e0, least(1e0, x / sqrt(x * x + y * y)))), 8) + 0e0 AS angle, round(least(3e3, greatest(1e3, x)), 6) + 0e0 AS held, round(x + (y - x) * 25e-2, 8) + 0e0 AS between_ FROM d_pings WHERE x * x + y * y > 0", "d_pings")
def sc5_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dot product, distance, angle, clamp and interpolation (SC4 to SC7)."""
    (pings,) = derived(spark, sf_dir, "d_pings")
    x, y, zero = F.col("x"), F.col("y"), F.lit(0.0)
    return pings.filter(x * x + y * y > 0).select(
        "event_id", tidy(scalar.dot2(x, y, F.lit(3.0), F.lit(-2.0)), 6).alias("dot"), F.round(scalar.dist2d(x, y, F.lit(1e3), F.lit(1e3)), 6).alias("distance"),
        tidy(scalar.vector_angle(Vec(x, y, zero), Vec(F.lit(1.0), zero, zero)), 8).alias("angle"), tidy(scalar.clamp(x, 1e3, 3e3), 6).alias("held"), tidy(scalar.lerp(x, y, 0.25), 8).alias("between_"),
    )


@query("SELECT event_id, round(x * cos(radians(yaw)) - y * sin(radians(yaw)), 6) + 0e0 AS rx, round(x * sin(radians(yaw)) + y * cos(radians(yaw)), 6) + 0e0 AS ry, round(cos(radians(yaw)), 8) + 0e0 AS fx, round(-sin(radians(yaw)), 8) + 0e0 AS sx, round((x - 5e1) * cos(radians(yaw)) + (y - 7e1) * sin(radians(yaw)), 6) + 0e0 AS lx, round(-(x - 5e1) * sin(radians(yaw)) + (y - 7e1) * cos(radians(yaw)), 6) + 0e0 AS ly FROM d_pings", "d_pings")
def sc12_rotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rotated points, forward and right vectors, and points in the frame of a place (SC10 to SC13)."""
    (pings,) = derived(spark, sf_dir, "d_pings")
    zero = F.lit(0.0)
    turn = Rot(zero, F.col("yaw"), zero)
    p = Vec(F.col("x"), F.col("y"), zero)
    turned, local = scalar.rotate(p, turn), scalar.inverse_transform_point(p, Vec(F.lit(50.0), F.lit(70.0), zero), turn)
    return pings.select(
        "event_id", tidy(turned.x, 6).alias("rx"), tidy(turned.y, 6).alias("ry"), tidy(scalar.forward(turn).x, 8).alias("fx"), tidy(scalar.right(turn).x, 8).alias("sx"), tidy(local.x, 6).alias("lx"), tidy(local.y, 6).alias("ly"),
    )


@query("more b AS (SELECT event_id, (x - 2e3) * cos(radians(yaw)) + (y - 2e3) * sin(radians(yaw)) AS lx, -(x - 2e3) * sin(radians(yaw)) + (y - 2e3) * cos(radians(yaw)) AS ly FROM d_pings) SELECT event_id, abs(lx) <= 15e2 AND abs(ly) <= 5e2 AS inside FROM b", "d_pings")
def pf12_points_in_turned_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a ping lies in a box of 3,000 by 1,000 m around (2000, 2000) that is turned by the ping's own yaw."""
    (pings,) = derived(spark, sf_dir, "d_pings")
    zero = F.lit(0.0)
    local = scalar.inverse_transform_point(Vec(F.col("x"), F.col("y"), zero), Vec(F.lit(2000.0), F.lit(2000.0), zero), Rot(zero, F.col("yaw"), zero))
    return pings.select("event_id", (local.x.between(-1500.0, 1500.0) & local.y.between(-500.0, 500.0)).alias("inside"))


BEHIND = (
    AHEAD.replace("<= 0", "> 0")
    .replace("CASE WHEN l.lane_id < 0 THEN 0e0", "CASE WHEN l.lane_id > 0 THEN 0e0")
    .replace("(l.lane_id < 0 AND l.section_id = z.f) OR (l.lane_id > 0 AND l.section_id = z.z)", "(l.lane_id > 0 AND l.section_id = z.f) OR (l.lane_id < 0 AND l.section_id = z.z)")
    .replace("(SELECT * FROM ed)", "(SELECT next_road AS road_id, next_section AS section_id, next_lane AS lane_id, road_id AS next_road, section_id AS next_section, lane_id AS next_lane FROM ed)")
)


@query(f"{EDGES}, {BEHIND}", "d_roads", "d_sections", "d_lanes", roads=True)
def jg7_waypoints_behind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waypoints 60 m behind the places where traffic leaves a road."""
    roads, sections, lanes = derived(spark, sf_dir, "d_roads", "d_sections", "d_lanes")
    span = asof.lane_extent(sections, lanes).select("map_id", "road_id", "lane_id", "first_section", "last_section")
    own = lanes.filter(scalar.of_lane_type(F.col("type_mask"), 2)).join(span, ["map_id", "road_id", "lane_id"])
    own = own.filter(F.col("section_id") == F.when(F.col("lane_id") > 0, F.col("first_section")).otherwise(F.col("last_section"))).join(roads.select("map_id", "road_id", "length"), ["map_id", "road_id"])
    exits = own.select(F.concat_ws("_", "road_id", "lane_id").alias("id"), "map_id", "road_id", "section_id", "lane_id", F.when(F.col("lane_id") > 0, 0.0).otherwise(F.col("length")).alias("s"))
    back = graph.reverse_edges(edges(spark, sf_dir))
    return graph.advance(exits, back, roads, sections, 60.0, back=True).select("id", "road_id", "section_id", "lane_id", tidy(F.col("s")).alias("s"))


@query("SELECT g.map_id, g.signal_id, r.junction_id AS controller_id, r.junction_id IS NULL AS unresolved FROM d_signal_refs g LEFT JOIN d_roads r ON r.map_id = g.map_id AND r.road_id = g.road_id AND r.junction_id <> -1", "d_signal_refs", "d_roads")
def jg15_resolved_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signal references with the controller of their junction; references without one are reported as unresolved."""
    refs, roads = derived(spark, sf_dir, "d_signal_refs", "d_roads")
    controllers = roads.filter("junction_id <> -1").select("map_id", "road_id", F.col("junction_id").alias("controller_id"))
    return refs.join(controllers, ["map_id", "road_id"], "left").select("map_id", "signal_id", "controller_id", F.col("controller_id").isNull().alias("unresolved"))
