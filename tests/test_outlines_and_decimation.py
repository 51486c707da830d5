"""Crosswalk rings and decimated meshes against loops."""

import collections
import math

import numpy as np

from roadlake.operators import crosswalks, decimate, signals
from roadlake.plans import outline_queries, road_queries

SF = "/root/testdata/sf0.001"

GEOMETRY = "map_id int, road_id long, s0 double, s1 double, length double, x double, y double, hdg double, kind string, k0 double, k1 double, " + ", ".join(f"{a}{c} double" for a in "uv" for c in "abcd") + ", by_length boolean"
RECORDS = "map_id int, road_id long, s0 double, s1 double, a double, b double, c double, d double"
WALKS = "map_id int, road_id long, object_id string, s double, t double, hdg double, corners array<struct<u: double, v: double, z: double>>"


def rings_by_loop(corners):
    """Rings of one outline, as lists of corners; an open rest is none."""
    out, own = [], []
    for c in corners:
        if own and c == own[0]:
            out.append(own)
            own = []
        else:
            own.append(c)
    return out


SQUARE = [(-2.0, -1.0, 0.0), (2.0, -1.0, 0.0), (2.0, 1.0, 0.1), (-2.0, 1.0, 0.0), (-2.0, -1.0, 0.0)]
THREE = [(0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (0.0, 3.0, 0.0), (0.0, 0.0, 0.0)]


def test_rings_come_apart(spark):
    outlines = {
        "two": SQUARE + THREE,
        "open": SQUARE + THREE[:3],
        "only_open": THREE[:3],
        "twins": [(1.0, 1.0, 0.0), (1.0, 1.0, 0.0)] + THREE,  # a ring of one corner is passed over, but numbered
        "inner": [(0.0, 0.0, 0.0), (5.0, 0.0, 0.0), (5.0, 5.0, 0.0), (5.0, 0.0, 0.0), (0.0, 0.0, 0.0)],  # only the first corner closes
        "nulls": [(None, 1.0, 0.0), None, (2.0, 0.0, 0.0), (0.0, 2.0, 0.0), (None, 1.0, 0.0)],
        "empty": [],
        "none": None,
    }
    walks = spark.createDataFrame([(0, 1, k, 5.0, 0.0, 0.0, c) for k, c in outlines.items()], WALKS)
    got = collections.defaultdict(dict)
    for r in crosswalks.crosswalk_rings(walks).collect():
        got[r.object_id][r.ring] = [tuple(c) for c in r.corners[r.first : r.last + 1]]
    for k, c in outlines.items():
        made = rings_by_loop([x for x in c or [] if x is not None])
        assert got[k] == {i: ring for i, ring in enumerate(made) if len(ring) > 2}, k
    assert len(got["two"]) == 2 and got["twins"].keys() == {1}
    assert crosswalks.crosswalk_rings(walks.limit(0)).count() == 0


def test_corners_of_a_turned_crosswalk(spark):
    """On a road to the north-east that climbs, with a lane offset: the corners by hand."""
    heading, turn, t, s, slope = 0.6, 0.3, 1.5, 40.0, 0.05
    geometry = spark.createDataFrame([(0, 1, 0.0, 100.0, 100.0, 10.0, 20.0, heading, "line", 0.0, 0.0, *[0.0] * 8, False)], GEOMETRY)
    elevation = spark.createDataFrame([(0, 1, 0.0, 100.0, 2.0, slope, 0.0, 0.0)], RECORDS)
    offsets = spark.createDataFrame([(0, 1, 0.0, 100.0, 0.7, 0.0, 0.0, 0.0)], RECORDS)
    widths = spark.createDataFrame([], "map_id int, road_id long, lane_id int, s0 double, s1 double, a double, b double, c double, d double")
    rows = [(0, 1, "w", s, t, turn, SQUARE), (0, 1, "v", s, None, None, THREE), (0, 2, "lost", s, t, turn, SQUARE), (0, 1, "nowhere", None, t, turn, SQUARE), (0, 1, None, s, t, turn, SQUARE)]
    got = crosswalks.crosswalk_corners(spark.createDataFrame(rows, WALKS), widths, geometry, offsets, elevation).collect()
    assert {(r.object_id, r.vertex) for r in got} == {("w", i) for i in range(4)} | {(None, i) for i in range(4)} | {("v", i) for i in range(3)}

    x0, y0, z0 = 10 + s * math.cos(heading) - 0.7 * math.sin(heading), 20 + s * math.sin(heading) + 0.7 * math.cos(heading), 2 + slope * s
    for r in got:
        own_turn, across, corners = (0.0, 0.0, THREE) if r.object_id == "v" else (turn, t, SQUARE)
        h = heading + own_turn
        px, py, pz = x0 - across * math.cos(slope) * math.sin(h), y0 + across * math.cos(slope) * math.cos(h), z0 + across * math.sin(slope)
        u, v, z = corners[r.vertex]
        u += -1 if u < 0 else 1
        flat, rise = u * math.cos(slope) - z * math.sin(slope), u * math.sin(slope) + z * math.cos(slope)
        want = px + flat * math.cos(h) + v * math.sin(h), -(py + flat * math.sin(h) - v * math.cos(h)), pz + rise
        assert math.dist(want, (r.x, r.y, r.z)) < 1e-9, (r, want)


def test_fans(spark):
    corners = spark.createDataFrame([("a", i) for i in range(5)] + [("b", i) for i in range(2)] + [("c", i) for i in range(3)], "ring string, vertex int")
    got = sorted((r.ring, r.tri, r.a, r.b, r.c) for r in crosswalks.fan_triangles(corners, ["ring"]).collect())
    assert got == [("a", 0, 0, 1, 2), ("a", 1, 0, 2, 3), ("a", 2, 0, 3, 4), ("c", 0, 0, 1, 2)]


def decimated_by_loop(points, faces, ratio):
    """One mesh: {cell: place}, faces as cells, by trying one level after another."""
    low = [min(p[i] for p in points.values()) for i in range(3)]
    fine = max(max(p[i] for p in points.values()) - low[i] for i in range(3)) / 2**decimate.BITS
    own = {v: tuple(min(int((p[i] - low[i]) // fine), 2**decimate.BITS - 1) for i in range(3)) for v, p in points.items()}
    for level in range(decimate.BITS + 1):
        cell = {v: tuple(k >> level for k in c) for v, c in own.items()}
        left = [f for f in faces if all(v in cell for v in f) and len({cell[v] for v in f}) == 3]
        if len(left) <= math.floor(len(faces) * ratio):
            break
    turned = lambda f: min((f, f[1:] + f[:1], f[2:] + f[:2]))
    made = {turned(tuple(cell[v] for v in f)) for f in left}
    planes = collections.defaultdict(list)
    for f in (f for f in faces if all(v in cell for v in f)):
        p = [np.array(points[v]) for v in f]
        n = np.cross(p[1] - p[0], p[2] - p[0])
        if np.linalg.norm(n) > 0:
            for v in f:
                planes[cell[v]].append((n / np.linalg.norm(n), np.linalg.norm(n), np.array(points[v])))
    places = {}
    for c in {c for f in made for c in f}:
        held = np.array([points[v] for v in points if cell[v] == c])
        mean = held.mean(axis=0)
        a, b = np.zeros((3, 3)), np.zeros(3)
        for n, w, p in planes[c]:
            a, b = a + w * np.outer(n, n), b + w * n * (n @ (p - mean))
        x = mean + np.linalg.solve(a + decimate.PULL * np.trace(a) * np.eye(3), b)
        places[c] = tuple(np.clip(x, held.min(axis=0), held.max(axis=0)))
    return places, made


def height(i, j):
    return 0.8 * math.sin(i / 3) + (2.0 if j > 7 else 0.0)


def test_decimation(spark):
    n = 15
    points = {(m, i * n + j): (1000.0 + i, 5.0 + j + 0.01 * i, height(i, j) if m else 0.3 * i) for m in (0, 1) for i in range(n) for j in range(n)}
    faces = [(m, *f) for m in (0, 1) for i in range(n - 1) for j in range(n - 1) for v in [i * n + j] for f in ((v, v + 1, v + n), (v + 1, v + n + 1, v + n))]
    odd_points = [(0, None, 1, 0.0, 0.0, 0.0), (0, 0, 900, float("nan"), 0.0, 0.0), (0, 0, 901, None, 0.0, 0.0), (0, 0, 902, 3.0, float("inf"), 0.0), (0, 2, 0, 1.0, 1.0, 1.0), (0, 2, 1, 1.0, 1.0, 1.0), (0, 2, 2, 1.0, 1.0, 1.0)]
    odd_faces = [(0, 0, 9000 + k, *f) for k, f in enumerate([(0, 1, 900), (0, 1, 901), (0, 902, 1), (0, 1, 777), (0, 0, 1)])] + [(0, 2, 0, 0, 1, 2), (0, None, 0, 0, 1, 2), (0, 3, 0, 0, 1, 2)]
    vertices = spark.createDataFrame([(0, m, v, *p) for (m, v), p in points.items()] + odd_points, "map_id int, mesh_id long, vertex int, x double, y double, z double")
    triangles = spark.createDataFrame([(0, f[0], k, *f[1:]) for k, f in enumerate(faces)] + odd_faces, "map_id int, mesh_id long, tri int, a int, b int, c int")
    for ratio in (1.0, 0.3):
        got_points, got_faces = (d.collect() for d in decimate.decimate(vertices, triangles, ratio))
        assert {r.mesh_id for r in got_points} == {0, 1}
        for m in (0, 1):
            own = [f[1:] for f in faces if f[0] == m] + [f[3:] for f in odd_faces if f[1] == m]
            places, made = decimated_by_loop({v: p for (k, v), p in points.items() if k == m}, own, ratio)
            at = {r.vertex: (r.x, r.y, r.z) for r in got_points if r.mesh_id == m}
            assert sorted(at) == list(range(len(places)))
            key = lambda p: tuple(round(c, 5) for c in p)
            assert np.allclose(sorted(at.values(), key=key), sorted(places.values(), key=key), atol=1e-6)
            close = {v: min(places, key=lambda c: math.dist(places[c], p)) for v, p in at.items()}
            assert len(set(close.values())) == len(close)
            turned = lambda f: min((f, f[1:] + f[:1], f[2:] + f[:2]))
            ours = [turned(tuple(close[v] for v in (r.a, r.b, r.c))) for r in got_faces if r.mesh_id == m]
            assert len(set(ours)) == len(ours) <= ratio * len(own) and set(ours) == made
    assert all(d.count() == 0 for d in decimate.decimate(vertices.limit(0), triangles.limit(0), 0.5))
    assert all(d.count() == 0 for d in decimate.decimate(vertices, triangles, 0.001))


def test_decimation_joins_no_triangle_with_its_corners_but_those_left(spark, monkeypatch):
    met = []
    monkeypatch.setattr(decimate, "with_corners", lambda triangles, *rest, f=decimate.with_corners: met.append(triangles.count()) or f(triangles, *rest))
    n = road_queries.QUERIES["sf24_decimated_strips"](spark, SF).count()
    assert met == [n] and 0 < n <= outline_queries.RATIO * 2 * spark.read.parquet(f"{SF}/lineitem.parquet").count()


def test_references_for_lane_zero_go(spark):
    refs = spark.createDataFrame([(k, k) for k in (1, 2, 3, 4, 4, None)], "ref_id int, other int")
    validities = spark.createDataFrame([(1, 0, 0), (1, 0, 0), (2, 0, 0), (2, 0, -1), (4, None, 0), (None, 0, 0), (9, 0, 0)], "ref_id int, from_lane int, to_lane int")
    got = sorted((r.ref_id or 0) for r in signals.drop_zero_validity(refs, validities).collect())
    assert got == [0, 2, 3]
    assert signals.drop_zero_validity(refs, validities.limit(0)).count() == 6


def test_fans_take_corners_once(spark):
    """The triangles of fan_triangles with their corners' places, from one pass over the corners; the search for rings is in no filter."""
    rows = [(g, v, float(g + v * v), float(v * g)) for g in range(5) for v in range(g + 1)]
    table = spark.createDataFrame(rows, "g int, vertex int, x double, y double")
    place = {(g, v): (x, y) for g, v, x, y in rows}
    want = {(t.g, t.tri, t.a, t.b, t.c, *place[t.g, t.a], *place[t.g, t.b], *place[t.g, t.c]) for t in crosswalks.fan_triangles(table, ["g"]).collect()}
    met = crosswalks.fans(table, ["g"])
    assert {tuple(t) for t in met.collect()} == want and len(want) == 1 + 2 + 3
    assert "Join" not in met._jdf.queryExecution().optimizedPlan().toString()

    square = "array(named_struct('u', 0e0, 'v', 0e0, 'z', 0e0), named_struct('u', 1e0, 'v', 0e0, 'z', 0e0), named_struct('u', 1e0, 'v', rand(), 'z', 0e0), named_struct('u', 0e0, 'v', 0e0, 'z', 0e0))"
    walks = spark.range(3).selectExpr("1 AS map_id", "id AS road_id", "0 AS object_id", f"{square.replace('rand()', 'id + 1e0')} AS corners")
    found = crosswalks.crosswalk_rings(walks)
    filters = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line and "aggregate(" in line]
    assert not filters and [(r.road_id, r.ring, r["first"], r["last"]) for r in found.orderBy("road_id").collect()] == [(i, 0, 0, 2) for i in range(3)]
