"""Joined meshes, thinned marks, lookups by key and bounds against loops."""

import collections
import math
import random
import re

from roadlake.operators import lookup, mesh, thinning

SQUARE = [(0, 1, 2), (1, 3, 2)]


def loop_concat(meshes, link):
    """One mesh from (vertices, triangles) pairs."""
    points, faces = [], []
    for own, tri in meshes:
        v = len(points)
        if link > 1 and v >= link and len(own) >= link and v:
            for i in range(link - 1):
                faces += [(v - link + i, v - link + i + 1, v + i), (v - link + i + 1, v + i + 1, v + i)]
        points += own
        faces += [tuple(v + k for k in t) for t in tri]
    return points, faces


def test_concat_meshes(spark, monkeypatch):
    monkeypatch.setattr(mesh, "BLOCK", 3)
    rng = random.Random(3)
    made = {(m, 2 * k): ([rng.random() for _ in range(n)], SQUARE if n >= 4 else []) for m in (0, 1) for k, n in enumerate((4, 1, 6, 4, 3, 5, 900, 2, 4))}
    vertices = spark.createDataFrame([(m, k, i, x) for (m, k), (own, _) in made.items() for i, x in enumerate(own)], "map_id int, mesh_id long, vertex int, x double")
    triangles = spark.createDataFrame([(m, k, i, *t) for (m, k), (_, tri) in made.items() for i, t in enumerate(tri)] + [(0, None, 0, 0, 1, 2), (0, 7, 0, 0, 1, 2)], "map_id int, mesh_id long, tri int, a int, b int, c int")
    for link in (0, 1, 2, 3):
        points, faces = mesh.concat_meshes(vertices, triangles, link)
        for m in (0, 1):
            want_points, want_faces = loop_concat([made[k] for k in sorted(made) if k[0] == m], link)
            assert [(r.vertex, r.x) for r in points.filter(f"map_id = {m}").orderBy("vertex").collect()] == list(enumerate(want_points))
            assert [(r.tri, r.a, r.b, r.c) for r in faces.filter(f"map_id = {m}").orderBy("tri").collect()] == [(i, *t) for i, t in enumerate(want_faces)]
    assert mesh.concat_meshes(vertices.limit(0), triangles, 2)[1].count() == 0


def test_mesh_validity(spark):
    meshes = spark.createDataFrame([(0, k) for k in range(5)], "map_id int, mesh_id long")
    vertices = spark.createDataFrame([(0, k) for k in (0, 1, 2, 3)], "map_id int, mesh_id long")
    indices = spark.createDataFrame([(0, 0)] * 3 + [(0, 1)] * 4 + [(0, 4)] * 3, "map_id int, mesh_id long")
    materials = spark.createDataFrame([(0, 0, 0, 0), (0, 0, 1, 3), (0, 2, 0, 3), (0, 2, 1, 0)], "map_id int, mesh_id long, seq int, index_end int")
    got = {r.mesh_id: r.valid for r in mesh.mesh_validity(meshes, vertices, indices, materials).collect()}
    assert got == {0: True, 1: False, 2: False, 3: True, 4: False}


def test_dedupe_marks_as_one_pass(spark):
    rng = random.Random(5)
    rows = [(m, k, *(rng.uniform(-9, 9) for _ in range(2)), rng.uniform(0, 2)) for m in (0, 1) for k in range(150)]
    rows += [(2, k, 1.5 * (k % 20), 0.0, 0.0) for k in range(20)]  # a chain: every other one stays
    rows += [(3, k, rng.uniform(0, 0.9), 0.1, 0.1) for k in range(300)]  # one crowded cell
    rows += [(4, 1, 0.0, 0.0, 0.0), (4, 1, 0.0, 0.0, 0.0), (4, 2, 2.5, 0.0, 0.0), (4, 3, None, 0.0, 0.0)]  # a repeat, a distance of just the radius, a null
    rows += [(4, 4, math.nan, 0.0, 0.0), (4, 5, math.inf, 0.0, 0.0), (None, 1, 0.0, 0.0, 0.0), (5, None, 0.0, 0.0, 0.0), (5, 1, 1.0, 0.0, 0.0)]
    odd = [(4, 3), (4, 4), (4, 5), (None, 1)]
    kept = []
    for r in sorted((r for r in rows if r[:2] not in odd), key=lambda r: (r[0], r[1] or 0)):
        if all(k[0] != r[0] or math.dist(k[2:], r[2:]) >= 2.5 for k in kept):
            kept.append(r)
    marks = spark.createDataFrame(rows, "map_id int, mark_id long, x double, y double, z double")
    got = collections.Counter((r.map_id, r.mark_id) for r in thinning.dedupe_marks(marks).collect())
    assert got == collections.Counter([r[:2] for r in kept] + odd)
    assert thinning.dedupe_marks(marks.limit(0)).count() == 0


def test_waypoint_by_key_edges(spark):
    roads = spark.createDataFrame([(0, 1, 30.0)], "map_id int, road_id long, length double")
    sections = spark.createDataFrame([(0, 1, 0, 0.0), (0, 1, 1, 10.0), (0, 1, 2, 10.0)], "map_id int, road_id long, section_id int, s0 double")
    lanes = spark.createDataFrame([(0, 1, 0, -1), (0, 1, 1, -1), (0, 1, 2, -1), (0, 1, 2, -2)], "map_id int, road_id long, section_id int, lane_id int")
    asked = {(1, -1, 0.0): 0, (1, -1, -0.1): None, (1, -1, 10.0): 1, (1, -2, 10.0): 2, (1, -2, 5.0): None, (1, -1, 30.0): None, (9, -1, 5.0): None, (1, -1, None): None}
    keys = spark.createDataFrame([(0, *k) for k in asked], "map_id int, road_id long, lane_id int, s double")
    got = {(r.road_id, r.lane_id, r.s): r.section_id for r in lookup.waypoint_by_key(keys.union(keys), roads, sections, lanes).collect()}
    assert got == asked


def test_in_bounds_is_strict(spark):
    boxes = spark.createDataFrame([(0, 7, 0.0, 0.0, 100.0, -100.0)], "map_id int, box_id int, min_x double, min_y double, max_x double, max_y double")
    points = [(0, 1, 50.0, -50.0), (0, 2, 0.0, -50.0), (0, 3, 50.0, -100.0), (0, 4, 50.0, 50.0), (1, 5, 50.0, -50.0), (0, 6, None, 1.0)]
    got = lookup.in_bounds(spark.createDataFrame(points, "map_id int, id int, x double, y double"), boxes, 30.0).collect()
    assert [(r.id, r.box_id) for r in got] == [(1, 7)]


def test_rounds_of_thinning_shuffle_by_tiles(spark, monkeypatch):
    """What a mark says to the 27 cells around it is made after the shuffle, in its tile; marks on both sides of a tile's border still meet."""
    plans = []
    monkeypatch.setattr(thinning, "cut", lambda df, f=thinning.cut: plans.append(df._jdf.queryExecution().executedPlan().toString()) or f(df))
    edge = thinning.TILE * 2.5 * 1.001
    places = [(1, edge + 1.0), (2, edge - 1.0), (3, edge - 3.0), (4, -1.0), (5, 1.0)]
    marks = spark.createDataFrame([(m, k, x, y, 0.0) for m in (0, 1) for k, x in places for y in ([x] if k < 4 else [0.0])], "map_id int, mark_id int, x double, y double, z double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sorted((r.map_id, r.mark_id) for r in thinning.dedupe_marks(marks, 2.5).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # On the diagonal mark 2 is 2.83 m from 1 and 3; across x = 0 mark 5 is 2 m from 4.
    assert got == [(m, k) for m in (0, 1) for k in (1, 2, 3, 4)]
    dealt = [x for p in plans for x in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)]
    assert dealt and all("tile" in x for x in dealt), dealt
