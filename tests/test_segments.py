"""Lane segments against a loop over one lane's samples."""

import math

import pytest
from pyspark.sql import functions as F

from roadlake.operators import reference_line, segments

G = "map_id int, road_id long, s0 double, length double, x double, y double, hdg double, kind string, k0 double, k1 double, ua double, ub double, uc double, ud double, va double, vb double, vc double, vd double, by_length boolean"
REST = (*[None] * 8, None)
POLY = "map_id int, road_id long, lane_id int, s0 double, s1 double, a double, b double, c double, d double"


@pytest.fixture(scope="module")
def road(spark):
    rows = [(1, 5, 0.0, 120.0, 0.0, 0.0, 0.2, "line", None, None, *REST), (1, 5, 120.0, 150.0, 50.0, 9.0, 0.2, "arc", 0.03, None, *REST), (1, 5, 270.0, 80.0, 0.0, 5.0, 1.0, "spiral", 0.0, 0.04, *REST), (2, 5, 0.0, 350.0, 0.0, 0.0, 0.2, "line", None, None, *REST)]
    lanes = [(m, 5, sec, lane, {1: 2, 2: 32}[abs(lane)], s0, s1, m == 2) for m in (1, 2) for sec, s0, s1 in ((0, 0.0, 200.0), (1, 200.0, 350.0)) for lane in (-2, -1, 1, 2)]
    widths = [(m, 5, lane, 0.0, 1e9, 3.0, 0.001, 0.0, 0.0) for m in (1, 2) for lane in (-2, -1, 1, 2)]
    return spark.createDataFrame(lanes, "map_id int, road_id long, section_id int, lane_id int, type_mask int, s0 double, s1 double, straight boolean"), spark.createDataFrame(widths, POLY), spark.createDataFrame(rows, G)


def test_segments_by_a_loop(spark, road, monkeypatch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)  # lanes go over the ends of batches
    try:
        got = sorted(tuple(r) for r in segments.lane_segments(*road, mask=2).collect())
        samples = reference_line.lane_transforms(segments.lane_samples(road[0]), road[1], road[2]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = []
    by_lane = {}
    for r in samples:
        by_lane.setdefault((r.map_id, r.road_id, r.section_id, r.lane_id), []).append(r)
    for key, own in by_lane.items():
        if abs(key[3]) != 1:
            continue
        own.sort(key=lambda r: r.k)
        start, n = own[0], 0
        for r in own[1:]:
            turned = abs(math.remainder(math.radians(r.yaw - start.yaw), 2 * math.pi))
            if turned > math.pi / 100 or abs(r.s - start.s) > 100 or r.k == own[-1].k:
                want.append((*key, n, start.s, r.s, start.x, start.y, r.x, r.y))
                start, n = r, n + 1
    assert [g[:5] for g in got] == [w[:5] for w in sorted(want)] and len(got) > 100
    assert all(math.isclose(a, b, abs_tol=1e-9) for g, w in zip(got, sorted(want), strict=True) for a, b in zip(g[5:], w[5:], strict=True))
    # whole lanes are covered, each segment beginning where the last one ended; straight lanes are one segment
    for key in {g[:4] for g in got}:
        own = [g for g in got if g[:4] == key]
        assert all(a[6] == b[5] for a, b in zip(own, own[1:])) and math.isclose(abs(own[-1][6] - own[0][5]), 200 - 2e-5 if key[2] == 0 else 150 - 2e-5)
        assert key[0] == 1 or len(own) == 1
    assert {g[3] for g in got} == {-1, 1}


def test_outer_lanes_and_short_ones(road):
    lanes, widths, geometry = road
    got = segments.lane_segments(lanes, widths, geometry, mask=32).select("lane_id").distinct().collect()
    assert {r.lane_id for r in got} == {-2, 2}
    none = segments.lane_segments(lanes.withColumn("s1", F.col("s0")), widths, geometry)
    assert none.count() == 0


def test_samples_and_pieces_stay_where_the_roads_are(spark):
    """Only records are shuffled, by road or order: neither samples by lane nor pieces after a union."""
    from roadlake.plans import road_queries

    made = road_queries.QUERIES["wg8_lane_segments"](spark, "/root/testdata/sf0.001")
    plan = made._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert shuffles and not [line for line in shuffles if "lane_id" in line] and "Union" not in plan


def test_few_places_are_walked_once_in_batches(spark, road):
    """The walk stands once in the plan, as a step over batches and not as a fold of each place, and gives the places of the table of pieces."""
    points = road[2].select("map_id", "road_id", (F.col("s0") + F.col("length") * 0.7).alias("s"))
    few, many = (reference_line.road_points(points, road[2], few=f) for f in (True, False))
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "aggregate(" not in plan.split("ArrowEvalPython")[1]
    key = lambda d: sorted((r.map_id, r.s, round(r.x, 9), round(r.y, 9), round(r.hdg, 9)) for r in d.collect())
    assert key(few) == key(many) and few.count() == 4
