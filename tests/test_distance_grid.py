"""Distance grids and surface cells against loops over all samples, segments and cells."""

import math
import re

import pytest

import __spark_entry__  # noqa: F401  (registers the queries)
from roadlake.operators import distance_grid
from roadlake.operators.distance_grid import BAND, CORNERS
from roadlake.plans import road_queries

SEGMENTS = "map_id int, junction_id int, x0 double, y0 double, x1 double, y1 double, width double"


def distance(px, py, x0, y0, x1, y1):
    l2 = (x1 - x0) ** 2 + (y1 - y0) ** 2
    t = max(0.0, min(1.0, ((px - x0) * (x1 - x0) + (py - y0) * (y1 - y0)) / l2)) if l2 else 0.0
    return math.hypot(px - x0 - t * (x1 - x0), py - y0 - t * (y1 - y0))


def test_distances_and_cells(spark):
    step = 0.5
    good = [(0, 1, 0.1, 0.2, 9.3, 4.1, 3.0), (0, 1, 0.1, 4.2, 9.3, -3.7, 2.0), (0, 2, 1.0, 1.0, 1.0, 1.0, 2.2), (1, 1, -3.03, -2.0, -3.03, 5.0, 1.1), (1, 2, 0.0, 0.0, 1.0, 0.0, -1.0)]
    bad = [(None, 1, 0.0, 0.0, 1.0, 1.0, 1.0), (0, None, 0.0, 0.0, 1.0, 1.0, 1.0), (0, 1, math.nan, 0.0, 1.0, 1.0, 1.0), (0, 1, 0.0, math.inf, 1.0, 1.0, 1.0), (0, 1, 0.0, 0.0, 1.0, 1.0, None)]
    grid = distance_grid.junction_distance_grid(spark.createDataFrame(good + bad + good[:1], SEGMENTS), step)
    got = {(r.map_id, r.junction_id, r.i, r.j): r.d for r in grid.collect()}
    want = {}
    for m, q in {s[:2] for s in good}:
        for i in range(-20, 40):
            for j in range(-20, 40):
                d = min(distance(i * step, j * step, *s[2:6]) - max(s[6], 0) / 2 for s in good if s[:2] == (m, q))
                if round(d, 6) <= BAND * step:
                    want[m, q, i, j] = d
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in got)

    field = distance_grid.slab(grid, step, 0.2).cache()
    value = {(r.map_id, r.junction_id, r.i, r.j, r.k): r.value for r in field.collect()}
    assert len(value) == 3 * len(got)
    masks, cuts = {}, {}
    for m, q, i, j, k in value:
        corners = [(m, q, i + a, j + b, k + c) for a, b, c in CORNERS]
        if all(c in value for c in corners):
            mask = sum(1 << b for b, c in enumerate(corners) if value[c] < 0)
            if mask not in (0, 255):
                masks[m, q, i, j, k] = mask
                for a in corners:
                    for axis in range(3):
                        b = tuple(x + (n == axis + 2) for n, x in enumerate(a))
                        if b in corners and (value[a] < 0) != (value[b] < 0):
                            cuts[(*a[:2], axis, *a[2:])] = -value[a] / (value[b] - value[a])
    cells = distance_grid.classify_cells(field)
    assert {(r.map_id, r.junction_id, r.i, r.j, r.k): r.mask for r in cells.collect()} == masks and masks
    # Every cell with a corner on a lane and one beside it is known: the band is wide enough.
    on = {k for k, v in value.items() if v >= 0}
    touched = {(m, q, i - a, j - b, k - c) for m, q, i, j, k in on for a, b, c in CORNERS}
    assert {t for t in touched if t[4] in (-1, 0)} >= masks.keys() and all(all((m, q, i + a, j + b, k + c) in value for a, b, c in CORNERS) for m, q, i, j, k in touched)
    crossed = distance_grid.edge_crossings(field, cells).collect()
    found = {(r.map_id, r.junction_id, r.axis, r.i, r.j, r.k): r.share for r in crossed}
    assert len(found) == len(crossed) and found.keys() == cuts.keys() and all(abs(found[k] - cuts[k]) < 1e-9 for k in cuts)


def test_cells_of_odd_fields(spark):
    schema = "map_id int, junction_id int, i long, j long, k long, value double"
    cube = lambda m, values: [(m, 0, *c, v) for c, v in zip(CORNERS, values, strict=True)]
    rows = cube(0, [-1.0] + [0.0] * 7) + cube(1, [-1.0] * 8) + cube(2, [0.0] * 8) + cube(3, [-1.0, None] + [1.0] * 6) + cube(4, [-1.0, math.nan] + [1.0] * 6) + cube(5, [1.0, -3.0] + [-1.0] * 6)[:7]
    field = spark.createDataFrame(rows, schema)
    assert [(r.map_id, r.mask) for r in distance_grid.classify_cells(field).collect()] == [(0, 1)]
    assert {r.share for r in distance_grid.edge_crossings(field, distance_grid.classify_cells(field)).collect()} == {1.0}
    assert distance_grid.classify_cells(field.limit(0)).count() == 0


def test_tiles_agree_with_the_whole_field(spark):
    """Lanes over several tiles, along their borders and across their corners, on both sides of 0."""
    side = distance_grid.TILE * 0.5
    lanes = [(0, 1, -1.4 * side, -0.3 * side, 1.7 * side, 0.9 * side, 3.0), (0, 1, side, -0.4 * side, side, 1.2 * side, 1.0), (0, 1, -0.5, -0.5, 0.4, 0.6, 1.3), (0, 2, -0.2 * side, -side, 0.3 * side, -side, 2.0)]
    segments = spark.createDataFrame(lanes, SEGMENTS)
    rows = lambda d, *c: sorted(map(tuple, d.select("map_id", "junction_id", *c).collect()))
    field, tiled = distance_grid.slab(distance_grid.junction_distance_grid(segments), 0.5, 0.2).cache(), distance_grid.slab(distance_grid.tiled_grid(segments), 0.5, 0.2)
    samples = rows(field, "i", "j", "k", "value")
    assert len(samples) == len(set(samples)) and samples == sorted(set(rows(tiled, "i", "j", "k", "value")))
    cells = distance_grid.classify_cells(field)
    assert rows(cells, "i", "j", "k", "mask") == rows(distance_grid.classify_cells(tiled), "i", "j", "k", "mask")
    crossed = rows(distance_grid.surface_crossings(tiled), "axis", "i", "j", "k", "share")
    assert crossed and crossed == rows(distance_grid.edge_crossings(field, cells), "axis", "i", "j", "k", "share")


@pytest.mark.parametrize("name", ["sf19_junction_distances", "sf20_surface_cells", "sf20_surface_crossings"])
def test_samples_cells_and_edges_are_not_shuffled(spark, name):
    plan = road_queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert dealt and not [x for x in dealt if re.search(r"\b[ijk]#", x)]
