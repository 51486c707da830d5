"""Queries over distance grids of junctions. The oracle takes whole segments, column by column of the grid, and compares all corners of a cell by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.functions.scalar import tidy
from roadlake.operators import distance_grid
from roadlake.operators.distance_grid import BAND, CORNERS
from roadlake.plans.derived import derived
from roadlake.plans.road_queries import SEGMENTS, lane_segments, query

STEP, THICK = 2.0, 0.25
REACH = BAND * STEP
READ = ("d_geometry", "d_lane_width", "d_roads")
GRID = f"""{SEGMENTS}, s AS (SELECT r.map_id, r.junction_id, x0, y0, x1, y1, seg.width / 2 AS half FROM seg JOIN d_roads r ON r.map_id = seg.map_id AND r.road_id = seg.road_id WHERE r.junction_id <> -1),
si AS MATERIALIZED (SELECT *, unnest(range(CAST(ceil((least(x0, x1) - half - {REACH}e0) / 2) AS BIGINT), CAST(floor((greatest(x0, x1) + half + {REACH}e0) / 2) AS BIGINT) + 1)) AS i FROM s),
sy AS MATERIALIZED (SELECT *, CASE WHEN abs(x1 - x0) < 1e-6 THEN y0 ELSE y0 + (y1 - y0) / (x1 - x0) * (greatest(least(x0, x1), least(greatest(x0, x1), 2 * i - half - {REACH}e0)) - x0) END AS ya,
  CASE WHEN abs(x1 - x0) < 1e-6 THEN y1 ELSE y0 + (y1 - y0) / (x1 - x0) * (greatest(least(x0, x1), least(greatest(x0, x1), 2 * i + half + {REACH}e0)) - x0) END AS yb FROM si),
sj AS MATERIALIZED (SELECT map_id, junction_id, x0, y0, x1, y1, half, i, unnest(range(CAST(floor((least(ya, yb) - half - {REACH}e0) / 2) AS BIGINT), CAST(ceil((greatest(ya, yb) + half + {REACH}e0) / 2) AS BIGINT) + 1)) AS j FROM sy),
so AS (SELECT *, greatest(0e0, least(1e0, ((2 * i - x0) * (x1 - x0) + (2 * j - y0) * (y1 - y0)) / ((x1 - x0) ** 2 + (y1 - y0) ** 2))) AS f FROM sj),
sd AS (SELECT map_id * 100000 + junction_id AS place, i * 2 AS i2, j * 2 AS j2, round(sqrt((x0 + f * (x1 - x0) - 2 * i) ** 2 + (y0 + f * (y1 - y0) - 2 * j) ** 2) - half, 6) AS d FROM so),
packed AS (SELECT place, i2, j2, min(d) AS d FROM sd WHERE d <= {REACH}e0 GROUP BY place, i2, j2),
grid AS MATERIALIZED (SELECT place // 100000 AS map_id, place % 100000 AS junction_id, i2 // 2 AS i, j2 // 2 AS j, d FROM packed),
field AS MATERIALIZED (SELECT map_id, junction_id, i, j, k, -greatest(d, abs(k) * 2e0 - {THICK}e0) AS value FROM grid CROSS JOIN (VALUES (-1), (0), (1)) AS l(k))"""
KEYS = ("map_id", "junction_id", "i", "j", "k")


def _shifted(table: str, axis: str, values: list[str]) -> str:
    """Rows of a table with those one step further on an axis: each value v becomes v0 and v1."""
    met = " AND ".join(f"b.{c} = a.{c}" + (" + 1" if c == axis else "") for c in KEYS)
    return f"SELECT {', '.join('a.' + c for c in KEYS)}, {', '.join(f'{t}.{v} AS {v}{n}' for v in values for n, t in enumerate('ab'))} FROM {table} a JOIN {table} b ON {met}"


#: cells (KEYS, v000 to v111 by steps in i, j and k, mask): three joins, one along each axis.
MASKS = (
    f"ei AS MATERIALIZED ({_shifted('(SELECT *, value AS v FROM field)', 'i', ['v'])}), ej AS MATERIALIZED ({_shifted('ei', 'j', ['v0', 'v1'])}), ek AS ({_shifted('ej', 'k', ['v00', 'v01', 'v10', 'v11'])}), "
    f"cells AS MATERIALIZED (SELECT *, {' + '.join(f'CASE WHEN v{i}{j}{k} < 0 THEN {1 << b} ELSE 0 END' for b, (i, j, k) in enumerate(CORNERS))} AS mask FROM ek)"
)
#: edges (map_id, junction_id, axis, i, j, k, a, b): the twelve of every cell, with the values at their ends.
EDGES = "edges AS (" + " UNION ALL ".join(
    f"SELECT map_id, junction_id, {axis} AS axis, i + {c[0]} AS i, j + {c[1]} AS j, k + {c[2]} AS k, v{''.join(map(str, c))} AS a, v{''.join('1' if n == axis else str(x) for n, x in enumerate(c))} AS b FROM cells WHERE mask NOT IN (0, 255)"
    for axis in range(3) for c in CORNERS if c[axis] == 0
) + ")"


def inside(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = lane_segments(spark, sf_dir)
    (roads,) = derived(spark, sf_dir, "d_roads")
    return segments.join(roads.filter("junction_id <> -1").select("map_id", "road_id", "junction_id"), ["map_id", "road_id"])


def slabs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distance_grid.slab(distance_grid.tiled_grid(inside(spark, sf_dir), STEP), STEP, THICK)


@query(f"more {GRID} SELECT map_id, junction_id, i, j, CAST(floor(d * 1e4 + 5e-1) AS BIGINT) AS d_tenth_mm FROM grid", *READ, roads=True)
def sf19_junction_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed distances to the lanes of each junction in a band around them, in whole tenths of a millimetre."""
    return distance_grid.junction_distance_grid(inside(spark, sf_dir), STEP).select("map_id", "junction_id", "i", "j", F.floor(F.col("d") * 1e4 + 0.5).alias("d_tenth_mm"))


@query(f"more {GRID}, {MASKS} SELECT map_id, junction_id, i, j, k, mask FROM cells WHERE mask NOT IN (0, 255)", *READ, roads=True)
def sf20_surface_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells through which the surface of the junctions' slabs passes, with the mask of their corners."""
    return distance_grid.classify_cells(slabs(spark, sf_dir))


@query(
    f"more {GRID}, {MASKS}, {EDGES} SELECT DISTINCT map_id, junction_id, axis, i, j, k, round(-a / (b - a), 3) + 0e0 AS share FROM edges WHERE (a < 0) <> (b < 0)",
    *READ,
    roads=True,
)
def sf20_surface_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where that surface cuts the edges of these cells."""
    return distance_grid.surface_crossings(slabs(spark, sf_dir)).withColumn("share", tidy(F.col("share"), 3))
