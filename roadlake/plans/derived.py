"""Road-shaped tables derived from the raw tables; the same SQL runs in Spark and in the oracle."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from roadlake.operators.lineage import land

#: name -> (views and tables that it reads, SQL)
VIEWS = {
    "d_geometry": (
        ["lineitem"],
        """
WITH g AS (
  SELECT l_orderkey AS road_id, l_partkey, l_suppkey, l_linenumber, l_quantity AS length,
         l_discount, l_tax, l_returnflag, l_linestatus,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS INT) - 1 AS seq,
         sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - l_quantity AS s0
  FROM lineitem)
SELECT CAST(road_id % 8 AS INT) AS map_id, road_id, seq, s0, s0 + length AS s1, length,
       CAST((road_id * 7919) % 4000 AS DOUBLE) + s0 * cos(((road_id * 37) % 360) * pi() / 180) AS x,
       CAST((road_id * 104729) % 4000 AS DOUBLE) + s0 * sin(((road_id * 37) % 360) * pi() / 180) AS y,
       ((road_id * 37) % 360) * pi() / 180 AS hdg,
       'line' AS kind,
       CAST((l_suppkey % 11) - 5 AS DOUBLE) / 5e2 AS curvature,
       l_discount, l_tax, l_returnflag, l_linestatus
FROM g
""",
    ),
    "d_roads": (
        ["d_geometry", "orders"],
        """
SELECT CAST(o.o_orderkey % 8 AS INT) AS map_id, o.o_orderkey AS road_id, o.o_orderpriority AS name, g.length,
       CASE WHEN o.o_orderkey % 5 = 0 THEN CAST(o.o_custkey % 50 AS INT) ELSE -1 END AS junction_id,
       o.o_orderkey - 8 * (1 + o.o_custkey % 3) AS pred,
       o.o_orderkey + 8 * (1 + o.o_custkey % 3) AS succ
FROM orders o JOIN (SELECT road_id, sum(length) AS length FROM d_geometry GROUP BY road_id) g
  ON g.road_id = o.o_orderkey
""",
    ),
    "d_elevation": (
        ["d_geometry"],
        """
SELECT map_id, road_id, s0, s1, CAST(seq AS DOUBLE) AS a, l_tax / 1e1 AS b, 0e0 AS c, 0e0 AS d FROM d_geometry
""",
    ),
    "d_sections": (
        ["d_geometry"],
        """
SELECT map_id, road_id, CAST(row_number() OVER (PARTITION BY road_id ORDER BY s0) AS INT) - 1 AS section_id, s0
FROM d_geometry WHERE seq % 3 = 0
""",
    ),
    "d_lanes": (
        ["d_sections"],
        """
SELECT s.map_id, s.road_id, s.section_id, t.lane_id,
       CASE abs(t.lane_id) WHEN 1 THEN 'driving' WHEN 2 THEN CASE WHEN s.road_id % 2 = 0 THEN 'parking' ELSE 'biking' END ELSE 'sidewalk' END AS type,
       CASE abs(t.lane_id) WHEN 1 THEN 2 WHEN 2 THEN CASE WHEN s.road_id % 2 = 0 THEN 256 ELSE 16 END ELSE 32 END AS type_mask,
       t.lane_id AS pred, t.lane_id AS succ
FROM d_sections s CROSS JOIN (VALUES (-3), (-2), (-1), (1), (2), (3)) AS t(lane_id)
""",
    ),
    "d_lane_width": (
        ["d_geometry"],
        """
SELECT g.map_id, g.road_id, t.lane_id, g.s0, g.s1,
       25e-1 + g.l_discount * 1e1 / abs(t.lane_id) AS a, (g.l_tax - 4e-2) / 1e1 AS b, 0e0 AS c, 0e0 AS d
FROM d_geometry g CROSS JOIN (VALUES (-3), (-2), (-1), (1), (2), (3)) AS t(lane_id)
""",
    ),
    "d_signal_refs": (
        ["d_geometry"],
        """
SELECT map_id, concat('sig_', CAST(road_id AS STRING), '_', CAST(seq AS STRING)) AS signal_id, road_id,
       s0 + length / 2 AS s, CASE WHEN seq % 2 = 0 THEN 6e0 ELSE -6e0 END AS t,
       CASE WHEN seq % 3 = 0 THEN '274' WHEN seq % 3 = 1 THEN '206' ELSE '1000001' END AS type,
       CASE WHEN l_linestatus = 'O' THEN '+' WHEN seq % 2 = 0 THEN '-' ELSE 'none' END AS orientation
FROM d_geometry WHERE l_returnflag = 'R'
""",
    ),
    "d_pings": (
        ["events"],
        """
SELECT CAST(user_id % 8 AS INT) AS map_id, event_id, user_id AS actor_id, ts,
       CAST((event_id * 3571) % 4000 AS DOUBLE) + value / 1e3 AS x,
       CAST((event_id * 1283) % 4000 AS DOUBLE) + value / 7e2 AS y,
       0e0 AS z, CAST((event_id * 53) % 360 AS DOUBLE) AS yaw
FROM events
""",
    ),
    "d_tiles": (
        ["orders"],
        """
SELECT m.map_id, a.i AS tx, b.j AS ty
FROM (SELECT DISTINCT CAST(o_orderkey % 8 AS INT) AS map_id FROM orders) m
CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5), (6), (7)) AS a(i)
CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5), (6), (7)) AS b(j)
""",
    ),
    "d_connections": (
        ["d_roads"],
        """
SELECT r.map_id, r.junction_id, CAST(dense_rank() OVER (PARTITION BY r.map_id, r.junction_id ORDER BY r.road_id) AS INT) - 1 AS connection_id,
       r.pred AS incoming_road, r.road_id AS connecting_road, t.lane_id AS link_from, t.lane_id AS link_to
FROM d_roads r CROSS JOIN (VALUES (-1), (1)) AS t(lane_id)
WHERE r.junction_id <> -1
""",
    ),
}

# Records of all five kinds in turn, and a lane offset along each road.
VIEWS |= {
    "c_geometry": (
        ["d_geometry"],
        """
SELECT map_id, road_id, seq, CAST(s0 AS DOUBLE) AS s0, CAST(s1 AS DOUBLE) AS s1, CAST(length AS DOUBLE) AS length, x, y, hdg,
       CASE (road_id + seq) % 5 WHEN 0 THEN 'line' WHEN 1 THEN 'arc' WHEN 2 THEN 'spiral' WHEN 3 THEN 'poly3' ELSE 'paramPoly3' END AS kind,
       curvature AS k0, -curvature AS k1, 0e0 AS ua, CAST(length AS DOUBLE) AS ub, 0e0 AS uc, 0e0 AS ud, 0e0 AS va, 0e0 AS vb,
       CASE WHEN (road_id + seq) % 5 = 3 THEN curvature / 5 ELSE curvature * length END AS vc,
       CASE WHEN (road_id + seq) % 5 = 3 THEN 0e0 ELSE -curvature * length / 2 END AS vd, 1 = 0 AS by_length
FROM d_geometry
""",
    ),
    "c_lane_offset": (
        ["d_geometry"],
        """
SELECT map_id, road_id, s0, s1, CAST(seq AS DOUBLE) / 4e0 AS a, curvature / 5e0 AS b, 0e0 AS c, 0e0 AS d FROM d_geometry
""",
    ),
}

# The same tables as a network with more of what real ones have: each road id stands in two maps; lane ids change along links; links of 0; lanes that
# not every section has; roads laid head to head; roads that lead into junctions.
VIEWS |= {
    "v_roads": (
        ["d_roads"],
        """
SELECT map_id, road_id, length, pred, succ FROM d_roads
UNION ALL
SELECT map_id + 8 AS map_id, road_id, length / 2 AS length, succ AS pred, CASE WHEN road_id % 4 = 0 THEN 1000000000 + road_id % 50 ELSE pred END AS succ FROM d_roads
""",
    ),
    "v_sections": (
        ["d_sections"],
        """
SELECT map_id, road_id, section_id, s0 FROM d_sections UNION ALL SELECT map_id + 8 AS map_id, road_id, section_id, s0 / 2 AS s0 FROM d_sections
""",
    ),
    "v_lanes": (
        ["d_lanes"],
        """
SELECT map_id, road_id, section_id, lane_id, type_mask,
       CASE WHEN (road_id + section_id) % 5 = 0 THEN 0 WHEN (road_id + section_id) % 5 = 1 AND abs(lane_id) > 1 THEN lane_id - CAST(sign(lane_id) AS INT) ELSE lane_id END AS pred,
       CASE WHEN (road_id + section_id) % 7 = 0 THEN 0 WHEN (road_id + section_id) % 7 = 1 AND abs(lane_id) < 3 THEN lane_id + CAST(sign(lane_id) AS INT) ELSE lane_id END AS succ
FROM d_lanes WHERE NOT (abs(lane_id) = 3 AND (road_id + section_id) % 3 = 1)
UNION ALL
SELECT map_id + 8 AS map_id, road_id, section_id, lane_id, type_mask, CASE WHEN road_id % 3 = 0 AND section_id = 0 THEN -lane_id ELSE lane_id END AS pred, CASE WHEN road_id % 3 = 1 THEN -lane_id ELSE lane_id END AS succ
FROM d_lanes WHERE lane_id <> 3
""",
    ),
    "v_connections": (
        ["v_roads"],
        """
SELECT r.map_id, r.succ AS junction_id, r.road_id AS incoming_road, r.ahead AS connecting_road, t.lane_id AS link_from, CASE WHEN r.road_id % 8 = 0 THEN -t.lane_id ELSE t.lane_id END AS link_to
FROM (SELECT *, lead(road_id) OVER (PARTITION BY map_id ORDER BY road_id) AS ahead FROM v_roads) r CROSS JOIN (VALUES (-1), (-2)) AS t(lane_id)
WHERE r.succ >= 1000000000 AND r.ahead IS NOT NULL
""",
    ),
}

HEIGHTMAP_SPARK = """
SELECT CAST(vec_id AS INT) AS px, pos AS py, CAST(floor((CAST(v AS DOUBLE) + 1e0) * 1275e-1) AS INT) AS r
FROM embeddings LATERAL VIEW posexplode(embedding) e AS pos, v WHERE vec_id < 64
"""
HEIGHTMAP_ORACLE = """
SELECT CAST(vec_id AS INT) AS px, CAST(pos - 1 AS INT) AS py, CAST(floor((CAST(v AS DOUBLE) + 1e0) * 1275e-1) AS INT) AS r
FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings WHERE vec_id < 64)
"""


#: Spark's setting that makes a join shuffle again unless both sides are partitioned by all of its keys.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
#: So many plan records are one task's.
RECORDS = 250_000
_roads: dict[str, DataFrame] | None = None
_records = RECORDS


@contextmanager
def by_road(spark: SparkSession, wanted: bool = True, rows: int = 1) -> Iterator[None]:
    """While a query is built: d_geometry is computed once and dealt by road, and its joins by map, road and more stay in that deal.

    So only narrow rows of the plan records are shuffled, before lanes, sections and samples multiply them. Not for queries that also group by map alone: their joins would
    follow those few groups. A query that makes many more rows of a record than its lanes names their number (rows), so that a task has so many records less.
    """
    global _roads, _records
    before, held, _roads, _records = _roads, _records, {} if wanted else None, max(1, RECORDS // rows)
    spark.conf.set(ALL_KEYS, str(not wanted).lower())  # read when the query is planned, so it stays until the next query is built
    try:
        yield
    finally:
        _roads, _records = before, held


def every_key(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """f with Spark's own rule for joins."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set(ALL_KEYS, "true")
        return f(spark, sf_dir)

    return run


def dealt(records: DataFrame) -> DataFrame:
    """records by road. Large tables go to a number of tasks that is not coalesced by the bytes of these narrow rows, as lanes and samples multiply them within a task."""
    spark = records.sparkSession
    tasks = -(-records.count() // _records)
    if tasks <= spark.sparkContext.defaultParallelism:
        return records.repartition("road_id")
    return records.repartition(max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))), "road_id")


def derived(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """The named views over the tables of sf_dir (d_heightmap included)."""

    def need(name: str) -> None:
        if name == "d_heightmap":
            need("embeddings")
            spark.sql(HEIGHTMAP_SPARK).createOrReplaceTempView(name)
        elif name == "d_geometry" and _roads is not None:
            if sf_dir not in _roads:
                need("lineitem")
                _roads[sf_dir] = dealt(land(spark.sql(VIEWS[name][1])))
            _roads[sf_dir].createOrReplaceTempView(name)
        elif name in VIEWS:
            for x in VIEWS[name][0]:
                need(x)
            spark.sql(VIEWS[name][1]).createOrReplaceTempView(name)
        else:
            spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)

    for name in names:
        need(name)
    return [spark.table(name) for name in names]


def chain(*names: str) -> str:
    """WITH clause that defines the named views for the oracle."""
    order: list[str] = []

    def need(name: str) -> None:
        for x in VIEWS.get(name, ([], ""))[0]:
            need(x)
        if name not in order and (name in VIEWS or name == "d_heightmap"):
            order.append(name)

    for name in names:
        need(name)
    return "WITH " + ", ".join(f"{n} AS ({HEIGHTMAP_ORACLE if n == 'd_heightmap' else VIEWS[n][1]})" for n in order)
