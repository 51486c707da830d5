"""Table forms of the stream operators as queries; tests hold the stream forms to these over several micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.functions.scalar import tidy
from roadlake.plans.derived import derived
from roadlake.plans.road_queries import NEAREST, lane_segments, query
from roadlake.streaming import tile_streams


@query()
def st3_rebased_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each actor's origin moves to its tile once the actor is over 1,500 m away. Sequential, so without SQL; held to a loop in tests."""
    (pings,) = derived(spark, sf_dir, "d_pings")
    out = tile_streams.rebase_origins(pings, 500.0, 1500.0)
    return out.select("map_id", "actor_id", "event_id", "rebased", "origin_x", "origin_y", tidy(F.col("local_x")).alias("local_x"), tidy(F.col("local_y")).alias("local_y"))


REACH = 40.0


@query(
    f"{NEAREST} SELECT event_id, CASE WHEN d2 <= 4e1 THEN road_id END AS road_id, CASE WHEN d2 <= 4e1 THEN seq END AS seq, CASE WHEN d2 <= 4e1 THEN lane_id END AS lane_id, CASE WHEN d2 <= 4e1 THEN d2 END AS distance FROM n",
    "d_geometry", "d_lane_width", "d_pings", roads=True,
)
def st5_matched_poses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pose with the nearest lane segment within 40 m, by the table form of the matching."""
    (pings,) = derived(spark, sf_dir, "d_pings")
    out = tile_streams.matched_poses(pings, lane_segments(spark, sf_dir), REACH)
    return out.select("event_id", "road_id", "seq", "lane_id", "distance")
