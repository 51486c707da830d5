"""Tiles and origins that follow actors, and poses matched to lanes, for tables and for streams."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.operators.spatial import nearest_segments, point_to_segment
from roadlake.operators.tiles import tile_of
from roadlake.streaming import in_order

ORIGINS = "map_id int, actor_id long, event_id long, rebased boolean, origin_x double, origin_y double, local_x double, local_y double"
CHANGES = "map_id int, actor_id long, event_id long, change string, tx int, ty int"


def rebase_rule(side: float, limit: float) -> in_order.Rule:
    """An actor further than limit from its origin moves the origin to the corner of its tile; the first origin is 0, 0."""

    def rule(carry: object, rows: pd.DataFrame) -> tuple[pd.DataFrame, object]:
        ox, oy = carry or (0.0, 0.0)
        out = []
        for r in rows.itertuples():
            far = (r.x - ox) ** 2 + (r.y - oy) ** 2 > limit * limit
            if far:
                ox, oy = math.floor(r.x / side) * side, math.floor(r.y / side) * side
            out.append((r.map_id, r.actor_id, r.event_id, far, ox, oy, r.x - ox, r.y - oy))
        return pd.DataFrame(out, columns=[c.split()[0] for c in ORIGINS.split(", ")]), (ox, oy)

    return rule


def rebase_origins(poses: DataFrame, side: float, limit: float, delay: str = "10 seconds") -> DataFrame:
    """poses (map_id, actor_id, event_id, ts, x, y) -> whether each moved its actor's origin, the origin from then on, and the pose from there."""
    poses = poses.select("map_id", "actor_id", "event_id", "ts", "x", "y")
    run = {"keys": ["map_id", "actor_id"], "rule": rebase_rule(side, limit), "schema": ORIGINS}
    return in_order.over_stream(poses, delay=delay, **run) if poses.isStreaming else in_order.over_table(poses, **run)


def _changes(carry: object, rows: pd.DataFrame) -> tuple[pd.DataFrame, object]:
    held = {tuple(t) for t in carry or []}
    out = []
    for r in rows.itertuples():
        now = {tuple(map(int, t.split(":"))) for t in r.wanted.split(",") if t}
        out += [(r.map_id, r.actor_id, r.event_id, change, *t) for change, tiles in (("load", now - held), ("unload", held - now)) for t in sorted(tiles)]
        held = now
    return pd.DataFrame(out, columns=[c.split()[0] for c in CHANGES.split(", ")]), sorted(held)


def residency_changes(positions: DataFrame, tiles: DataFrame, side: float, reach: float, delay: str = "10 seconds") -> DataFrame:
    """One row for each tile that a position of an actor (map_id, actor_id, event_id, ts, x, y) loads or unloads; a map's tiles are a static table (map_id, tx, ty).

    A map's existing tiles stand in one row for each block of tiles as wide as what a position can need, so a stream meets them by a stateless join on at most four blocks.
    """
    width = int(2 * reach // side) + 2
    block = lambda c: F.floor(c / width).cast("int")
    low = {c: tile_of(F.col(a) - reach, side) for c, a in (("lx", "x"), ("ly", "y"))}
    high = {c: tile_of(F.col(a) + reach, side) for c, a in (("hx", "x"), ("hy", "y"))}
    at = positions.select("map_id", "actor_id", "event_id", "ts", "x", "y").withColumns(low | high)
    # Each tile stands in its own block and in the three before it: one block then holds all that a position whose lowest tile is in it can need.
    near = tiles.select("map_id", "tx", "ty").distinct().withColumn("bx", F.explode(F.array(block(F.col("tx")), block(F.col("tx")) - 1))).withColumn("by", F.explode(F.array(block(F.col("ty")), block(F.col("ty")) - 1)))
    held = near.groupBy("map_id", "bx", "by").agg(F.collect_list(F.struct("tx", "ty")).alias("tiles"))
    met = at.withColumns({"bx": block(F.col("lx")), "by": block(F.col("ly"))}).join(held, ["map_id", "bx", "by"], "left")
    wanted = F.filter("tiles", lambda t: t["tx"].between(F.col("lx"), F.col("hx")) & t["ty"].between(F.col("ly"), F.col("hy")))
    text = F.coalesce(F.array_join(F.transform(wanted, lambda t: F.concat_ws(":", t["tx"].cast("string"), t["ty"].cast("string"))), ","), F.lit(""))
    poses = met.select("map_id", "actor_id", "event_id", "ts", text.alias("wanted"))
    run = {"keys": ["map_id", "actor_id"], "rule": _changes, "schema": CHANGES}
    return in_order.over_stream(poses, delay=delay, **run) if poses.isStreaming else in_order.over_table(poses, **run)


def segment_cells(segments: DataFrame, reach: float) -> DataFrame:
    """map_id, cx, cy, near: for each cell of side reach, the segments (road_id, seq, lane_id, x0, y0, x1, y1) that a place in it can have within reach."""
    span = lambda a, b: F.sequence(F.floor((F.least(a, b) - reach) / reach), F.floor((F.greatest(a, b) + reach) / reach))
    cells = segments.withColumn("cx", F.explode(span(F.col("x0"), F.col("x1")))).withColumn("cy", F.explode(span(F.col("y0"), F.col("y1"))))
    return cells.groupBy("map_id", "cx", "cy").agg(F.collect_list(F.struct("road_id", "seq", "lane_id", "x0", "y0", "x1", "y1")).alias("near"))


def match_poses(poses: DataFrame, cells: DataFrame, reach: float) -> DataFrame:
    """poses with road_id, seq, lane_id, along and distance of the nearest segment within reach; null where there is none. Ties go to the smaller ids.

    Stateless, one join with a static table of cells: serves streams and tables alike, and late or repeated poses as any others.
    """
    spot = lambda g: point_to_segment(F.col("x"), F.col("y"), g["x0"], g["y0"], g["x1"], g["y1"])
    every = F.transform("near", lambda g: F.struct(F.round(spot(g)[1], 6).alias("distance"), g["road_id"].alias("road_id"), g["seq"].alias("seq"), g["lane_id"].alias("lane_id"), spot(g)[0].alias("along")))
    met = poses.withColumns({"cx": F.floor(F.col("x") / reach), "cy": F.floor(F.col("y") / reach)}).join(cells, ["map_id", "cx", "cy"], "left")
    best = met.withColumn("best", F.array_min(F.filter(every, lambda m: m["distance"] <= reach)))
    return best.select(*poses.columns, *[F.col(f"best.{c}").alias(c) for c in ("road_id", "seq", "lane_id", "along", "distance")])


def matched_poses(poses: DataFrame, segments: DataFrame, reach: float) -> DataFrame:
    """match_poses for a table of poses: the same rows from grids whose cells follow the density, so a pose meets few segments wherever a reach's width holds many.

    Places are searched once; a pose without a map, or with a null or non-finite place, has no segment.
    """
    found = ["road_id", "seq", "lane_id", "along", "d2"]
    places = poses.filter("map_id IS NOT NULL AND abs(x) < double('infinity') AND abs(y) < double('infinity')").select("map_id", "x", "y").distinct()
    near = nearest_segments(places.withColumn("point_id", F.struct("x", "y")), segments.select("map_id", "road_id", "seq", "lane_id", "x0", "y0", "x1", "y1"), ["road_id", "seq", "lane_id"], reach=reach)
    met = poses.drop(*found).join(near.select("map_id", "x", "y", *found), ["map_id", "x", "y"], "left")
    return met.select(*poses.columns, *found[:-1], F.col("d2").alias("distance"))
