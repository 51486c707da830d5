"""Tiles: ownership, enumeration, counts, bounds and localisation; heights from a raster or by formula."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def tile_of(x: Column, side: float, how: str = "floor") -> Column:
    """Tile number along one axis. "truncate" keeps the reference rule, by which the tiles beside zero are twice as wide."""
    return (F.floor(x / side) if how == "floor" else x / side).cast("int")


def tile_origin(tx: Column, ty: Column, side: float) -> tuple[Column, Column]:
    return tx * side, ty * side


def owned(features: DataFrame, tiles: DataFrame, side: float) -> tuple[DataFrame, DataFrame]:
    """(features with their tile and local coordinates, features outside every tile)."""
    placed = features.withColumns({"tx": tile_of(F.col("x"), side), "ty": tile_of(F.col("y"), side)})
    inside = placed.join(tiles, ["map_id", "tx", "ty"], "left_semi").withColumns({"local_x": F.col("x") - F.col("tx") * side, "local_y": F.col("y") - F.col("ty") * side})
    return inside, placed.join(tiles, ["map_id", "tx", "ty"], "left_anti")


def tile_counts(tiles: DataFrame) -> DataFrame:
    """Tiles along each axis; the bounds always hold tile 0."""
    low, high = (lambda c: F.least(F.min(c), F.lit(0))), (lambda c: F.greatest(F.max(c), F.lit(0)))
    return tiles.groupBy("map_id").agg((high("tx") - low("tx") + 1).alias("n_x"), (high("ty") - low("ty") + 1).alias("n_y"))


def bounds(points: DataFrame, keys: list[str], grow: float = 1.0) -> DataFrame:
    """Centre and half extent of the points of each key."""
    box = points.groupBy(*keys).agg(*[f(c).alias(f"{n}_{c}") for c in ("x", "y") for n, f in (("min", F.min), ("max", F.max))])
    return box.select(*keys, *[((F.col(f"max_{c}") + F.col(f"min_{c}")) / 2).alias(f"c{c}") for c in ("x", "y")], *[((F.col(f"max_{c}") - F.col(f"min_{c}")) / 2 * grow).alias(f"e{c}") for c in ("x", "y")])


def centred(points: DataFrame, keys: list[str]) -> DataFrame:
    """points with their distance from the mean point of their key: centre_x, centre_y, off_x, off_y. The means are joined back, so a hot key is no single task."""
    means = points.groupBy(*keys).agg(F.avg("x").alias("centre_x"), F.avg("y").alias("centre_y"))
    return points.join(means, keys).withColumns({"off_x": F.col("x") - F.col("centre_x"), "off_y": F.col("y") - F.col("centre_y")})


def chunks(points: DataFrame, keys: list[str], order: str, side: float) -> DataFrame:
    """The grid chunk of each key: its first point (by order), counted in sides from the map's least coordinates."""
    firsts = points.groupBy("map_id", *keys).agg(F.min_by("x", order).alias("x"), F.min_by("y", order).alias("y"))
    corner = points.groupBy("map_id").agg(F.min("x").alias("low_x"), F.min("y").alias("low_y"))
    at = lambda c: F.floor((F.col(c) - F.col(f"low_{c}")) / side).cast("int")
    return firsts.join(corner, "map_id").select("map_id", *keys, at("x").alias("chunk_x"), at("y").alias("chunk_y"))


def numbered(tiles: DataFrame) -> DataFrame:
    """Tiles with their row-major number on their map's grid, whose bounds always hold tile 0."""
    low = lambda c: F.least(F.min(c), F.lit(0)).alias(f"low_{c}")
    grid = tiles.groupBy("map_id").agg(low("tx"), low("ty"), (F.greatest(F.max("tx"), F.lit(0)) - F.least(F.min("tx"), F.lit(0)) + 1).alias("n_x"))
    return tiles.join(grid, "map_id").select("map_id", "tx", "ty", ((F.col("ty") - F.col("low_ty")) * F.col("n_x") + F.col("tx") - F.col("low_tx")).alias("number"))


def residency(positions: DataFrame, tiles: DataFrame, side: float, reach: float) -> DataFrame:
    """Tiles that each actor's next position needs anew (loads) and no longer (unloads): map_id, actor_id, event_id, loads, unloads.

    positions: map_id, actor_id, event_id, ts, x, y, in the order of ts, then event_id. The first position loads all it needs. A
    position's tiles are bounded by reach, whatever the map holds.
    """
    near = tiles_near(positions, tiles, side, reach).groupBy("map_id", "actor_id", "event_id").agg(F.collect_set(F.struct("tx", "ty")).alias("now"))
    at = positions.select("map_id", "actor_id", "event_id", "ts").join(near, ["map_id", "actor_id", "event_id"], "left")
    none = F.array().cast("array<struct<tx:int,ty:int>>")
    at = at.withColumn("now", F.coalesce("now", none))
    before = F.coalesce(F.lag("now").over(W.partitionBy("map_id", "actor_id").orderBy("ts", "event_id")), none)
    new = at.withColumn("before", before)
    return new.select("map_id", "actor_id", "event_id", F.sort_array(F.array_except("now", "before")).alias("loads"), F.sort_array(F.array_except("before", "now")).alias("unloads"))


def tiles_near(positions: DataFrame, tiles: DataFrame, side: float, reach: float) -> DataFrame:
    """Existing tiles within reach of each position (a box of tiles around it). Stateless: serves streams and tables alike."""
    span = lambda c: F.sequence(tile_of(F.col(c) - reach, side), tile_of(F.col(c) + reach, side))
    wanted = positions.withColumn("tx", F.explode(span("x"))).withColumn("ty", F.explode(span("y")))
    return wanted.join(tiles.select("map_id", "tx", "ty"), ["map_id", "tx", "ty"], "left_semi")


def height_at(points: DataFrame, heightmap: DataFrame, extent: float, pixels: int, low: float, high: float) -> DataFrame:
    """z of each point from the raster (px, py, r, and map_id where each map has its own): linear pixel, wrapped; joined by key."""
    pixel = lambda c: F.pmod(F.floor(F.col(c) / extent * pixels), F.lit(pixels)).cast("int")
    return points.withColumns({"px": pixel("x"), "py": pixel("y")}).join(heightmap, [*(["map_id"] if "map_id" in heightmap.columns else []), "px", "py"], "left").withColumn("z", F.col("r") / 255.0 * (high - low) + low)
