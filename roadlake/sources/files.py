"""Other sources and sinks: map extracts, coordinate lists, polygons, tile catalogues, mesh and point texts, tiled features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.functions import geo, scalar

NODE = "_id LONG, _lat DOUBLE, _lon DOUBLE"
WAY = "_id LONG, nd ARRAY<STRUCT<_ref: LONG>>, tag ARRAY<STRUCT<_k: STRING, _v: STRING>>"
POLYGONS = "features ARRAY<STRUCT<type: STRING, geometry: STRUCT<type: STRING, coordinates: STRING>>>"


def read_osm(spark: SparkSession, path: str, lat0: float, lon0: float) -> DataFrame:
    """Ways of an extract as projected polylines: way_id, tags (map), points (array of x, y in metres, in the way's order).

    References to nodes outside the extract are left out; a way that no node is left of has no row.
    """
    read = lambda tag, schema: spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)
    nodes = read("node", NODE).filter("_lat IS NOT NULL AND _lon IS NOT NULL").dropDuplicates(["_id"])
    x, y = geo.transverse_mercator(F.col("_lat"), F.col("_lon"), F.lit(lat0), F.lit(lon0), 1.0)
    ways = read("way", WAY)
    steps = ways.select(F.col("_id").alias("way_id"), F.posexplode("nd._ref").alias("pos", "node"))
    placed = steps.join(nodes.select(F.col("_id").alias("node"), x.alias("x"), y.alias("y")), "node")
    lines = placed.groupBy("way_id").agg(F.sort_array(F.collect_list(F.struct("pos", "x", "y"))).alias("p"))
    tags = ways.select(F.col("_id").alias("way_id"), F.map_from_entries(F.array_distinct(F.transform("tag", lambda t: F.struct(t["_k"], t["_v"])))).alias("tags"))
    return lines.join(tags, "way_id").select("way_id", "tags", F.transform("p", lambda q: F.struct(q["x"].alias("x"), q["y"].alias("y"))).alias("points"))


def read_points(spark: SparkSession, path: str, lat0: float, lon0: float) -> tuple[DataFrame, DataFrame]:
    """Rows lon, lat, ... of CSV files as (points: lon, lat, x, y; rejects: the rows without two numbers, as text)."""
    lines = spark.read.text(path)
    part = lambda i: F.trim(F.try_element_at(F.split("value", ","), F.lit(i))).try_cast("double")
    read = lines.select("value", part(1).alias("lon"), part(2).alias("lat"))
    x, y = geo.transverse_mercator(F.col("lat"), F.col("lon"), F.lit(lat0), F.lit(lon0))
    return read.filter("lon IS NOT NULL AND lat IS NOT NULL").select("lon", "lat", x.alias("x"), y.alias("y")), read.filter("lon IS NULL OR lat IS NULL").select("value")


def read_polygons(spark: SparkSession, path: str, lat0: float, lon0: float, near: float = 0.01, document_per_line: bool = False) -> DataFrame:
    """Outer rings of the polygons of feature collections: path, name (its ordinal among the features), points (x, y).

    Other kinds of geometry are skipped, and pairs without two numbers; a last point within near of the first is dropped, and
    so is a ring of fewer than two points.
    """
    found = spark.read.option("multiLine", not document_per_line).schema(POLYGONS).json(path)
    each = found.select(F.col("_metadata.file_path").alias("path"), F.posexplode("features").alias("ordinal", "f")).filter("f.geometry.type = 'Polygon'")
    ring = F.filter(F.from_json("f.geometry.coordinates", "ARRAY<ARRAY<ARRAY<DOUBLE>>>")[0], lambda p: F.size(p) >= 2)

    def place(p: Column) -> Column:
        x, y = geo.transverse_mercator(p[1], p[0], F.lit(lat0), F.lit(lon0))
        return F.struct(x.alias("x"), y.alias("y"))

    placed = each.select("path", F.col("ordinal").cast("string").alias("name"), F.transform(ring, place).alias("p")).filter("size(p) >= 2")
    first, last = F.col("p")[0], F.element_at("p", -1)
    closed = (F.abs(first["x"] - last["x"]) <= near) & (F.abs(first["y"] - last["y"]) <= near) & (F.size("p") > 2)
    return placed.select("path", "name", F.when(closed, F.slice("p", F.lit(1), F.size("p") - 1)).otherwise(F.col("p")).alias("points"))


def tile_catalogue(names: DataFrame, name: str = "name") -> DataFrame:
    """Rows whose name holds _Tile_ and ends in two numbers, with these as tx, ty, and tile_id."""
    number = lambda i: F.regexp_extract(name, r"_Tile_(?:.*_)?(-?\d+)_(-?\d+)$", i).try_cast("int")
    found = names.withColumns({"tx": number(1), "ty": number(2)}).filter("tx IS NOT NULL AND ty IS NOT NULL")
    return found.withColumn("tile_id", scalar.tile_pack(F.col("tx"), F.col("ty")))


def obj_lines(vertices: DataFrame, faces: DataFrame, for_navigation: bool = False) -> DataFrame:
    """Mesh text: mesh_id, part, ord, line. vertices: mesh_id, vertex (from 0), x, y, z; faces: mesh_id, face, a, b, c.

    For navigation y and z change places and the faces turn the other way.
    """
    xyz, abc = (("x", "z", "y"), ("a", "c", "b")) if for_navigation else (("x", "y", "z"), ("a", "b", "c"))
    points = vertices.select("mesh_id", F.lit(0).alias("part"), F.col("vertex").cast("long").alias("ord"), F.format_string("v %.6f %.6f %.6f", *[F.col(c).cast("double") for c in xyz]).alias("line"))
    sides = faces.select("mesh_id", F.lit(1).alias("part"), F.col("face").cast("long").alias("ord"), F.format_string("f %d %d %d", *[F.col(c).cast("long") + 1 for c in abc]).alias("line"))
    return points.unionByName(sides)


def ply_lines(points: DataFrame) -> DataFrame:
    """Point-cloud text: cloud_id, part, ord, line. points: cloud_id, ord, x, y, z. The header names the number of points."""
    head = F.array(*[F.lit(x) for x in ("ply", "format ascii 1.0")], F.concat(F.lit("element vertex "), F.col("n").cast("string")), *[F.lit(x) for x in ("property float32 x", "property float32 y", "property float32 z", "end_header")])
    header = points.groupBy("cloud_id").agg(F.count(F.lit(1)).alias("n")).select("cloud_id", F.lit(0).alias("part"), F.posexplode(head).alias("ord", "line")).withColumn("ord", F.col("ord").cast("long"))
    rows = points.select("cloud_id", F.lit(1).alias("part"), F.col("ord").cast("long").alias("ord"), F.format_string("%.4f %.4f %.4f", *[F.col(c).cast("double") for c in "xyz"]).alias("line"))
    return header.unionByName(rows)


def write_lines(lines: DataFrame, key: str, path: str) -> None:
    """A text file in a folder of its own for each key; a file is one task's, as its lines stand in order."""
    lines.repartition(key).sortWithinPartitions(key, "part", "ord").select(key, "line").write.partitionBy(key).text(path)


def write_tile_table(tiles: DataFrame, path: str) -> None:
    """Tile id, name and place as tab-separated text."""
    tiles.select("tile_id", "name", "x", "y", "z").write.option("sep", "\t").csv(path)


def write_tiled(features: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Features by map and owning tile as Parquet. Rows of a hot tile are dealt over several tasks by AQE's splits."""
    split = features.hint("rebalance", "map_id", "tile_id")
    split.write.partitionBy("map_id", "tile_id").option("maxRecordsPerFile", rows_per_file).parquet(path)


def imagery_requests(poses: DataFrame, lat0: float, lon0: float, key: str = "KEY", base: str = "https://example.invalid/streetview") -> DataFrame:
    """poses (x, y, z, yaw) with lat, lon, heading (whole degrees from north) and the text of an imagery request; nothing is fetched."""
    lat, lon, _ = geo.local_to_geo(F.lit(lat0), F.lit(lon0), F.lit(0.0), F.col("x"), F.col("y"), F.col("z"))
    turned = F.col("yaw") + 450.0
    heading = (turned - F.floor(turned / 360.0) * 360.0).cast("int")
    placed = poses.withColumns({"lat": lat, "lon": lon, "heading": heading})
    return placed.withColumn("url", F.format_string(f"{base}?location=%.6f,%.6f&heading=%d&key={key}", "lat", "lon", "heading"))
