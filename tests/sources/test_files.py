"""Small files through the other readers and sinks."""

import json

import pytest

from roadlake.sources import files


def test_osm(spark, tmp_path):
    (tmp_path / "small.osm").write_text(
        '<osm><node id="1" lat="42" lon="2"/><node id="2" lat="42" lon="2.001"/><node id="3" lat="42.001" lon="2"/>'
        '<way id="10"><nd ref="2"/><nd ref="1"/><tag k="highway" v="service"/></way><way id="11"><nd ref="1"/><nd ref="3"/><nd ref="99"/></way></osm>'
    )
    got = {r.way_id: r for r in files.read_osm(spark, str(tmp_path / "small.osm"), 42.0, 2.0).collect()}
    assert got[10].tags == {"highway": "service"} and [round(p.x) for p in got[10].points] == [83, 0]
    assert [round(p.y) for p in got[11].points] == [0, -111]


def test_points(spark, tmp_path):
    (tmp_path / "points.csv").write_text("lon,lat\n2,42\n2.001,42,extra\n7\n")
    points, rejects = files.read_points(spark, str(tmp_path / "points.csv"), 42.0, 2.0)
    assert sorted(r.lon for r in points.collect()) == [2.0, 2.001]
    assert sorted(r.value for r in rejects.collect()) == ["7", "lon,lat"]


def test_polygons(spark, tmp_path):
    ring = [[2, 42], [2.001, 42], [2.001, 42.001], [2, 42]]
    shapes = [("Polygon", [ring]), ("Point", [2, 42]), ("Polygon", [ring[:3], ring]), ("Polygon", [[[2, 42]]])]
    (tmp_path / "rings.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": k, "coordinates": c}} for k, c in shapes]}, indent=1))
    got = {r["name"]: len(r.points) for r in files.read_polygons(spark, str(tmp_path / "rings.geojson"), 42.0, 2.0).collect()}
    assert got == {"0": 3, "2": 3}


def test_tiles(spark, tmp_path):
    names = spark.createDataFrame([("Town_Tile_0_1",), ("Town_Tile_-1_2",), ("Town",), (None,)], "name string")
    tiles = files.tile_catalogue(names)
    assert sorted((r.tx, r.ty) for r in tiles.collect()) == [(-1, 2), (0, 1)]
    files.write_tile_table(tiles.selectExpr("tile_id", "name", "tx * 5e2 AS x", "ty * 5e2 AS y", "0e0 AS z"), str(tmp_path / "t"))
    assert "1\tTown_Tile_0_1\t0.0\t500.0\t0.0" in [r.value for r in spark.read.text(str(tmp_path / "t")).collect()]


@pytest.mark.parametrize("navigation, want", [(False, ["v 0.000000 1.000000 2.000000", "v 1.000000 0.000000 0.500000", "f 1 2 2"]), (True, ["v 0.000000 2.000000 1.000000", "v 1.000000 0.500000 0.000000", "f 1 2 2"])])
def test_obj_file(spark, tmp_path, navigation, want):
    vertices = spark.createDataFrame([(1, 1, 1.0, 0.0, 0.5), (1, 0, 0.0, 1.0, 2.0)], "mesh_id int, vertex int, x double, y double, z double")
    faces = spark.createDataFrame([(1, 0, 0, 1, 1)], "mesh_id int, face int, a int, b int, c int")
    files.write_lines(files.obj_lines(vertices, faces, navigation), "mesh_id", str(tmp_path / "obj"))
    (file,) = (tmp_path / "obj" / "mesh_id=1").glob("*.txt")
    assert file.read_text().splitlines() == want
