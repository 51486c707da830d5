"""Closed-form cases of the column functions."""

import math

import pytest
from pyspark.sql import functions as F

from roadlake.functions import geo, scalar
from roadlake.functions.scalar import Rot, Vec

L = lambda *xs: [F.lit(float(x)) for x in xs]


def value(spark, *cols):
    return list(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).collect()[0])


def test_polynomial(spark):
    a, b, c, d, ds = L(1, 2, 3, 4, 1)
    assert value(spark, scalar.poly_eval(a, b, c, d, ds), scalar.poly_tangent(b, c, d, ds)) == [10.0, 20.0]


def test_segment_and_arc(spark):
    assert value(spark, *scalar.point_to_segment(*L(3, 4, 0, 0, 10, 0))) == [3.0, 4.0]
    assert value(spark, *scalar.point_to_segment(*L(3, 4, 0, 0, 0, 0))) == [0.0, 5.0]
    quarter = 5 * math.pi
    assert value(spark, *scalar.point_to_arc(*L(11, 10, 0, 0, quarter, 0, 0.1))) == pytest.approx([quarter, 1.0])
    assert value(spark, *scalar.point_to_arc(*L(0, 10, 0, 0, quarter, 0, 0.1))) == pytest.approx([0.0, 10.0])
    assert value(spark, *scalar.point_to_arc(*L(-3, -4, 0, 0, quarter, 0, 0.1))) == pytest.approx([0.0, 5.0])


def test_rotation(spark):
    v, at, r = Vec(*L(1, 2, 3)), Vec(*L(10, 20, 30)), Rot(*L(20, 30, 40))
    assert value(spark, *scalar.inverse_transform_point(Vec(*scalar.transform_point(v, at, r)), at, r)) == pytest.approx([1, 2, 3])
    assert value(spark, *scalar.forward(Rot(*L(0, 90, 0)))) == pytest.approx([0, 1, 0])
    assert value(spark, scalar.dot3(scalar.forward(r), scalar.right(r)), scalar.vec_length(scalar.up(r))) == pytest.approx([0, 1])


def test_vectors(spark):
    zero = Vec(*L(0, 0, 0))
    assert value(spark, *scalar.safe_unit(zero), *scalar.safe_unit(Vec(*L(0, 3, 4)))) == pytest.approx([0, 0, 0, 0, 0.6, 0.8])
    assert value(spark, scalar.vector_angle(Vec(*L(1, 0, 0)), Vec(*L(0, 2, 0)))) == pytest.approx([math.pi / 2])
    assert value(spark, *scalar.cross3(Vec(*L(1, 0, 0)), Vec(*L(0, 1, 0)))) == [0, 0, 1]


def test_texts_and_tiles(spark):
    assert value(spark, scalar.wildcard_match(F.lit("a.b1"), "a.?*"), scalar.wildcard_match(F.lit("axb1"), "a.?*")) == [True, False]
    assert value(spark, *scalar.tile_unpack(scalar.tile_pack(F.lit(-3), F.lit(-7)))) == [-3, -7]
    assert value(spark, scalar.int_range(F.lit(3), F.lit(1))) == [[3, 2, 1]]


def test_projections(spark):
    lat0, lon0 = L(42, 2)
    lat, lon = L(42.01, 2.02)
    x, y = geo.transverse_mercator(lat, lon, lat0, lon0)
    assert value(spark, *geo.transverse_mercator_inverse(x, y, lat0, lon0)) == pytest.approx([42.01, 2.02], abs=1e-9)
    scale = geo.latitude_scale(lat0)
    assert value(spark, *geo.mercator_inverse(*geo.mercator(lat, lon, scale), scale)) == pytest.approx([42.01, 2.02], abs=1e-9)
