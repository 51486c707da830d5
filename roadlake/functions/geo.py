"""Georeferencing on columns: spherical Mercator at a map's latitude, transverse Mercator, rebased origins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sphere radii of the two projections, in metres.
MERCATOR_RADIUS = 6_378_137.0
TRANSVERSE_RADIUS = 6_373_000.0


def latitude_scale(lat: Column) -> Column:
    return F.cos(F.radians(lat))


def mercator(lat: Column, lon: Column, scale: Column) -> tuple[Column, Column]:
    return scale * F.radians(lon) * MERCATOR_RADIUS, scale * MERCATOR_RADIUS * F.log(F.tan(F.radians(90.0 + lat) / 2.0))


def mercator_inverse(x: Column, y: Column, scale: Column) -> tuple[Column, Column]:
    """(lat, lon)"""
    return F.degrees(2.0 * F.atan(F.exp(y / (MERCATOR_RADIUS * scale)))) - 90.0, F.degrees(x / (MERCATOR_RADIUS * scale))


def add_metres(lat: Column, lon: Column, dx: Column, dy: Column) -> tuple[Column, Column]:
    scale = latitude_scale(lat)
    x, y = mercator(lat, lon, scale)
    return mercator_inverse(x + dx, y + dy, scale)


def local_to_geo(lat0: Column, lon0: Column, alt0: Column, x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Local metres (y southwards) -> lat, lon, altitude."""
    lat, lon = add_metres(lat0, lon0, x, -y)
    return lat, lon, alt0 + z


def transverse_mercator(lat: Column, lon: Column, lat0: Column, lon0: Column, scale: float = 100.0) -> tuple[Column, Column]:
    """(x, y) in 1 / scale metres (centimetres by default), y southwards from the origin's latitude."""
    dlon = F.radians(lon - lon0)
    phi = F.radians(lat)
    x = F.asinh(F.sin(dlon) / F.sqrt(F.tan(phi) * F.tan(phi) + F.cos(dlon) * F.cos(dlon)))
    y = F.atan(F.tan(phi) / F.cos(dlon)) - F.radians(lat0)
    return x * (TRANSVERSE_RADIUS * scale), -(y * (TRANSVERSE_RADIUS * scale))


def transverse_mercator_inverse(x: Column, y: Column, lat0: Column, lon0: Column, scale: float = 100.0) -> tuple[Column, Column]:
    """(lat, lon)"""
    xi = x / (TRANSVERSE_RADIUS * scale)
    eta = F.radians(lat0) - y / (TRANSVERSE_RADIUS * scale)
    sinh = F.sinh(xi)
    lat = F.degrees(F.atan(F.sin(eta) / F.sqrt(sinh * sinh + F.cos(eta) * F.cos(eta))))
    return lat, lon0 + F.degrees(F.atan(sinh / F.cos(eta)))


def to_local(x: Column, origin: Column) -> Column:
    return x - origin


def to_global(x: Column, origin: Column) -> Column:
    return x + origin
