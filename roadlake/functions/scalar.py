"""Scalar functions on columns: polynomials, vectors, rotations, lane and signal dictionaries, tile ids."""

from __future__ import annotations

from collections import namedtuple

from pyspark.sql import Column
from pyspark.sql import functions as F

Num = Column | float
Vec = namedtuple("Vec", "x y z")
Rot = namedtuple("Rot", "pitch yaw roll")


def poly_eval(a: Num, b: Num, c: Num, d: Num, ds: Num) -> Column:
    return a + ds * (b + ds * (c + ds * d))


def poly_tangent(b: Num, c: Num, d: Num, ds: Num) -> Column:
    return b + ds * (2.0 * c + 3.0 * d * ds)


def poly_add(p: list[Num], q: list[Num]) -> list[Num]:
    return [x + y for x, y in zip(p, q, strict=True)]


def poly_scale(p: list[Num], k: Num) -> list[Num]:
    return [x * k for x in p]


def clamp(x: Column, low: Num, high: Num) -> Column:
    return F.greatest(F.lit(low) if not isinstance(low, Column) else low, F.least(x, F.lit(high) if not isinstance(high, Column) else high))


def lerp(a: Num, b: Num, f: Num) -> Column:
    return a + (b - a) * f


def dot2(ax: Num, ay: Num, bx: Num, by: Num) -> Column:
    return ax * bx + ay * by


def dot3(a: Vec, b: Vec) -> Column:
    return a.x * b.x + a.y * b.y + a.z * b.z


def cross3(a: Vec, b: Vec) -> Vec:
    return Vec(a.y * b.z - a.z * b.y, a.z * b.x - a.x * b.z, a.x * b.y - a.y * b.x)


def dist2d_sq(ax: Num, ay: Num, bx: Num, by: Num) -> Column:
    return (bx - ax) * (bx - ax) + (by - ay) * (by - ay)


def dist2d(ax: Num, ay: Num, bx: Num, by: Num) -> Column:
    return F.sqrt(dist2d_sq(ax, ay, bx, by))


def dist3d_sq(a: Vec, b: Vec) -> Column:
    return dist2d_sq(a.x, a.y, b.x, b.y) + (b.z - a.z) * (b.z - a.z)


def dist3d(a: Vec, b: Vec) -> Column:
    return F.sqrt(dist3d_sq(a, b))


def vec_length(a: Vec) -> Column:
    return F.sqrt(dot3(a, a))


def safe_unit(a: Vec, eps: float = 1e-12) -> Vec:
    """Unit vector; vectors no longer than eps stay as they are."""
    n = vec_length(a)
    return Vec(*(F.when(n > eps, c / n).otherwise(c) for c in a))


def vector_angle(a: Vec, b: Vec) -> Column:
    return F.acos(clamp(dot3(a, b) / (vec_length(a) * vec_length(b)), -1.0, 1.0))


def point_to_segment(px: Num, py: Num, ax: Num, ay: Num, bx: Num, by: Num) -> tuple[Column, Column]:
    """(distance along the segment, distance to it) in the plane; a segment without length gives (0, distance to its point)."""
    l2 = dist2d_sq(ax, ay, bx, by)
    t = F.when(l2 > 0, clamp(dot2(px - ax, py - ay, bx - ax, by - ay) / l2, 0.0, 1.0)).otherwise(F.lit(0.0))
    return t * F.sqrt(l2), dist2d(ax + t * (bx - ax), ay + t * (by - ay), px, py)


def point_to_arc(px: Num, py: Num, ax: Num, ay: Num, length: Num, heading: Num, curvature: Num) -> tuple[Column, Column]:
    """(distance along the arc, distance to it). The centre gives (0, radius); outside the sweep the nearer end counts."""
    radius = 1.0 / F.abs(curvature)
    side = F.signum(curvature)
    cx, cy = ax - side * radius * F.sin(heading), ay + side * radius * F.cos(heading)
    from_centre = dist2d(cx, cy, px, py)
    turned = side * (F.atan2(py - cy, px - cx) - F.atan2(ay - cy, ax - cx))
    two_pi = 6.283185307179586
    turned = turned - two_pi * F.floor(turned / two_pi)
    along = turned * radius
    end = heading + curvature * length
    ex, ey = cx + side * radius * F.sin(end), cy - side * radius * F.cos(end)
    to_start, to_end = dist2d(ax, ay, px, py), dist2d(ex, ey, px, py)
    out_along = F.when(to_start <= to_end, F.lit(0.0)).otherwise(length)
    inside = along <= length
    at_centre = from_centre < 1e-12
    return (
        F.when(at_centre, F.lit(0.0)).when(inside, along).otherwise(out_along),
        F.when(at_centre, radius).when(inside, F.abs(from_centre - radius)).otherwise(F.least(to_start, to_end)),
    )


def rotate2d(x: Num, y: Num, angle: Num) -> tuple[Column, Column]:
    return x * F.cos(angle) - y * F.sin(angle), x * F.sin(angle) + y * F.cos(angle)


def _matrix(r: Rot) -> list[list[Column]]:
    """Rows of the rotation matrix; angles in degrees, yaw then pitch then roll, in a left-handed frame with z up."""
    cp, sp, cy, sy, cr, sr = (f(F.radians(a)) for a in (r.pitch, r.yaw, r.roll) for f in (F.cos, F.sin))
    return [
        [cp * cy, cy * sp * sr - sy * cr, -(cy * sp * cr) - sy * sr],
        [cp * sy, sy * sp * sr + cy * cr, -(sy * sp * cr) + cy * sr],
        [sp, -(cp * sr), cp * cr],
    ]


def rotate(v: Vec, r: Rot) -> Vec:
    return Vec(*(row[0] * v.x + row[1] * v.y + row[2] * v.z for row in _matrix(r)))


def rotate_back(v: Vec, r: Rot) -> Vec:
    m = _matrix(r)
    return Vec(*(m[0][i] * v.x + m[1][i] * v.y + m[2][i] * v.z for i in range(3)))


def forward(r: Rot) -> Vec:
    return Vec(*(row[0] for row in _matrix(r)))


def right(r: Rot) -> Vec:
    return Vec(*(row[1] for row in _matrix(r)))


def up(r: Rot) -> Vec:
    return Vec(*(row[2] for row in _matrix(r)))


def transform_point(v: Vec, location: Vec, r: Rot) -> Vec:
    return Vec(*(a + b for a, b in zip(rotate(v, r), location, strict=True)))


def inverse_transform_point(v: Vec, location: Vec, r: Rot) -> Vec:
    return rotate_back(Vec(*(a - b for a, b in zip(v, location, strict=True))), r)


def transform_matrix(location: Vec, r: Rot) -> Column:
    """The 4 x 4 matrix by rows, as an array of 16 numbers."""
    rows = [[*row, t] for row, t in zip(_matrix(r), location, strict=True)]
    return F.array(*[x for row in rows for x in row], F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))


def int_range(a: Column, b: Column) -> Column:
    """All integers from a to b, both included, upwards or downwards."""
    return F.sequence(a, b)


def wildcard_match(text: Column, pattern: str) -> Column:
    """Shell wildcards: * any run, ? any one character."""
    import re

    return text.rlike("^(?s:" + "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in pattern) + ")$")


# Lane types by the number of their bit.
LANE_TYPES = (
    "driving stop shoulder biking sidewalk border restricted parking bidirectional median special1 special2 special3 roadworks tram rail entry exit offramp onramp"
).split()
LANE_BITS = {"none": 1} | {name: 2 << i for i, name in enumerate(LANE_TYPES)}
ANY_LANE = -2


def lane_type_bit(text: Column) -> Column:
    """Bit of a lane type's name, in any case; unknown names are none."""
    table = F.create_map(*[F.lit(x) for pair in LANE_BITS.items() for x in pair])
    return F.coalesce(table[F.lower(text)], F.lit(1))


# Shown names that are not the capitalised type.
SHOWN = {"roadworks": "RoadWorks", "offramp": "OffRamp", "onramp": "OnRamp"}


def lane_type_name(bit: Column) -> Column:
    table = F.create_map(*[F.lit(x) for name, b in LANE_BITS.items() if b > 1 for x in (b, SHOWN.get(name, name.capitalize()))])
    return F.when(bit == ANY_LANE, F.lit("Any")).otherwise(F.coalesce(table[bit], F.lit("Empty")))


def of_lane_type(bit: Column, mask: int) -> Column:
    return bit.bitwiseAND(F.lit(mask)) != 0


def mark_colour(colour: Column) -> Column:
    return F.when(F.lower(colour) == "yellow", F.lit("yellow")).otherwise(F.lit("white"))


def lane_change_flags(text: Column) -> Column:
    """1 right (increase), 2 left (decrease), 3 both, 0 none; unknown text allows both."""
    t = F.lower(text)
    return F.when(t == "increase", 1).when(t == "decrease", 2).when(t == "none", 0).otherwise(3)


def signal_side(orientation: Column) -> Column:
    return F.when(orientation == "+", F.lit("positive")).when(orientation == "-", F.lit("negative")).otherwise(F.lit("both"))


def waypoint_key(road: Column, section: Column, lane: Column, s: Column) -> Column:
    return F.xxhash64(road, section, lane, F.floor(s * 200))


def tile_pack(x: Column, y: Column) -> Column:
    return F.shiftleft(x.cast("long"), 32).bitwiseOR(y.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))


def tile_unpack(tile: Column) -> tuple[Column, Column]:
    return F.shiftright(tile, 32).cast("int"), F.shiftright(F.shiftleft(tile, 32), 32).cast("int")


def tile_name(x: Column, y: Column, base: str = "Map") -> Column:
    return F.format_string(f"{base}_Tile_%d_%d", x.cast("int"), y.cast("int"))


def tidy(x: Column, digits: int = 4) -> Column:
    """Rounded for output, without negative zero."""
    return F.round(x, digits) + F.lit(0.0)
