"""Distance grids of junctions in a narrow band around their lanes, and the grid cells that a surface passes through."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions.scalar import lerp, point_to_segment
from roadlake.operators.lineage import land

FIELD = ["map_id", "junction_id"]
#: Samples and cells are dealt by tiles of TILE x TILE samples.
TILED = [*FIELD, "ti", "tj"]
TILE = 64
#: So many samples, counted once for each part of a segment, are one task's.
TASK = 1 << 21
#: Segments are cut into parts of so many cells, so that the box of a slanting one holds few samples.
PART = 8
#: Width of the band outside the lanes, in cells: over the diagonal of a cell's base, so that every corner of a cell that meets a lane is known.
BAND = 1.51
# Steps (i, j, k) from a cell's first corner to each of its eight corners, in the order of the mask's bits.
CORNERS = ((0, 0, 0), (1, 0, 0), (1, 0, 1), (0, 0, 1), (0, 1, 0), (1, 1, 0), (1, 1, 1), (0, 1, 1))


def _tiles(low: Column, high: Column, halo: int) -> Column:
    """The tiles along an axis that hold samples from low to high, or have them within halo."""
    return F.sequence(F.floor((low - halo) / TILE), F.floor((high + halo) / TILE))


def _pairs(along_i: Column, along_j: Column) -> Column:
    return F.flatten(F.transform(along_i, lambda ti: F.transform(along_j, lambda tj: F.struct(ti.alias("ti"), tj.alias("tj")))))


def tiled_grid(segments: DataFrame, step: float = 0.5, band: float = BAND, halo: int = 1) -> DataFrame:
    """The grid of junction_distance_grid, dealt by tiles: FIELD, ti, tj, i, j, d. A tile has its own TILE x TILE samples and those of other tiles up to halo samples around.

    Only segments are shuffled, once for each tile that they reach; samples are made after that, in as many tasks as keep one task's minima in memory.
    """
    numbers = ["x0", "y0", "x1", "y1", "width"]
    named = segments.select(*FIELD, *[F.col(c).cast("double").alias(c) for c in numbers]).na.drop()
    finite = land(named.filter(" AND ".join(f"abs({c}) < double('infinity')" for c in numbers)))
    n = F.greatest(F.ceil(F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) / (PART * step)), F.lit(1)).cast("int")
    whole = finite.select(*FIELD, "x0", "y0", "x1", "y1", (F.greatest("width", F.lit(0.0)) / 2.0).alias("half"), n.alias("n"))
    samples = whole.agg(F.sum(F.col("n") * F.pow(2.0 * (F.col("half") / step + band) + PART, 2.0))).first()[0]
    tasks = max(segments.sparkSession.sparkContext.defaultParallelism, math.ceil((samples or 0) / TASK))

    reach = F.col("half") + band * step
    ends = lambda a, part: [lerp(F.col(f"{a}0"), F.col(f"{a}1"), (part - 1 + e) / F.col("n")) for e in (0, 1)]
    low = lambda p: F.ceil((F.least(*p) - reach) / step).cast("long")
    high = lambda p: F.floor((F.greatest(*p) + reach) / step).cast("long")
    span = lambda p: _tiles(low(p), high(p), halo)
    met = F.flatten(F.transform(F.sequence(F.lit(1), F.col("n")), lambda part: _pairs(span(ends("x", part)), span(ends("y", part)))))
    dealt = whole.withColumn("tile", F.explode(F.array_distinct(met))).select(*whole.columns, "tile.*").repartition(tasks, *FIELD, "ti", "tj")
    part = F.col("part")
    parts = dealt.withColumn("part", F.explode(F.sequence(F.lit(1), F.col("n"))))
    cut = parts.select(*FIELD, "ti", "tj", "half", *[e.alias(f"{a}{m}") for a in "xy" for m, e in enumerate(ends(a, part))])
    box = {f"{way}_{a}": e for a, t in (("x", "ti"), ("y", "tj")) for way, e in (("low", F.greatest(low([f"{a}0", f"{a}1"]), F.col(t) * TILE - halo)), ("high", F.least(high([f"{a}0", f"{a}1"]), F.col(t) * TILE + (TILE - 1 + halo))))}
    inside = cut.withColumns(box).filter("low_x <= high_x AND low_y <= high_y")
    placed = inside.withColumn("i", F.explode(F.sequence("low_x", "high_x"))).withColumn("j", F.explode(F.sequence("low_y", "high_y")))
    _, off = point_to_segment(F.col("i") * step, F.col("j") * step, F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    near = placed.withColumn("d", F.round(off - F.col("half"), 6)).filter(F.col("d") <= band * step)
    return near.groupBy(*TILED, "i", "j").agg(F.min("d").alias("d"))


def junction_distance_grid(segments: DataFrame, step: float = 0.5, band: float = BAND) -> DataFrame:
    """Signed distance to the nearest lane border at the grid's samples (i * step, j * step): FIELD, i, j, d (6 decimals, negative on a lane).

    segments: FIELD, x0, y0, x1, y1, width: straight centre lines of the lanes. Samples farther than band cells from every lane have no row; all others are exact there: the least over all
    segments, also within lanes that overlap. The work follows the lanes' area, not the junction's box, and a junction with most lanes is dealt by tiles of samples.
    A segment without length is a disc; null or non-finite numbers and null ids give nothing, and a negative width counts as 0.
    """
    return tiled_grid(segments, step, band, 0).drop("ti", "tj")


def slab(grid: DataFrame, step: float, thickness: float, layers: int = 1) -> DataFrame:
    """The lanes as a slab in three dimensions: FIELD (and the tiles of a tiled grid), i, j, k in -layers..layers, value (not negative within the slab, whose half height is thickness)."""
    k = F.explode(F.sequence(F.lit(-layers).cast("long"), F.lit(layers).cast("long")))
    return grid.withColumn("k", k).select(*[c for c in TILED if c in grid.columns], "i", "j", "k", (-F.greatest("d", F.abs(F.col("k")) * step - thickness)).alias("value"))


def _owned(rows: DataFrame, before: int = 0) -> DataFrame:
    """Rows whose i and j are those of the tile's own samples, or up to before samples before them."""
    return rows.filter(" AND ".join(f"{c} BETWEEN {t} * {TILE} - {before} AND {t} * {TILE} + {TILE - 1}" for c, t in (("i", "ti"), ("j", "tj"))))


def _surface_cells(field: DataFrame, level: float) -> DataFrame:
    """Cells that the surface passes through, of each tile and one row before it: TILED, i, j, k, mask, v0 to v7 (values at the corners).

    A field without tiles is dealt by them, each sample with those of the tiles around that need it; a tiled one is not shuffled again.
    """
    known = field.filter("value IS NOT NULL AND NOT isnan(value)")
    if "ti" not in field.columns:
        tiles = _pairs(_tiles(F.col("i"), F.col("i"), 1), _tiles(F.col("j"), F.col("j"), 1))
        known = known.withColumn("tile", F.explode(tiles)).select(*FIELD, "tile.*", "i", "j", "k", "value").repartition(*TILED)
    to = F.array(*[F.struct((F.col("i") - a).alias("i"), (F.col("j") - b).alias("j"), (F.col("k") - c).alias("k"), F.lit(1 << bit).alias("bit")) for bit, (a, b, c) in enumerate(CORNERS)])
    sent = _owned(known.select(*TILED, "value", F.explode(to).alias("c")).select(*TILED, "c.*", "value"), 1)
    values = [F.max(F.when(F.col("bit") == 1 << b, F.col("value"))).alias(f"v{b}") for b in range(8)]
    cells = sent.groupBy(*TILED, "i", "j", "k").agg(F.sum(F.when(F.col("value") < level, F.col("bit")).otherwise(0)).cast("int").alias("mask"), F.count(F.lit(1)).alias("known"), *values)
    return cells.filter((F.col("known") == 8) & ~F.col("mask").isin(0, 255)).drop("known")


def classify_cells(field: DataFrame, level: float = 0.0) -> DataFrame:
    """Cells that the surface value = level passes through: FIELD, i, j, k of the first corner, mask, whose bit b is set where corner b lies below the level.

    field: FIELD, i, j, k, value, one row a sample, or the same in tiles with a halo of 1 (tiled_grid). A corner at the level is not below. Cells with a corner that is not there, or whose value
    is null or NaN, are left out, as are those with all corners on one side. Each sample is sent to its eight cells within its tile, so cells are not shuffled.
    """
    return _owned(_surface_cells(field, level)).select(*FIELD, "i", "j", "k", "mask")


#: Edges of a cell: axis, step along it, first corner.
EDGES = [(a, tuple(1 if n == a else 0 for n in range(3)), c) for a in range(3) for c in CORNERS if c[a] == 0]


def surface_crossings(field: DataFrame, level: float = 0.0) -> DataFrame:
    """edge_crossings of the field's own cells (classify_cells), found within tiles, so that neither cells nor edges are shuffled or joined."""
    number = {c: b for b, c in enumerate(CORNERS)}
    end = lambda c, d: number[tuple(p + q for p, q in zip(c, d, strict=True))]
    bit = lambda b: F.col("mask").bitwiseAND(F.lit(1 << b)).cast("boolean")
    cut = F.array(*[F.when(bit(number[c]) != bit(end(c, d)), F.struct(F.lit(a).alias("axis"), *[(F.col(n) + c[m]).alias(n) for m, n in enumerate("ijk")], F.col(f"v{number[c]}").alias("a"), F.col(f"v{end(c, d)}").alias("b"))) for a, d, c in EDGES])
    edges = _owned(_surface_cells(field, level).select(*TILED, F.explode(cut).alias("e")).filter("e IS NOT NULL").select(*TILED, "e.*"))
    once = edges.groupBy(*TILED, "axis", "i", "j", "k").agg(F.first("a").alias("a"), F.first("b").alias("b"))
    return once.select(*FIELD, "axis", "i", "j", "k", ((level - F.col("a")) / (F.col("b") - F.col("a"))).alias("share"))


def edge_crossings(field: DataFrame, cells: DataFrame, level: float = 0.0) -> DataFrame:
    """Where the surface cuts the edges of cells (from classify_cells): FIELD, axis (0 to 2), i, j, k of the edge's first sample, share (of the edge before the cut, 0 to 1).

    An edge is cut where one end is below the level and the other is not; its place is linear in the values. Edges that cells share stand once.
    """
    bit = {c: 1 << b for b, c in enumerate(CORNERS)}
    split = lambda c, d: F.col("mask").bitwiseAND(F.lit(bit[c])).cast("boolean") != F.col("mask").bitwiseAND(F.lit(bit[tuple(p + q for p, q in zip(c, d, strict=True))])).cast("boolean")
    cut = F.array(*[F.when(split(c, d), F.struct(F.lit(a).alias("axis"), *[(F.col(n) + c[m]).alias(n) for m, n in enumerate("ijk")])) for a, d, c in EDGES])
    asked = cells.select(*FIELD, F.explode(cut).alias("e")).filter("e IS NOT NULL").select(*FIELD, "e.*").distinct()
    ends = asked.withColumns({f"{n}1": F.col(n) + (F.col("axis") == m).cast("long") for m, n in enumerate("ijk")})
    first = ends.join(field.select(*FIELD, "i", "j", "k", F.col("value").alias("v0")), [*FIELD, "i", "j", "k"])
    both = first.join(field.select(*FIELD, *[F.col(n).alias(f"{n}1") for n in "ijk"], F.col("value").alias("v1")), [*FIELD, "i1", "j1", "k1"])
    return both.select(*FIELD, "axis", "i", "j", "k", ((level - F.col("v0")) / (F.col("v1") - F.col("v0"))).alias("share"))
