"""Meshes with fewer triangles: vertices of a cell become one, placed by the planes of the triangles around it."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from roadlake.operators.lineage import cut, land

MESH = ["map_id", "mesh_id"]
GRID = ["lx", "ly", "lz", "fine", "level"]
#: Places of a symmetric 3 x 3 matrix.
PAIRS = [(0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2)]
#: Halvings of a mesh's largest extent: the finest cell is 2^-BITS of it, the coarsest the whole.
BITS = 20
#: Weight of a cell's mean place against its planes, as a share of the planes' trace; it decides where the planes leave a direction open.
PULL = 1e-3
#: Buckets in which the vertices of a mesh are numbered.
BUCKETS = 1024
#: Meshes whose grids are sent to every task.
SENT_MESHES = 100_000


def _bit_length(x: Column) -> Column:
    return F.when(x > 0, F.length(F.bin(x))).otherwise(0)


def _finite(columns: list[str]) -> Column:
    return F.coalesce(reduce(Column.__and__, [F.abs(F.col(c)) < float("inf") for c in columns]), F.lit(False))


def grids(vertices: DataFrame) -> DataFrame:
    """lx, ly, lz, fine of each mesh: its lower corner and the side of the finest cells. Vertices without a finite place do not count."""
    low = {f"l{c}": F.min(c) for c in "xyz"} | {f"h{c}": F.max(c) for c in "xyz"}
    boxes = vertices.filter(_finite(["x", "y", "z"])).groupBy(*MESH).agg(*[e.alias(n) for n, e in low.items()])
    return boxes.withColumn("fine", F.greatest(*[F.col(f"h{c}") - F.col(f"l{c}") for c in "xyz"]) / 2**BITS).drop("hx", "hy", "hz")


def fine_cell(prefix: str = "") -> Column:
    """The finest cell of a place in its mesh's grid: its numbers along x, y and z, from 0, as one long of three times BITS bits, which sorts as they do."""
    at = lambda c: F.when(F.col("fine") > 0, F.least(F.floor((F.col(f"{prefix}{c}") - F.col(f"l{c}")) / F.col("fine")), F.lit(2**BITS - 1))).otherwise(0).cast("long")
    return F.shiftleft(at("x"), 2 * BITS) + F.shiftleft(at("y"), BITS) + at("z")


def along(cell: Column) -> dict[str, Column]:
    """The numbers of a cell along x, y and z."""
    return {c: F.shiftright(cell, k * BITS).bitwiseAND(F.lit(2**BITS - 1)) for c, k in zip("xyz", (2, 1, 0), strict=True)}


def coarse_cell(prefix: str = "") -> Column:
    """The cell of a place after as many halvings are undone as the mesh's level says."""
    x, y, z = (F.call_function("shiftright", n, F.col("level")) for n in along(fine_cell(prefix)).values())
    return F.shiftleft(x, 2 * BITS) + F.shiftleft(y, BITS) + z


def _with_grid(df: DataFrame, grid: DataFrame, rows: int) -> DataFrame:
    """df with its mesh's row of grid: meshes may be few and have most of the rows, so a grid that may be sent to all tasks is, and df is not dealt by mesh."""
    return df.join(F.broadcast(grid) if rows <= SENT_MESHES else grid, MESH)


def with_corners(triangles: DataFrame, vertices: DataFrame, columns: list[str]) -> DataFrame:
    """triangles with a_, b_ and c_ columns of their vertices; a triangle with a vertex that is not there is left out."""
    out = triangles
    for k in "abc":
        out = out.join(vertices.select(*MESH, F.col("vertex").alias(k), *[F.col(c).alias(f"{k}_{c}") for c in columns]), [*MESH, k])
    return out


def cell_levels(cornered: DataFrame, ratio: float, asked: DataFrame) -> DataFrame:
    """level of each mesh: the fewest halvings undone (0 the finest cells) after which at most ratio of the triangles of asked have three corners in different cells.

    cornered has a_fine, b_fine, c_fine. Cells are nested, so a triangle lasts up to one level, given by the bits in which its corners' cells differ; a mesh is counted as a histogram of BITS + 1 rows.
    """

    def apart(p: str, q: str) -> Column:
        return reduce(Column.bitwiseOR, along(F.col(f"{p}_fine").bitwiseXOR(F.col(f"{q}_fine"))).values())

    lasts = _bit_length(F.least(*[apart(p, q) for p, q in ("ab", "bc", "ca")]))
    steps = cornered.groupBy(*MESH, lasts.alias("lasts")).agg(F.count(F.lit(1)).alias("n"))
    steps = steps.withColumn("left", F.sum("n").over(W.partitionBy(*MESH).orderBy(F.desc("lasts"))))
    allowed = asked.groupBy(*MESH).agg(F.floor(F.count(F.lit(1)) * ratio).alias("allowed"))
    # At level k the triangles with lasts > k are left; the lowest k is the greatest lasts whose running count is too many.
    many = steps.join(allowed, MESH).groupBy(*MESH).agg(F.coalesce(F.max(F.when(F.col("left") > F.col("allowed"), F.col("lasts"))), F.lit(0)).alias("level"))
    return many


def _solve(a: list[list[Column]], b: list[Column]) -> list[Column]:
    """The solution of a symmetric 3 x 3 system by cofactors."""
    cof = lambda i, j: a[(i + 1) % 3][(j + 1) % 3] * a[(i + 2) % 3][(j + 2) % 3] - a[(i + 1) % 3][(j + 2) % 3] * a[(i + 2) % 3][(j + 1) % 3]
    det = a[0][0] * cof(0, 0) + a[0][1] * cof(0, 1) + a[0][2] * cof(0, 2)
    return [(b[0] * cof(0, j) + b[1] * cof(1, j) + b[2] * cof(2, j)) / det for j in range(3)]


def _planes() -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A function of batches: triangles with corners and their mesh's grid -> the sums of their planes for each cell: weights q and right side r.

    A normal is of twice the area; its square divided by its length weighs by area. Places are taken from the middle of their cell, which is known from its number, so sums over
    a far-off cell keep their digits and no triangle waits for its cells' means.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = batch[[f"{k}_{c}" for k in "abc" for c in "xyz"]].to_numpy(float).reshape(-1, 3, 3)
            low, fine, level = batch[["lx", "ly", "lz"]].to_numpy(float)[:, None, :], batch["fine"].to_numpy(float)[:, None, None], batch["level"].to_numpy(np.int64)[:, None, None]
            normal = np.cross(at[:, 1] - at[:, 0], at[:, 2] - at[:, 0])
            size = np.sqrt((normal * normal).sum(1))
            held = size > 0
            at, low, fine, level, normal, size = at[held], low[held], fine[held], level[held], normal[held], size[held]
            index = np.where(fine > 0, np.minimum(np.floor((at - low) / np.where(fine > 0, fine, 1)), 2**BITS - 1), 0).astype(np.int64) >> level
            off = (normal[:, None, :] * (at - (low + (index + 0.5) * 2.0**level * fine))).sum(2) / size[:, None]
            out = batch.loc[held, MESH].iloc[np.repeat(np.arange(len(at)), 3)].reset_index(drop=True)
            out["cell"] = ((index[:, :, 0] << 2 * BITS) + (index[:, :, 1] << BITS) + index[:, :, 2]).ravel()
            for i, j in PAIRS:
                out[f"q{i}{j}"] = np.repeat(normal[:, i] * normal[:, j] / size, 3)
            for i in range(3):
                out[f"r{i}"] = (normal[:, i, None] * off).ravel()
            yield out.groupby([*MESH, "cell"], sort=False).sum().reset_index()

    return run


def decimate(vertices: DataFrame, triangles: DataFrame, ratio: float) -> tuple[DataFrame, DataFrame]:
    """At most ratio of each mesh's triangles: vertices (MESH, vertex from 0, x, y, z, n_merged), triangles (MESH, tri: the least old number, a, b, c).

    vertices: MESH, vertex (one row each), x, y, z; triangles: MESH, tri, a, b, c. A triangle with a vertex that is not there or has no finite place goes, but counts for the ratio. See decimate_corners.
    """
    # Written once: three branches read the corners.
    held, triangles = land(vertices.filter(_finite(["x", "y", "z"])).select(*MESH, "vertex", "x", "y", "z")), land(triangles.select(*MESH, "tri", *"abc"))
    return decimate_corners(held, land(with_corners(triangles, held, ["x", "y", "z"])), triangles, ratio)


def decimate_corners(vertices: DataFrame, cornered: DataFrame, asked: DataFrame, ratio: float) -> tuple[DataFrame, DataFrame]:
    """decimate, for triangles that have their corners' places: cornered has MESH, a_x to c_z and, if wanted in the result, tri; asked has a row of MESH for each triangle that counts for the ratio.

    Vertices are merged by cells of a grid over the mesh, the finest of nested ones that meets the ratio. A merged
    vertex lies where the squared distances to the planes of all triangles at its cell, weighed by area, are least, drawn a little to the mean of the cell's vertices, and within the box of these.
    Triangles with two corners in one cell go; of those with the same three corners in the same turn the first stays. Vertices without a triangle go too. A triangle with a corner that
    has no finite place goes, but counts for the ratio. Meshes too small for one triangle lose all; null mesh ids take no part. Triangles are not shuffled: levels, faces and planes are counts and sums
    made where the triangles are read, so what is shuffled are cells, and no mesh is one task. vertices and cornered are read two and three times, so they should be cheap to read.
    """
    grid = cut(grids(vertices))
    n = grid.count()
    cornered = cornered.filter(_finite([f"{k}_{c}" for k in "abc" for c in "xyz"]))
    levels = cell_levels(_with_grid(cornered, grid, n).select(*MESH, *[fine_cell(f"{k}_").alias(f"{k}_fine") for k in "abc"]), ratio, asked)
    grid = cut(grid.join(levels, MESH))
    # An aggregate of sums is small where a cell has many vertices; MESH and cell name a cell.
    means = _with_grid(vertices.filter(_finite(["x", "y", "z"])), grid, n).groupBy(*MESH, coarse_cell().alias("cell")).agg(
        F.count(F.lit(1)).alias("n_merged"), *[F.avg(c).alias(f"m{c}") for c in "xyz"], *[F.min(c).alias(f"low_{c}") for c in "xyz"], *[F.max(c).alias(f"high_{c}") for c in "xyz"]
    )
    celled = _with_grid(cornered, grid, n).withColumns({f"{k}_cell": coarse_cell(f"{k}_") for k in "abc"})

    last = celled.filter("a_cell <> b_cell AND b_cell <> c_cell AND a_cell <> c_cell")
    least = F.least("a_cell", "b_cell", "c_cell")
    turned = {o: F.when(least == F.col("a_cell"), F.col(f"{p}_cell")).when(least == F.col("b_cell"), F.col(f"{q}_cell")).otherwise(F.col(f"{r}_cell")) for o, p, q, r in zip("abc", "abc", "bca", "cab", strict=True)}
    faces = last.groupBy(*MESH, *[e.alias(o) for o, e in turned.items()])
    faces = cut(faces.agg(F.min("tri").alias("tri")) if "tri" in cornered.columns else faces.agg(F.count(F.lit(1)).alias("n")).drop("n"))

    double = [*[f"q{i}{j}" for i, j in PAIRS], *[f"r{i}" for i in range(3)]]
    types = {f.name: f.dataType.simpleString() for f in cornered.schema}
    schema = ", ".join([f"{c} {types[c]}" for c in MESH] + ["cell long"] + [f"{c} double" for c in double])
    places = _with_grid(cornered, grid, n).select(*MESH, *GRID, *[f"{k}_{c}" for k in "abc" for c in "xyz"])
    planes = places.mapInPandas(_planes(), schema).groupBy(*MESH, "cell").agg(*[F.sum(c).alias(c) for c in double])

    used = faces.select(*MESH, F.explode(F.array("a", "b", "c")).alias("cell")).distinct()
    got = _with_grid(means.join(used, [*MESH, "cell"], "left_semi").join(planes, [*MESH, "cell"], "left"), grid, n)
    q = lambda i, j: F.col(f"q{min(i, j)}{max(i, j)}")
    pull = (q(0, 0) + q(1, 1) + q(2, 2)) * PULL
    off = [F.col(f"m{c}") - (F.col(f"l{c}") + (k + F.lit(0.5)) * F.pow(F.lit(2.0), F.col("level")) * F.col("fine")) for c, k in along(F.col("cell")).items()]
    from_mean = [F.col(f"r{i}") - sum((q(i, j) * off[j] for j in range(3)), F.lit(0.0)) for i in range(3)]
    moved = _solve([[q(i, j) + pull if i == j else q(i, j) for j in range(3)] for i in range(3)], from_mean)
    place = {c: F.greatest(F.col(f"low_{c}"), F.least(F.col(f"high_{c}"), F.col(f"m{c}") + F.coalesce(moved[i], F.lit(0.0)))) for i, c in enumerate("xyz")}
    points = cut(got.select(*MESH, "cell", "n_merged", *[e.alias(c) for c, e in place.items()]))

    of = along(F.col("cell"))
    bucketed = points.withColumn("bucket", (of["x"] * 73 + of["y"] * 149 + of["z"] * 31) % BUCKETS)
    sizes = bucketed.groupBy(*MESH, "bucket").agg(F.count(F.lit(1)).alias("size"))
    starts = sizes.select(*MESH, "bucket", (F.sum("size").over(W.partitionBy(*MESH).orderBy("bucket")) - F.col("size")).alias("start"))
    ranked = bucketed.withColumn("rank", F.row_number().over(W.partitionBy(*MESH, "bucket").orderBy("cell")) - 1).join(starts, [*MESH, "bucket"])
    numbered = cut(ranked.select(*MESH, (F.col("start") + F.col("rank")).alias("vertex"), "x", "y", "z", "n_merged", "cell"))
    numbers = numbered.select(*MESH, "cell", "vertex")
    for k in "abc":
        faces = faces.join(numbers.withColumnsRenamed({"cell": k, "vertex": f"{k}_number"}), [*MESH, k])
    rest = [c for c in ("tri",) if c in cornered.columns]
    return numbered.drop("cell"), faces.select(*MESH, *rest, *[F.col(f"{k}_number").alias(k) for k in "abc"])
