"""Greedy thinning of points in a given order, in rounds: a mark stands if no earlier mark that stands is near."""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.operators.lineage import cut

#: Cells in a row of a tile; marks and what they say to the cells around them are shuffled by tiles.
TILE = 64
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def dedupe_marks(marks: DataFrame, radius: float = 2.5) -> DataFrame:
    """The marks (map_id, mark_id, x, y, z) that one pass in the order of mark_id keeps: those at least radius from every kept one before.

    Cells are a little wider than radius, so what is near a mark is in the 27 cells around it. The first undecided mark of a cell is a candidate; in each round
    a candidate is kept if it comes before those of all 27 cells, and what is near a kept mark goes; the result is that of the sequential
    pass. A mark goes once to each tile that a cell around it lies in, and meets these cells there; so a round shuffles little more than the marks, not 27 copies. A crowded cell is one candidate, not its pairs. The number of rounds is that of the longest chain of near cells in rising order; every round is checkpointed.

    Of rows alike in all five columns one is kept. A mark without a map, or with a null or non-finite coordinate, is near nothing and is kept. A null mark_id comes first.
    """
    conf = marks.sparkSession.conf
    before = conf.get(ALL_KEYS)
    conf.set(ALL_KEYS, "false")  # rounds are run here, and their joins by map, tile and cell stay in the deal by map and tile
    try:
        return _kept(marks, radius)
    finally:
        conf.set(ALL_KEYS, before)


def _kept(marks: DataFrame, radius: float) -> DataFrame:
    side, reach = radius * 1.001, (-1, 0, 1)
    known = marks.select("map_id", "mark_id", *[F.col(c).cast("double").alias(c) for c in "xyz"])
    placed = F.coalesce(reduce(Column.__and__, [F.abs(c) < float("inf") for c in "xyz"], F.col("map_id").isNotNull()), F.lit(False))
    cell = F.struct(*[F.floor(F.col(c) / side).alias(f"c{c}") for c in "xyz"])
    moved = lambda d: F.struct(*[(F.col(f"cell.c{c}") + k).alias(f"c{c}") for c, k in zip("xyz", d, strict=True)])
    tile = lambda c: F.struct(*[F.floor(c[f"c{k}"] / TILE).alias(f"t{k}") for k in "xyz"])
    place = ["map_id", "tile", "cell"]

    def told(marks: DataFrame) -> DataFrame:
        """marks (map_id, cell and more) once for each of the 27 cells around theirs: place; own where the cell is the mark's."""
        corners = F.array_distinct(F.array(*[tile(moved(d)) for d in product((-1, 1), repeat=3)]))
        dealt = marks.withColumn("tile", F.explode(corners)).repartition("map_id", "tile")
        near = F.filter(F.array(*[moved(d) for d in product(reach, repeat=3)]), lambda c: tile(c) == F.col("tile"))
        return dealt.withColumn("to", F.explode(near)).withColumn("own", F.col("to") == F.col("cell")).drop("cell").withColumnRenamed("to", "cell")

    left = cut(known.filter(placed).withColumn("cell", cell).withColumn("tile", tile(F.col("cell"))).repartition("map_id", "tile"))
    found = [known.filter(~placed).distinct()]
    while not left.isEmpty():
        first = left.groupBy(*place).agg(F.min(F.struct("mark_id", "x", "y", "z")).alias("f")).drop("tile")
        heard = told(first).groupBy(*place).agg(F.min("f").alias("least"), F.min(F.when(F.col("own"), F.col("f"))).alias("f"))
        kept = cut(heard.filter(F.col("f") == F.col("least")).select("map_id", "cell", "f.*"))
        found.append(kept.drop("cell"))
        near = told(kept).select(*place, *[F.col(c).alias(f"k{c}") for c in "xyz"])  # kept marks are apart, so a cell meets a bounded number
        d2 = sum(((F.col(c) - F.col(f"k{c}")) * (F.col(c) - F.col(f"k{c}")) for c in "xyz"), F.lit(0.0))
        # A kept mark is at distance 0 from itself and leaves with the others.
        gone = reduce(Column.__and__, [left[c] == near[c] for c in place]) & (F.sqrt(d2) < radius)
        left = cut(left.join(near, gone, "left_anti"))
    return reduce(DataFrame.unionByName, found)
