"""Hard-negative mining over Hilbert-ordered candidate blocks with zone maps.

Rows are ordered along a Hilbert curve through their coarsened vectors, so that rows near each other in space are near in the order, and
written as a Parquet table of blocks of at most BLOCK rows. A block's zone map holds the least and the largest value of each dimension, and
its labels. For an anchor, interval arithmetic over a zone map bounds all inner products with the block's rows:
sum of the lesser, and of the larger, of anchor * least and anchor * largest. A block is read for an anchor only where these bounds meet
what the anchor looks for: for positives, products up to the k-th best of its own block; for negatives, the windows under its positives' products.

Spark's part: anchors are dealt to chunks and zone maps to groups, so each pair of both meets once, in a task of bounded size, which gives the blocks that each anchor
reads. Anchors of a chunk and the rows of a block they read are cogrouped; only the k best a block leave the task. Nothing is broadcast, and no task holds more
than a chunk of anchors and a block, or a group of zone maps.

Products are of whole numbers and exact. Bounds are of whole numbers as well, so no row is lost to rounding: results are those of comparing all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from roadlake.llm.common import shared_folder

#: Rows of a block; anchors of a chunk; zone maps of a group, at most (chunks and groups on average).
BLOCK, CHUNK, GROUP = 1_024, 2_048, 4_096
#: Dimensions and bits of each from which the place on the curve is computed.
DIMS, BITS = 31, 2
#: Positives of an anchor, negatives of an anchor and positive.
POSITIVES, NEGATIVES = 5, 5
#: Components over this are computed with Python's whole numbers, others in doubles, exactly (2 ** 53 and some hundred dimensions).
EXACT = 2**21

ROW = "block long, uid long, vec_id long, label int, vec array<double>"
FOUND = "anchor long, uid long, other long, score long"


def hilbert_place(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each row of cells (rows, dimensions; whole numbers under 2 ** bits) on the Hilbert curve, as long.

    Axes are turned so that each sub-cube is entered where the last one was left (Skilling's transform), then bits are interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    for level in range(bits - 1, 0, -1):
        top, low = 1 << level, (1 << level) - 1
        for axis in x:
            flip = (axis & top) != 0
            swap = np.where(flip, 0, (x[0] ^ axis) & low)
            x[0] ^= np.where(flip, low, swap)
            axis ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turned = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turned ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= turned
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in x:
            place = (place << 1) | ((axis >> level) & 1)
    return place


def _matrix(column: pd.Series) -> np.ndarray:
    """Whole numbers as doubles, or as Python's where a product or a sum of products might not fit."""
    x = np.stack(column.to_numpy())
    return x if np.abs(x).max(initial=0.0) < EXACT and x.shape[1] < 1_000 else np.array([[int(v) for v in row] for row in x], object)


def _bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) inner product of each q with anything between low and high of each zone."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def _long(x) -> int:
    return int(min(max(x, -(2**63)), 2**63 - 1))


def _top(r: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each r: larger score, then smaller id."""
    order = np.lexsort((ids, np.array([-s for s in score], score.dtype) if score.dtype == object else -score, r)) if score.dtype != object else np.array(sorted(range(len(r)), key=lambda i: (r[i], -score[i], ids[i])), np.int64)
    ordered = r[order]
    return order[np.arange(len(order)) - np.searchsorted(ordered, ordered, side="left") < k]


def _blocks(rows: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """(blocks, zones): rows in the curve's order with block and uid, written as Parquet, and a zone map of each block."""
    spark = rows.sparkSession
    dims = rows.select(F.size("vec").alias("d"), F.posexplode("vec").alias("i", "x")).groupBy("d", "i").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("spread"))
    # The widest dimensions of each length cut space; as many rows as a vector is long, whatever the table.
    wide = dims.withColumn("place", F.row_number().over(W.partitionBy("d").orderBy(F.desc("spread"), "i"))).filter(F.col("place") <= DIMS)
    cuts = {d: part.sort_values("place") for d, part in wide.toPandas().groupby("d")}

    def placed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            part = part.assign(d=part["vec"].map(len), place=0)
            for d, own in part.groupby("d"):
                cut = cuts[d]
                z = (np.stack(own["vec"].to_numpy())[:, cut["i"].to_numpy()] - cut["mean"].to_numpy()) / np.maximum(cut["spread"].to_numpy(), 1e-300)
                # Quarters of a normal distribution.
                part.loc[own.index, "place"] = hilbert_place(np.searchsorted([-0.6745, 0.0, 0.6745], z).reshape(z.shape))
            yield part

    def numbered(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, block, inside, length = TaskContext.get().partitionId() << 40, -1, BLOCK, None
        for part in parts:
            numbers = np.empty(len(part), np.int64)
            for i, d in enumerate(part["d"].to_numpy()):
                if inside == BLOCK or d != length:
                    block, inside, length = block + 1, 0, d
                numbers[i] = first + block * BLOCK + inside
                inside += 1
            yield part.assign(block=numbers // BLOCK, uid=numbers)[["block", "uid", "vec_id", "label", "vec"]]

    ordered = rows.mapInPandas(placed, "vec_id long, label int, vec array<double>, d int, place long")
    ordered = ordered.repartitionByRange("d", "place", "vec_id", F.hash("vec")).sortWithinPartitions("d", "place", "vec_id", "label", "vec")
    ordered.mapInPandas(numbered, ROW).write.parquet(f"{folder}/blocks")
    blocks = spark.read.parquet(f"{folder}/blocks")
    ends = blocks.select("block", F.posexplode("vec").alias("i", "x")).groupBy("block", "i").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    edges = ends.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("i", "low", "high"))).alias("e"))
    labels = blocks.groupBy("block").agg(F.min("label").alias("label_low"), F.max("label").alias("label_high"))
    edges.join(labels, "block").select("block", "label_low", "label_high", F.col("e.low").alias("low"), F.col("e.high").alias("high")).write.parquet(f"{folder}/zones")
    return blocks, spark.read.parquet(f"{folder}/zones")


def _chosen(asking: DataFrame, zones: DataFrame, chunks: int, groups: int, same: bool) -> DataFrame:
    """block, chunk, uid: the blocks whose zone maps meet what an anchor looks for: low to high of its products, and its label (same) or another."""

    def run(anchors: pd.DataFrame, maps: pd.DataFrame) -> pd.DataFrame:
        out = []
        for d, own in anchors.groupby(anchors["vec"].map(len)):
            met = maps[maps["low"].map(len) == d]
            if not len(met):
                continue
            low, high = _matrix(met["low"]), _matrix(met["high"])
            first, last = met["label_low"].to_numpy(), met["label_high"].to_numpy()
            for at in range(0, len(own), 256):
                part = own.iloc[at : at + 256]
                least, largest = _bounds(_matrix(part["vec"]), low, high)
                label = part["label"].to_numpy()[:, None]
                fits = (first <= label) & (label <= last) if same else (first != label) | (last != label)
                # 80 * positive <= 100 * negative is asked of the least positive, negative <= positive of the largest.
                fits &= (largest >= part["least"].to_numpy()[:, None]) & (least <= part["most"].to_numpy()[:, None])
                r, c = np.nonzero(fits.astype(bool))
                out.append(pd.DataFrame({"block": met["block"].to_numpy()[c], "chunk": part["chunk"].to_numpy()[r], "uid": part["uid"].to_numpy()[r]}))
        return pd.concat(out) if out else pd.DataFrame({"block": [], "chunk": [], "uid": []}, dtype=np.int64)

    left = asking.select("chunk", "uid", "label", "vec", "least", "most", _each(groups).alias("group"))
    right = zones.select("*", F.pmod(F.xxhash64("block"), F.lit(groups)).alias("group"), _each(chunks).alias("chunk"))
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)
    return left.groupBy("chunk", "group").cogroup(right.groupBy("chunk", "group")).applyInPandas(run, "block long, chunk long, uid long")


def _each(count: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))


def _read(asking: DataFrame, chosen: DataFrame, blocks: DataFrame, search) -> DataFrame:
    """search(anchors, rows of the block) over each chunk of anchors and each block that one of them reads."""
    wanted = chosen.select("block", "chunk").distinct()
    anchors = chosen.join(asking.drop("block", "chunk"), "uid")
    rows = wanted.join(blocks, "block")
    # New names of columns, as both sides come from the same tables.
    left, right = (x.toDF(*x.columns) for x in (anchors, rows))
    return left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInPandas(search, FOUND)


def _search(k: int, same: bool):
    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(anchors) and len(rows):
            x, ids, uids, labels = _matrix(rows["vec"]), rows["vec_id"].to_numpy(), rows["uid"].to_numpy(), rows["label"].to_numpy()
            for at in range(0, len(anchors), 256):
                part = anchors.iloc[at : at + 256]
                score = _matrix(part["vec"]) @ x.T
                own, label = part["uid"].to_numpy(), part["label"].to_numpy()[:, None]
                fits = (labels == label) & (uids != own[:, None]) if same else labels != label
                goals = [None] if same else range(part["goals"].map(len).max())
                for g in goals:
                    hit = fits
                    if g is not None:
                        goal = np.array([p[g] if g < len(p) else -1 for p in part["goals"]], score.dtype)[:, None]
                        hit = fits & (goal >= 0) & (80 * goal <= 100 * score) & (score <= goal)
                    r, c = np.nonzero(hit.astype(bool))
                    best = _top(r, score[r, c], ids[c], k)
                    r, c = r[best], c[best]
                    number = 0 if g is None else g
                    # The anchor's uid and the goal's number in one long: a uid is under 2 ** 60.
                    out.append(pd.DataFrame({"anchor": own[r] * 8 + number, "uid": uids[c], "other": ids[c], "score": [_long(s) for s in score[r, c]]}))
        return pd.concat(out) if out else pd.DataFrame({"anchor": [], "uid": [], "other": [], "score": []}, dtype=np.int64)

    return run


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score: each anchor's hard negatives for each of its positives.

    Components count as floor(scale * x), scores are whole inner products; larger scores come first, then smaller ids. Positives: the anchor's first 5 other rows
    of its label. Negatives: the first 5 rows of other labels with 80 * positive_score <= 100 * negative_score <= 100 * positive_score.

    Rows without id, label or vector, or with a null or non-finite component (scaled ones included) take no part. Exact repeats count once; rows that share an
    id and differ are rows of their own, and each asks if its id does. Only vectors of one length are compared. Scores beyond the range of long are compared
    exactly and shown as its ends. An anchor without positives, or a positive without negatives, has no rows; an empty table gives none.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("int").alias("label"), F.col(vec_col).cast("array<double>").alias("vec"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL AND size(vec) > 0")
    rows = rows.filter(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float("inf"))))
    # rint: floor() of a double is a long here, and would cut off what is beyond it.
    whole = F.transform("vec", lambda x: F.rint(x * scale) - F.when(F.rint(x * scale) > x * scale, 1.0).otherwise(0.0) + F.lit(0.0))
    rows = rows.select("vec_id", "label", whole.alias("vec"), "asks").groupBy("vec_id", "label", "vec").agg(F.max("asks").alias("asks"))
    folder = f"{shared_folder(spark)}/hard-negatives-{uuid4()}"
    blocks, zones = _blocks(rows.select("vec_id", "label", "vec"), folder)

    asking = blocks.join(rows.filter("asks").select("vec_id", "label", "vec"), ["vec_id", "label", "vec"], "left_semi")
    n_anchors, n_zones = asking.count(), zones.count()
    chunks, groups = max(1, ceil(n_anchors / CHUNK)), max(1, ceil(n_zones / GROUP))
    asking = asking.withColumn("chunk", F.pmod(F.xxhash64("uid"), F.lit(chunks)))

    # The k-th best of the anchor's own block is the least that a positive elsewhere must reach.
    best = W.partitionBy("anchor").orderBy(F.desc("score"), "other", "uid")
    near = _read(asking, asking.select("block", "chunk", "uid"), blocks, _search(POSITIVES, True))
    floor_ = near.withColumn("place", F.row_number().over(best)).filter(F.col("place") == POSITIVES).select((F.col("anchor") / 8).cast("long").alias("uid"), F.col("score").cast("double").alias("least"))
    looking = asking.join(floor_, "uid", "left").withColumns({"least": F.coalesce("least", F.lit(float("-inf"))), "most": F.lit(float("inf"))})
    found = _read(looking, _chosen(looking, zones, chunks, groups, True), blocks, _search(POSITIVES, True))
    positives = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= POSITIVES)
    positives = positives.select((F.col("anchor") / 8).cast("long").alias("uid"), (F.col("place") - 1).alias("number"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    positives.write.parquet(f"{folder}/positives")
    positives = spark.read.parquet(f"{folder}/positives")

    goals = positives.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("number", "positive_score"))).alias("g")).select("uid", F.col("g.positive_score").alias("goals"))
    windows = asking.join(goals.filter(F.array_max("goals") >= 0), "uid")
    # The bounds of an anchor's windows together; a product of 0 or more is asked, as 80 * p <= 100 * p only then.
    windows = windows.withColumns({"most": F.array_max("goals").cast("double"), "least": F.array_min(F.filter("goals", lambda p: p >= 0)).cast("double") * 0.8 - 1})
    reached = _read(windows, _chosen(windows, zones, chunks, groups, False), blocks, _search(NEGATIVES, False))
    ranked = reached.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= NEGATIVES)
    ranked = ranked.select((F.col("anchor") / 8).cast("long").alias("uid"), (F.col("anchor") % 8).cast("int").alias("number"), "rank", F.col("other").alias("negative_id"), F.col("score").alias("negative_score"))
    out = ranked.join(positives, ["uid", "number"]).join(asking.select("uid", F.col("vec_id").alias("anchor_id")), "uid")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
