"""Approximate nearest neighbours (largest inner product) by multi-index hashing.

Codes: vectors are extended by one coordinate so that inner product becomes an angle, projected on principal axes and
turned by rotations learned to lose least when only signs are kept; the signs are the code. Where the vectors have fewer
dimensions than the code has bits, several rotations, each learned from another start, lie side by side. A code is split into substrings
and every substring is indexed. If two codes differ in at most r bits, one of m substrings differs in at most floor(r / m) of its bits, so
probing the buckets within that distance retrieves every code within r; these are verified on all bits, and only those within r are
reranked by exact inner product.

r is learned: the true neighbours of a bounded set of sample queries are found among all rows, and r is the least radius that
holds ``target`` of them. Where fewer than k codes of a block lie within r, the radius grows for that query in that block.

Spark's part: rows are coded in one pass. Base rows are dealt to blocks by hash and the stated queries, in chunks, meet every block; with
blocks and chunks of tens of thousands of rows, each is copied once for tens of thousands of the other side's. A block's index is built in its
task; only the k best of a block are shuffled, and one window per query merges them. Where the buckets to be probed hold more rows than
the block, as for near-isotropic vectors, the block's codes are verified in one sweep: the same codes are found.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from roadlake.llm.common import cut

#: Rows of the sample from which the codes are learned, and sample queries from which the radius is learned.
SAMPLE, SAMPLE_QUERIES = 8_192, 256
#: Code length; bits in a substring.
BITS, SUB = 512, 8
#: Rows in a block and queries in a chunk, at most on average; rows in a block while there are fewer blocks than tasks.
BLOCK, CHUNK, SMALL_BLOCK = 32_768, 16_384, 4_096
#: Share of true neighbours that the radius must hold for the sample queries.
TARGET = 0.97
#: Queries handled together in a block.
STEP = 128


class Codes:
    """Rotated sign codes of vectors; scale bounds their components and top the norms of the scaled vectors."""

    def __init__(self, sample: np.ndarray, scale: float, top: float, rounds: int = 30) -> None:
        self.scale, self.top = scale, top
        z = self._extend(sample)
        self.mean = z.mean(0)
        centred = z - self.mean
        axes = np.linalg.svd(centred, full_matrices=False)[2][:BITS].T
        flat = centred @ axes
        rng = np.random.default_rng(5)
        parts = []
        for _ in range(ceil(BITS / axes.shape[1])):
            turn = np.linalg.qr(rng.normal(size=(axes.shape[1],) * 2))[0]
            for _ in range(rounds):
                u, _, v = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
                turn = (u @ v).T
            parts.append(axes @ turn)
        self.project = np.hstack(parts)[:, :BITS]

    def _extend(self, x: np.ndarray) -> np.ndarray:
        x = x / self.scale
        rest = np.sqrt(np.maximum(0.0, self.top**2 - (x * x).sum(1)))
        return np.hstack([x, rest[:, None]]) / self.top

    def _pack(self, z: np.ndarray) -> np.ndarray:
        return np.packbits((z - self.mean) @ self.project > 0, axis=1)

    def base(self, x: np.ndarray) -> np.ndarray:
        """(rows, BITS / 8) bytes: the substrings of the codes."""
        return self._pack(self._extend(x))

    def query(self, x: np.ndarray) -> np.ndarray:
        x = x / np.abs(x).max(axis=1, keepdims=True)
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        return self._pack(np.hstack([unit, np.zeros((len(x), 1))]))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of every code of a and every code of b."""
    a, b = np.ascontiguousarray(a).view(np.uint64), np.ascontiguousarray(b).view(np.uint64)
    total = np.zeros((len(a), len(b)), np.uint16)
    for k in range(a.shape[1]):
        total += np.bitwise_count(a[:, k][:, None] ^ b[:, k][None])
    return total


class BlockIndex:
    """Multi-index of one block: for each substring, the block's rows by substring value."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.order = np.argsort(codes, axis=0, kind="stable")  # rows by value, for each substring
        self.ends = np.stack([np.searchsorted(codes[self.order[:, j], j], np.arange(257)) for j in range(codes.shape[1])])
        values = np.arange(256, dtype=np.uint8)
        self.apart = np.bitwise_count(values[:, None] ^ values[None])

    def within(self, queries: np.ndarray, radius: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row) places of all codes within radius, and rows probed per query; per query at least k rows, if there are so many."""
        m, n = self.codes.shape[1], len(self.codes)
        close = self.apart <= radius // m
        sizes = np.diff(self.ends, axis=1)
        rows_probed = sum((close[queries[:, j]] @ sizes[j] for j in range(m)), np.zeros(len(queries), np.int64))
        swept = rows_probed >= n  # buckets overlap, so probing would touch more rows than there are
        places: list[tuple[np.ndarray, np.ndarray]] = []
        short: list[int] = []
        for i in np.flatnonzero(~swept):
            probed = np.unique(np.concatenate([self.order[self.ends[j, v] : self.ends[j, v + 1], j] for j in range(m) for v in np.flatnonzero(close[queries[i, j]])] or [np.empty(0, np.int64)]))
            hit = probed[distances(queries[i : i + 1], self.codes[probed])[0] <= radius]
            if len(hit) < min(k, n):
                short.append(i)
            else:
                places.append((np.full(len(hit), i), hit))
        rest = np.union1d(np.flatnonzero(swept), np.array(short, np.int64))
        if len(rest):
            bits = distances(queries[rest], self.codes)
            reach = np.full(len(rest), radius)
            few = np.flatnonzero((bits <= radius).sum(1) < min(k, n))
            if len(few):
                reach[few] = np.partition(bits[few], min(k, n) - 1, axis=1)[:, min(k, n) - 1]
            r, c = np.nonzero(bits <= reach[:, None])
            places.append((rest[r], c))
            rows_probed[rest] = n
        r, c = (np.concatenate(x) for x in zip(*places, strict=True))
        return r, c, np.minimum(rows_probed, n)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def _codes_of(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), BITS // 8)


def _block_best(radius: int, k: int):
    def run(queries: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, ...]] = []
        if len(queries) and len(base):
            x, ids = _matrix(base["vec"]), base["vec_id"].to_numpy()
            index = BlockIndex(_codes_of(base["code"]))
            q_all, own_all, codes = _matrix(queries["vec"]), queries["vec_id"].to_numpy(), _codes_of(queries["code"])
            for at in range(0, len(queries), STEP):
                q, own = q_all[at : at + STEP], own_all[at : at + STEP]
                r, c, probed = index.within(codes[at : at + STEP], radius, k + 1)
                other = own[r] != ids[c]
                r, c = r[other], c[other]
                # Summed row by row, so that equal vectors have equal scores in every block.
                score = np.concatenate([(q[r[i : i + 65_536]] * x[c[i : i + 65_536]]).sum(1) for i in range(0, len(r), 65_536)] or [np.empty(0)])
                reranked = np.bincount(r, minlength=len(q))
                order = np.lexsort((ids[c], -score, r))
                r, c, score = r[order], c[order], score[order]
                place = np.arange(len(r)) - np.searchsorted(r, r, side="left")
                keep = place < k
                first = place[keep] == 0
                out.append((own[r[keep]], ids[c[keep]], score[keep], np.where(first, probed[r[keep]], 0), np.where(first, reranked[r[keep]], 0)))
        empty = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64))
        parts = [np.concatenate(p) for p in zip(*out, strict=True)] if out else empty
        return pd.DataFrame(dict(zip(["query_id", "vec_id", "score", "probed", "reranked"], parts, strict=True)))

    return run


def _radius(rows: DataFrame, asked: pd.DataFrame, codes: Codes, k: int, target: float) -> int:
    """Least radius that holds target of the sample queries' true k neighbours among all rows."""
    q, own = _matrix(asked["vec"]), asked["vec_id"].to_numpy()
    q_codes = codes.query(q)

    def best(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            score = q @ _matrix(part["vec"]).T
            score[own[:, None] == part["vec_id"].to_numpy()[None]] = -np.inf
            n = min(k, len(part))
            c = np.argpartition(-score, n - 1, axis=1)[:, :n]
            bits = np.take_along_axis(distances(q_codes, _codes_of(part["code"])), c, 1)
            yield pd.DataFrame({"q": np.repeat(np.arange(len(q)), n), "score": np.take_along_axis(score, c, 1).ravel(), "bits": bits.ravel().astype(np.int32)})

    met = rows.select("vec_id", "vec", "code").mapInPandas(best, "q int, score double, bits int").filter(F.col("score") > float("-inf"))
    true = met.withColumn("place", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score")))).filter(F.col("place") <= k)
    found = true.agg(F.percentile("bits", F.lit(target))).first()[0]
    return BITS if found is None else ceil(found)


def nearest_by_product(vectors: DataFrame, is_query: Column, k: int = 20, target: float = TARGET, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Each query's k nearest other rows: query_id, rank (from 1), vec_id, score (inner product in double precision), n_probed and
    n_reranked (rows of the table that the query probed, and whose product it computed).

    Order: larger score, then smaller vec_id. Rows whose id or vector is null, whose vector is zero, holds a null or non-finite
    component, or has another length than the longest-standing one (the most frequent, the longer on a tie) take no part. Repeated rows count
    once; rows that share an id with different vectors are each a candidate of the queries with other ids, and the id asks once, with its smallest
    vector. An empty table, or one row alone, gives an empty result. Products beyond the range of doubles are infinite.
    """
    spark = vectors.sparkSession
    named = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    sound = F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    good = named.filter(sound)
    peak = F.array_max(F.transform("vec", lambda x: F.abs(x)))
    sizes = good.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(peak).alias("peak")).orderBy(F.desc("n"), F.desc("d")).first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, n_probed long, n_reranked long")
    scale = float(sizes.peak)
    rows = good.filter(F.size("vec") == sizes.d).groupBy("vec_id", "vec").agg(F.max("is_query").alias("is_query"))
    n, n_queries, top = rows.agg(F.count(F.lit(1)), F.sum(F.col("is_query").cast("int")), F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + (x / scale) * (x / scale))))).first()

    sample = rows.select("vec_id", "vec").orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(SAMPLE).toPandas()  # a bounded number of rows
    codes = Codes(_matrix(sample["vec"]), scale, float(top))

    def coded(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            x = _matrix(part["vec"]) if len(part) else np.empty((0, sizes.d))
            yield part.assign(code=[bytes(c) for c in codes.base(x)], q_code=[bytes(c) if asks else None for c, asks in zip(codes.query(x), part["is_query"], strict=True)])

    rows = cut(rows.mapInPandas(coded, "vec_id long, vec array<double>, is_query boolean, code binary, q_code binary"))
    radius = _radius(rows, sample.head(SAMPLE_QUERIES), codes, k, target)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(ceil(n / BLOCK), min(tasks, ceil(n / SMALL_BLOCK)))
    chunks = max(1, ceil(n_queries / CHUNK))
    each = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    base = rows.select("vec_id", "vec", "code", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(blocks)).alias("block"), each(chunks).alias("chunk"))
    asking = rows.filter("is_query").groupBy("vec_id").agg(F.min(F.struct("vec", F.col("q_code").alias("code"))).alias("v")).select("vec_id", "v.vec", "v.code")
    asking = asking.select("*", each(blocks).alias("block"), F.pmod(F.xxhash64("vec_id", F.lit(11)), F.lit(chunks)).alias("chunk"))
    best = asking.groupBy("block", "chunk").cogroup(base.groupBy("block", "chunk")).applyInPandas(_block_best(radius, k), "query_id long, vec_id long, score double, probed long, reranked long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    whole = W.partitionBy("query_id")
    merged = best.withColumns({"rank": rank, "n_probed": F.sum("probed").over(whole), "n_reranked": F.sum("reranked").over(whole)})
    return merged.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", "n_probed", "n_reranked")
