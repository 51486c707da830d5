"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two 32-bit segments. Of two fingerprints with at most 3 differing bits, one segment
differs by at most one bit. Each segment is indexed under its variants with one bit as a wildcard; a row whose bit is 0
meets, by equality join, a row whose bit is 1, so a pair that differs there is met once and equal ones
never. Equal segments are met by their own key. Every met pair is verified on all 64 bits.

Spark's part: copies share a fingerprint, so only distinct fingerprints are indexed. A segment value held by more than
HOT fingerprints is refined: its rows get four keys, each with one byte of the other segment (3 differing bits leave one
of four bytes equal), so nothing is dropped; and fingerprints there that single-bit steps connect already
are not paired again, so a dense cloud of near copies gives links in proportion to its size.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake.llm.common import BROADCAST_ROWS, cut, map_text
from roadlake.llm.components import connected_components

#: Fingerprints with one segment value, beyond which its keys are refined.
HOT = 256
SEED = 42


def simhash(words: list[bytes], width: int = 3) -> int:
    """Fingerprint (unsigned) of the words' shingles, repeats included; 0 without words."""
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    n = max(1, len(words) - width + 1)
    step = 65_536
    for at in range(0, n, step):
        last = min(n, at + step)
        if len(words) < width:
            hashes = [digest(joined, SEED)]
        else:
            hashes = [digest(joined[s:e], SEED) for s, e in zip(starts[at:last], ends[at + width - 1 : last + width - 1], strict=True)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, keep: list[str], width: int = 3, text_col: str = "text") -> DataFrame:
    """The kept columns and fp (the 64 bits as a signed long) of every row; a null text has fingerprint 0."""
    return map_text(docs, keep, [("fp", T.LongType())], lambda texts: [[_signed(simhash(b.lower().split(), width)) for b in texts]], text_col)


def _segment(fp: Column, seg: int) -> Column:
    return F.shiftrightunsigned(fp, 32 * seg).bitwiseAND(F.lit(0xFFFFFFFF))


def _single_bit_links(fps: DataFrame) -> DataFrame:
    """Links between fingerprints that differ in exactly one bit; a key has one row on each side at most."""
    pos = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("i"))
    bit = F.expr("shiftleft(1L, i)")
    clear = pos.filter(F.col("fp").bitwiseAND(bit) == 0).select("i", F.col("fp").alias("rest"), F.col("fp").alias("a"))
    there = pos.filter(F.col("fp").bitwiseAND(bit) != 0).select("i", F.col("fp").bitwiseXOR(bit).alias("rest"), F.col("fp").alias("b"))
    return clear.join(there, ["i", "rest"]).select("a", "b")


def fingerprint_links(fps: DataFrame, max_bits: int = 3, hot: int = HOT) -> DataFrame:
    """fps: distinct column fp -> (a, b), links that connect the same fingerprints as all pairs within max_bits (0..3) do.

    Outside crowded segment values each such pair is listed; inside, pairs that single-bit steps connect are left out.
    """
    if not 1 <= max_bits <= 3:
        raise ValueError("two segments serve 1 to 3 differing bits")
    bits = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    segs = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(j).alias("seg"), _segment(F.col("fp"), j).alias("value"), _segment(F.col("fp"), 1 - j).alias("other")) for j in (0, 1)])).alias("s")).select("fp", "s.*")
    crowded = cut(segs.groupBy("seg", "value").count().filter(F.col("count") > hot).select("seg", "value"))
    n_crowded = crowded.count()

    wild = F.expr("""flatten(transform(sequence(0, 31), i -> CASE WHEN (value & shiftleft(1L, i)) = 0
        THEN array(struct(shiftleft(CAST(seg * 32 + i AS BIGINT), 32) | value AS key, 0 AS side))
        ELSE array(struct(shiftleft(CAST(seg * 32 + i AS BIGINT), 32) | (value ^ shiftleft(1L, i)) AS key, 1 AS side)) END))""")
    own = F.expr("array(struct(shiftleft(CAST(64 + seg AS BIGINT), 32) | value AS key, 2 AS side))")
    keyed = segs.select("fp", "other", F.explode(F.concat(wild, own)).alias("k")).select("fp", "other", F.col("k.key").alias("key"), F.col("k.side").alias("side"))
    if n_crowded:
        hot_keys = crowded.select(F.explode(F.concat(wild, own)).alias("k")).select(F.col("k.key").alias("key")).distinct().withColumn("hot", F.lit(True))
        hot_keys = F.broadcast(hot_keys) if 33 * n_crowded <= BROADCAST_ROWS else hot_keys
        marked = keyed.join(hot_keys, "key", "left")
        plain = marked.filter("hot IS NULL").select("fp", "key", "side")
    else:
        plain = keyed.select("fp", "key", "side")

    def meet(rows: DataFrame, on: list[str], extra: list[str]) -> DataFrame:
        a = rows.filter("side <> 1").select(*on, F.col("side").alias("sa"), F.col("fp").alias("a"), *[F.col(c).alias(f"{c}_a") for c in extra])
        b = rows.filter("side <> 0").select(*[F.col(c).alias(f"r_{c}") for c in on], F.col("side").alias("sb"), F.col("fp").alias("b"), *[F.col(c).alias(f"{c}_b") for c in extra])
        same = (F.col("sa") + F.col("sb") == 1) | ((F.col("sa") + F.col("sb") == 4) & (F.col("a") < F.col("b")))
        cond = same & (bits <= max_bits)
        for c in on:
            cond = cond & (F.col(c) == F.col(f"r_{c}"))
        for c in extra:
            cond = cond & (F.col(f"{c}_a") != F.col(f"{c}_b"))
        return a.join(b, cond).select("a", "b")

    links = meet(plain, ["key"], [])
    if n_crowded:
        dense = cut(marked.filter("hot").select("fp", "other", "key", "side"))
        near = cut(_single_bit_links(dense.select("fp").distinct()))
        comps = connected_components(near.select(F.col("a").alias("u"), F.col("b").alias("v")))
        labelled = dense.join(comps.withColumnRenamed("node", "fp"), "fp", "left").withColumn("comp", F.coalesce("component", "fp"))
        refined = labelled.select("fp", "key", "side", "comp", F.explode(F.expr("transform(sequence(0, 3), j -> j * 256 + (shiftright(other, 8 * j) & 255))")).alias("part"))
        links = links.unionByName(near).unionByName(meet(refined, ["key", "part"], ["comp"]))
    return links


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 3, hot: int = HOT, text_col: str = "text") -> DataFrame:
    """documents -> doc_id, fp, fingerprint (16 hex digits), component_id, n_copies (rows with the same fingerprint).

    component_id is the smallest doc_id reachable over links, the row's own included. Texts are lower-cased (A-Z only)
    and cut into words; shorter ones are one shingle; a null or wordless text has fingerprint 0 and links like any other.
    A null doc_id takes part as a copy but names no component (component_id is null if no row reachable has an id). Repeated
    rows stay, one result row each. An empty table gives an empty result.
    """
    rows = cut(fingerprints(docs, ["doc_id"], width, text_col))
    nodes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n_copies")))
    links = cut(fingerprint_links(nodes.select("fp"), max_bits, hot).distinct())
    comps = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    labelled = nodes.join(comps.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = labelled.groupBy("component").agg(F.min("rep").alias("component_id"))
    classes = labelled.join(least, "component").select("fp", "component_id", "n_copies")
    return rows.join(classes, "fp").select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_copies")
