"""SimHash near-duplicates down to a shingle similarity, by deletion-variant signatures of long fingerprints.

op3's 64 bits and 3 differing bits hold almost equal texts only: sets of shingles with a Jaccard similarity of 0.8 lie at an angle
of 27 degrees and differ in 15 % of SimHash bits. So the fingerprint is longer here and cut into as many segments as are needed for one of them to
differ by at most one bit, with probability 1 - miss, at that similarity. Each segment is indexed as it is and under its deletion variants: with one bit
as a wildcard, for the ``weak`` bits nearest to a tie, which are those that edits turn. Rows that meet by equality of a
key are compared on 128 further bits, and those that pass on their whole sets, so every link is exact.

Spark's part: texts with the same set are one node. Families are linked first, each node with the middle of a crowded bucket only;
components with over BIG nodes are then left out of the comparison with themselves. Crowded buckets are split by the rare shingles of their
texts, which texts that are similar enough must share. So a large group of near copies gives pairs in proportion to its size, and nothing is dropped. Segments have about as many bits as log2 of the number of nodes, so
buckets of strangers stay small at every size; the number of segments follows.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake.llm.common import cut, map_text, small_or_not
from roadlake.llm.components import connected_components

SEED = 42
#: Bits of the two words on which met rows are compared, and how many standard deviations beyond the expected difference may pass.
CHECK_BITS, CHECK_SIGMA = 128, 4.2
#: Nodes of a component from which it is not compared with itself again; rows of a bucket from which its middle is sought first.
BIG, DENSE = 256, 16
#: Segment bits at least; the number of nodes in a bucket of strangers is about 2 ** SPARE.
LEAST_BITS, SPARE = 16, 2
#: Hashes of all the sets to be compared, up to which they are sent to every task (8 bytes each) and not dealt out pair by pair.
SENT_HASHES = 2_000_000
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]


def shingles(text: bytes, width: int = 5) -> np.ndarray:
    """Hashes of the distinct shingles, sorted; a text of fewer words is one shingle, one without words has none."""
    words = text.lower().split()
    digest = xxhash.xxh64_intdigest
    grams = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    return np.unique(np.array([digest(g, SEED) for g in grams], np.uint64))


def margins(hashes: np.ndarray, n_words: int) -> np.ndarray:
    """For each bit of a fingerprint of 64 * n_words bits, twice the shingles that set it less all shingles; the bit is 1 where that is positive."""
    salt = np.arange(1, n_words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    total = np.zeros(64 * n_words, np.int64)
    for at in range(0, len(hashes), 255):  # 255 additions fit into a lane of one byte
        x = hashes[at : at + 255, None] + salt
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        total += _LANES[x.view(np.uint8)].sum(axis=0, dtype=np.uint64).view(np.uint8)
    return 2 * total - len(hashes)


def meeting(bits: int, weak: int, angle: float) -> float:
    """Probability that a segment meets, as it is or under a variant, for fingerprints at that angle (by simulation, seeded)."""
    rng = np.random.default_rng(1)
    a, turn = rng.normal(size=(40_000, bits)), rng.normal(size=(40_000, bits))
    b = np.cos(angle) * a + np.sin(angle) * turn
    apart = (a > 0) != (b > 0)
    one = apart.sum(1) == 1
    at = apart[one].argmax(1)
    rank = lambda x: np.abs(x[one]).argsort(1).argsort(1)[np.arange(len(at)), at]
    return float(((apart.sum(1) == 0).sum() + ((rank(a) < weak) & (rank(b) < weak)).sum()) / len(a))


def plan(nodes: int, percent: int, weak: int, miss: float) -> tuple[int, int, int]:
    """(bits in a segment, segments, differing check bits allowed) for so many nodes."""
    share = 2 * percent / (100 + percent)  # cosine of equally large sets with that Jaccard similarity
    angle = float(np.arccos(share))
    bits = max(LEAST_BITS, ceil(log(max(nodes, 1), 2)) - SPARE) if nodes else LEAST_BITS
    segments = ceil(log(miss) / log(1 - meeting(bits, weak, angle)))
    p = angle / np.pi
    return bits, segments, int(CHECK_BITS * p + CHECK_SIGMA * (CHECK_BITS * p * (1 - p)) ** 0.5)


def variants(margin: np.ndarray, bits: int, segments: int, weak: int) -> np.ndarray:
    """Keys of the segments: (segments, 1 + weak), first each segment as it is, then its variants. A key holds segment, wildcard and value."""
    m = margin[: bits * segments].reshape(segments, bits)
    value = (m > 0) @ (np.int64(1) << np.arange(bits, dtype=np.int64))
    soft = np.argsort(np.abs(m), axis=1, kind="stable")[:, :weak]
    head = np.arange(segments, dtype=np.int64)[:, None] << 50
    wild = head | ((soft + 1).astype(np.int64) << 44) | (value[:, None] & ~(np.int64(1) << soft))
    return np.hstack([head | value[:, None], wild])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _node(hashes: np.ndarray) -> int:
    return _signed(xxhash.xxh64_intdigest(hashes.tobytes(), SEED))


def _apart() -> Column:
    return F.bit_count(F.col("x1").bitwiseXOR(F.col("y1"))) + F.bit_count(F.col("x2").bitwiseXOR(F.col("y2")))


def _components(links: DataFrame) -> DataFrame:
    return connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))


def _side(df: DataFrame, node: str, extra: list[str] = []) -> DataFrame:  # noqa: B006
    """One side of a join on key, with the columns named for it."""
    s = {"a": "x", "b": "y"}[node]
    return df.select("key", F.col("node").alias(node), F.col("s1").alias(f"{s}1"), F.col("s2").alias(f"{s}2"), *[F.col(c).alias(f"{c}_{node}") for c in extra])


def _rare_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """node, set -> key, node, n (size of the set), at, heads: the prefix of each set in order of rarity, shingles that no other set has left out.

    Sets x and y share at least percent / (100 + percent) * (|x| + |y|) shingles or are not similar enough. So the larger set's first
    |x| - percent * |x| / 100 + 1 shingles and the smaller set's first |y| - 2 * percent * |y| / (100 + percent) + 1 (``heads``) have one in common.
    """
    each = cut(sets.select("node", F.explode("set").alias("key")))
    often = each.groupBy("key").agg(F.count(F.lit(1)).alias("df"))
    ranked = each.join(often, "key").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("s")).withColumn("n", F.size("s"))
    prefix = ranked.select("node", "n", F.posexplode(F.slice("s", F.lit(1), (F.col("n") - F.ceil(percent * F.col("n") / 100) + 1).cast("int"))).alias("at", "s"))
    heads = F.col("at") <= F.col("n") - F.ceil(2 * percent * F.col("n") / (100 + percent))
    return prefix.filter("s.df > 1").select(F.col("s.key").alias("key"), "node", "n", "at", heads.alias("heads"))


def near_texts(docs: DataFrame, width: int = 5, percent: int = 80, weak: int = 4, miss: float = 0.01, big: int = BIG, dense_rows: int = DENSE, text_col: str = "text") -> DataFrame:
    """documents -> doc_id, text_hash (xxhash64 of the text), component_id, leads; one row per row with an id.

    component_id is the smallest doc_id reachable over pairs of percent similarity or more. Of a component, the rows with its smallest
    (doc_id, text_hash) lead; so rows that share an id but not a text are told apart. Texts are lower-cased (A-Z only) and cut into words. Null
    and wordless texts are copies of each other. Rows with a null doc_id are left out. Repeated rows stay. An empty table gives an empty result.
    Links are exact; a pair at exactly ``percent`` is overlooked with probability ``miss``, more similar ones with less.
    """
    docs = docs.filter("doc_id IS NOT NULL").select("doc_id", F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    bits, segments, allowed = plan(docs.count(), percent, weak, miss)
    n_words = ceil(bits * segments / 64) + CHECK_BITS // 64

    def sign(texts: list[bytes]) -> list[list]:
        out: list[list] = [[], [], [], []]
        for b in texts:
            s = shingles(b, width)
            m = margins(s, n_words)
            ends = np.packbits(m[-CHECK_BITS:] > 0, bitorder="little").view(np.int64).tolist()
            row = (_node(s), *ends, variants(m, bits, segments, weak).ravel().tolist() if len(s) else [])
            for column, value in zip(out, row, strict=True):
                column.append(value)
        return out

    def show(texts: list[bytes]) -> list[list]:
        sets = [shingles(b, width) for b in texts]
        return [[_node(x) for x in sets], [x.view(np.int64).tolist() for x in sets]]

    fields = [("node", T.LongType()), ("s1", T.LongType()), ("s2", T.LongType()), ("keys", T.ArrayType(T.LongType()))]
    rows = cut(map_text(docs, ["doc_id", "text_hash"], fields, sign))
    nodes = cut(rows.groupBy("node").agg(F.min("doc_id").alias("rep"), F.first(F.struct("s1", "s2", "keys")).alias("s")).select("node", "rep", "s.*"))

    def sets_of(used: DataFrame) -> DataFrame:
        """node, set: the whole sets of those nodes, read from their texts."""
        ids = cut(used.join(nodes.select("node", "rep"), "node").select(F.col("rep").alias("doc_id")).distinct())
        some = docs.join(small_or_not(ids, ids.count()), "doc_id", "left_semi")
        sets = map_text(some, [], [("node", T.LongType()), ("set", T.ArrayType(T.LongType()))], show)
        return sets.join(used, "node", "left_semi").groupBy("node").agg(F.first("set").alias("set"))

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are similar enough, on their whole sets."""
        sets = cut(sets_of(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()))
        hashes = sets.agg(F.coalesce(F.sum(F.size("set")), F.lit(0))).first()[0]
        sets = small_or_not(sets, hashes, SENT_HASHES)
        both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b")
        common = both.select("a", "b", F.size(F.array_intersect("x", "y")).alias("i"), (F.size("x") + F.size("y")).alias("n"))
        return common.filter(100 * F.col("i") >= percent * (F.col("n") - F.col("i"))).select("a", "b")

    # Families: in a crowded bucket every node meets the one in its middle, whose check bits are nearest to the bucket's majority, so edited
    # copies of one text are linked to that text; a node keeps its nearest middle.
    held = nodes.select(F.explode("keys").alias("key"), "node", "s1", "s2")
    dense = cut(held.groupBy("key").count().filter(F.col("count") >= dense_rows).select("key"))
    n_dense = dense.count()
    crowd = cut(held.join(small_or_not(dense, n_dense), "key", "left_semi"))
    bit = lambda c, i: F.shiftright(c, i).bitwiseAND(F.lit(1))
    ones = crowd.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *[F.sum(bit(c, i)).alias(f"{c}_{i}") for c in ("s1", "s2") for i in range(64)])
    major = ones.select("key", *[reduce(lambda x, y: x.bitwiseOR(y), [F.shiftleft((2 * F.col(f"{c}_{i}") > F.col("n")).cast("long"), i) for i in range(64)]).alias(f"m{c}") for c in ("s1", "s2")])
    off = F.bit_count(F.col("s1").bitwiseXOR(F.col("ms1"))) + F.bit_count(F.col("s2").bitwiseXOR(F.col("ms2")))
    middle = crowd.join(major, "key").groupBy("key").agg(F.min(F.struct(off.alias("off"), "node", "s1", "s2")).alias("h"))
    middle = middle.select("key", F.col("h.node").alias("a"), F.col("h.s1").alias("x1"), F.col("h.s2").alias("x2"))
    met = crowd.select("key", F.col("node").alias("b"), F.col("s1").alias("y1"), F.col("s2").alias("y2")).join(middle, "key").filter((F.col("a") != F.col("b")) & (_apart() <= allowed))
    tried = cut(met.groupBy("b").agg(F.min(F.struct(_apart().alias("d"), "a")).alias("h")).select("h.a", "b"))
    families = cut(verified(tried))
    # Crowded buckets are split by rare shingles: of two sets that are similar enough, the rarest shingles of both have one in common, and its
    # places bound what they can share. So texts made from one another, but with too many edits of their own, never meet. First each node
    # meets, for each of its shingles, only the one with the fewest shingles rarer than that, and keeps the nearest: families again.
    crowded = cut(crowd.select("node", "s1", "s2").distinct())
    rare = cut(_rare_shingles(sets_of(crowded.select("node")), percent).join(crowded, "node"))
    enough = (100 + percent) * F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) >= percent * (F.col("n_a") + F.col("n_b"))
    first = rare.groupBy("key").agg(F.min(F.struct("at", "node", "s1", "s2", "n")).alias("h")).select("key", "h.*")
    met = _side(first, "a", ["n", "at"]).join(_side(rare, "b", ["n", "at"]), "key").filter((F.col("a") != F.col("b")) & enough & (_apart() <= allowed))
    tried = cut(met.groupBy("b").agg(F.min(F.struct(_apart().alias("d"), "a")).alias("h")).select("h.a", "b"))
    families = cut(families.unionByName(verified(tried)).distinct())

    comps = cut(_components(families).select(F.col("node").alias("member"), F.col("component").alias("comp")))
    large = comps.groupBy("comp").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > big).select("comp", F.lit(True).alias("large"))
    comps = cut(comps.join(large, "comp", "left").select("member", "comp", F.coalesce("large", F.lit(False)).alias("large")))
    n_comps, n_large = comps.count(), comps.filter("large").count()
    # Buckets that are not crowded: every pair in them.
    held = held.join(small_or_not(dense, n_dense), "key", "left_anti")
    pairs = _side(held, "a").join(_side(held, "b"), "key").filter((F.col("a") < F.col("b")) & (_apart() <= allowed)).select("a", "b")
    for end in ("a", "b"):
        own = comps.select(F.col("member").alias(end), F.col("comp").alias(f"comp_{end}"))
        pairs = pairs.join(small_or_not(own, n_comps), end, "left").withColumn(f"comp_{end}", F.coalesce(f"comp_{end}", end))
    pairs = pairs.filter("comp_a <> comp_b").select("a", "b")

    # Crowded buckets: pairs that share a rare shingle and are not in one family.
    rare = rare.join(small_or_not(comps, n_comps), F.col("node") == F.col("member"), "left").withColumn("comp", F.coalesce("comp", "node")).withColumn("large", F.coalesce("large", F.lit(False)))
    one = (F.col("comp_a") != F.col("comp_b")) & (_apart() <= allowed)
    extra = ["comp", "n", "at"]
    order = (F.col("n_a") > F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    few = rare.filter("NOT large")
    pairs = pairs.unionByName(_side(few, "a", extra).join(_side(few.filter("heads"), "b", extra), "key").filter(one & order & enough).select("a", "b"))
    if n_large:
        many = rare.filter("large")
        pairs = pairs.unionByName(_side(few, "a", extra).join(_side(many, "b", extra), "key").filter(one & enough).select("a", "b"))
        there = many.select("key", "comp").distinct()
        across = there.select("key", F.col("comp").alias("comp_a")).join(there.select("key", F.col("comp").alias("comp_b")), "key").filter("comp_a < comp_b")
        pairs = pairs.unionByName(across.join(_side(many, "a", extra), ["key", "comp_a"]).join(_side(many, "b", extra), ["key", "comp_b"]).filter(one & enough).select("a", "b"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = families.unionByName(verified(cut(pairs)))

    comps = _components(links)
    labelled = nodes.select("node", "rep").join(comps, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    member = rows.select("doc_id", "text_hash", "node").join(labelled, "node")
    first = member.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    return member.join(first, "component").select("doc_id", "text_hash", F.col("first.doc_id").alias("component_id"), (F.struct("doc_id", "text_hash") == F.col("first")).alias("leads"))
