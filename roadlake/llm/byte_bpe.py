"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Merging a pre-token: every adjacent pair that has a merge rank waits in the bucket of that rank, as its
left position in a linked list of parts. A two-level bitmap (words of 256 ranks, and a word of words) marks ranks with
waiting pairs; find-first-set on each level gives the lowest rank. A popped position is stale, and skipped, if the pair
there no longer has this rank. A merge costs a constant number of bitmap steps, so a very long pre-token is no problem.
Short pre-tokens wait in the same kind of queue by blocks of adjacent ranks: no lower block waits anywhere, so the lowest pair of each pre-token
in the block can be merged at once, in arrays.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake.llm.common import map_text

#: Pre-tokens that a task remembers; the memory is emptied when it is full.
CACHE = 100_000
#: Longer pre-tokens are encoded anew each time, so the memory stays small.
CACHED_CHARS = 64
#: Bytes of unknown pre-tokens that are merged together.
GROUP_BYTES = 500_000
#: Pre-tokens of at most so many bytes are merged in arrays, one pair of each in a step.
SHORT_BYTES = 64
#: Ranks in a block of the short pre-tokens' queue, as a power of two, and blocks in a word of its bitmap.
BLOCK_BITS, WORD_BITS = 8, 5


def read_ranks(lines: list[bytes]) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def merge_words(pre_tokens: list[bytes], ranks: dict[bytes, int]) -> list[list[int]]:
    """Token ids of each pre-token: always the lowest rank next, leftmost first among equals.

    All pre-tokens lie in one linked list, with a border before each, and share one queue: merges of different pre-tokens
    don't touch each other, so their order among themselves is free.
    """
    text = b"".join(pre_tokens)
    n = len(text)
    if not n:
        return [[] for _ in pre_tokens]
    starts = np.cumsum([0, *map(len, pre_tokens)])
    single = np.array([ranks[bytes([c])] for c in range(256)])
    double = np.full(65536, -1)
    for two, r in ((t, r) for t, r in ranks.items() if len(t) == 2):
        double[two[0] << 8 | two[1]] = r
    code = np.frombuffer(text, np.uint8).astype(np.int64)
    first = np.append(double[code[:-1] << 8 | code[1:]], -1)
    first[starts[1:][starts[1:] > 0] - 1] = -1
    border = bytearray(n + 1)
    for i in starts.tolist():
        border[i] = 1

    # buckets: rank -> left positions; words: the bitmap of ranks, 256 to a word; top: the bitmap of non-zero words
    order = np.argsort(first, kind="stable")
    order = order[np.searchsorted(first[order], 0) :]
    kinds, at = np.unique(first[order], return_index=True)
    buckets = {r: part.tolist() for r, part in zip(kinds.tolist(), np.split(order, at[1:]), strict=False)}
    words: dict[int, int] = {}
    top = 0
    for r in buckets:
        words[r >> 8] = words.get(r >> 8, 0) | 1 << (r & 255)
        top |= 1 << (r >> 8)

    get = ranks.get
    token = single[code].tolist()
    pair = first.tolist()  # rank of each part with its next one; -1: none, or no part starts here
    after = list(range(1, n + 1))  # start of the next part
    before = list(range(-1, n))
    while top:
        b = (top & -top).bit_length() - 1
        bits = words[b]
        rank = b << 8 | (bits & -bits).bit_length() - 1
        waiting = buckets.pop(rank)
        bits &= bits - 1
        words[b] = bits
        if not bits:
            top &= top - 1
        waiting.sort()
        for done, i in enumerate(waiting, 1):
            if pair[i] != rank:
                continue  # stale: one of the parts has been merged since
            j = after[i]
            k = after[i] = after[j]
            token[i] = rank
            pair[i] = pair[j] = -1
            lowest = rank
            if not border[k]:
                before[k] = i
                r = get(text[i : after[k]])
                if r is not None:
                    pair[i] = r
                    if r in buckets:
                        buckets[r].append(i)
                    else:
                        buckets[r] = [i]
                        words[r >> 8] = words.get(r >> 8, 0) | 1 << (r & 255)
                        top |= 1 << (r >> 8)
                    if r < lowest:
                        lowest = r
            if not border[i]:
                h = before[i]
                r = get(text[h:k])
                if r is None:
                    pair[h] = -1
                else:
                    pair[h] = r
                    if r in buckets:
                        buckets[r].append(h)
                    else:
                        buckets[r] = [h]
                        words[r >> 8] = words.get(r >> 8, 0) | 1 << (r & 255)
                        top |= 1 << (r >> 8)
                    if r < lowest:
                        lowest = r
            if lowest < rank and done < len(waiting):
                # A longer pair can have a lower rank, never the same one (equal ranks are equal bytes): it goes first.
                buckets[rank] = waiting[done:]
                words[rank >> 8] = words.get(rank >> 8, 0) | 1 << (rank & 255)
                top |= 1 << (rank >> 8)
                break
    out = []
    for i, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        ids = []
        while i < end:
            ids.append(token[i])
            i = after[i]
        out.append(ids)
    return out


class Pairs:
    """Ranks of adjacent tokens by their two ids: every way to cut a token into two tokens."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.n = max(ranks.values()) + 1  # an id that no token has
        self.single = np.array([ranks[bytes([c])] for c in range(256)])
        cuts = [(a * (self.n + 1) + b, r) for t, r in ranks.items() for i in range(1, len(t)) if (a := ranks.get(t[:i])) is not None and (b := ranks.get(t[i:])) is not None]
        found = np.array(sorted(cuts) or np.empty((0, 2)), np.int64)
        self.codes, self.ranks = np.append(found[:, 0], np.iinfo(np.int64).max), np.append(found[:, 1], -1)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; -1: none."""
        code = left * (self.n + 1) + right
        at = np.searchsorted(self.codes, code)
        return np.where(self.codes[at] == code, self.ranks[at], -1)


def merge_short(pre_tokens: list[bytes], pairs: Pairs) -> list[list[int]]:
    """merge_words for short pre-tokens: from the lowest block of ranks, the lowest pair of each pre-token, leftmost first among equals.

    One linked list, with an end that is no token before and after each pre-token. What a pre-token has left in the block waits on, so a lower pair made by the merge goes first.
    """
    sizes = np.fromiter(map(len, pre_tokens), np.int64, len(pre_tokens))
    stops = np.cumsum(sizes + 1)  # the end after each pre-token; the first one's other end is at 0
    n = int(stops[-1]) + 1 if len(stops) else 1
    text = np.frombuffer(b"\0" + b"".join([w + b"\0" for w in pre_tokens]), np.uint8)
    token = pairs.single[text]
    token[0] = token[stops] = pairs.n
    own = np.repeat(np.arange(len(sizes) + 1), np.append(1, sizes + 1))
    alive = token != pairs.n
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    pair = np.append(pairs(token[:-1], token[1:]), -1)

    # queue: block -> arrays of left positions; words: the bitmap of blocks; top: the bitmap of non-zero words
    queue: list[list[np.ndarray]] = [[] for _ in range((pairs.n >> BLOCK_BITS) + 1)]
    words = [0] * ((len(queue) >> WORD_BITS) + 1)
    top = 0
    in_word, in_block = (1 << WORD_BITS) - 1, (1 << BLOCK_BITS) - 1
    waiting = np.flatnonzero(pair >= 0)
    while True:
        blocks = pair[waiting] >> BLOCK_BITS
        order = np.argsort(blocks, kind="stable")
        blocks, waiting = blocks[order], waiting[order]
        starts = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])[: len(blocks)]).tolist()
        for c, a, z in zip(blocks[starts].tolist(), starts, [*starts[1:], len(blocks)], strict=False):
            queue[c].append(waiting[a:z])
            words[c >> WORD_BITS] |= 1 << (c & in_word)
            top |= 1 << (c >> WORD_BITS)
        if not top:
            break
        w = (top & -top).bit_length() - 1
        bits = words[w]
        b = w << WORD_BITS | (bits & -bits).bit_length() - 1
        i = np.concatenate(queue[b])
        queue[b] = []
        words[w] = bits & bits - 1
        if not words[w]:
            top &= top - 1
        i = i[pair[i] >> BLOCK_BITS == b]  # the others are stale: one of the parts has been merged since
        key = np.sort((own[i] << BLOCK_BITS | pair[i] & in_block) << n.bit_length() | i)
        whose, key = key >> n.bit_length() + BLOCK_BITS, key & (1 << n.bit_length()) - 1
        first = np.append(True, whose[1:] != whose[:-1])[: len(key)]
        i, rest = key[first], key[~first]
        j, rank = after[i], pair[i]
        h, k = before[i], after[j]
        token[i], after[i], before[k], alive[j], pair[j] = rank, k, i, False, -1
        made = pairs(np.append(token[h], rank), np.append(rank, token[k]))
        pair[h], pair[i] = made[: len(i)], made[len(i) :]
        waiting = np.concatenate([np.append(h, i)[made >= 0], rest[pair[rest] >= 0]])
    ids = token[alive].tolist()
    ends = np.append(0, np.cumsum(alive)[stops]).tolist()
    return [ids[a:z] for a, z in zip(ends, ends[1:], strict=False)]


class Encoder:
    """Pre-tokenises by a pattern and merges each match separately; remembers short pre-tokens within a bound.

    What is remembered of a pre-token: its ids, their decimal text, their number, and the bytes they decode to. Two
    generations of CACHE entries each are kept; when the newer is full, the older is dropped.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        self.ranks, self.pairs = ranks, Pairs(ranks)
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.names = {v: str(v) for v in ranks.values()}
        self.find = regex.compile(pattern).findall
        self.new: dict[str, tuple[list[int], str, int, bytes]] = {}
        self.old: dict[str, tuple[list[int], str, int, bytes]] = {}

    def pieces(self, texts: list[str]) -> list[list[tuple[list[int], str, int, bytes]]]:
        """What is remembered of each pre-token, for each text; unknown pre-tokens of all texts are merged together."""
        if len(self.new) >= CACHE:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        split = [self.find(t) for t in texts]
        unknown = []
        for w in set().union(*split):
            if w in new:
                continue
            if w in old:
                new[w] = old[w]
            else:
                unknown.append(w)
        coded = [(w, w.encode()) for w in unknown]
        for merge, table, some in ((merge_short, self.pairs, [x for x in coded if len(x[1]) <= SHORT_BYTES]), (merge_words, self.ranks, [x for x in coded if len(x[1]) > SHORT_BYTES])):
            at = 0
            while at < len(some):
                group, size = [], 0
                while at < len(some) and size < GROUP_BYTES:
                    group.append(some[at][1])
                    size += len(group[-1])
                    at += 1
                for (w, _), ids in zip(some[at - len(group) : at], merge(group, table), strict=True):
                    new[w] = ids, ",".join([self.names[x] for x in ids]), len(ids), self.decode(ids)
        out = [list(map(new.__getitem__, part)) for part in split]
        for w in unknown:
            if len(w) > CACHED_CHARS:
                del new[w]
        return out

    def encode(self, text: str) -> list[int]:
        return [i for p in self.pieces([text])[0] for i in p[0]]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


#: One encoder for each vocabulary and Python worker: Spark keeps its workers from task to task.
_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(ranks_path: str, pattern: str) -> Encoder:
    if (ranks_path, pattern) not in _encoders:
        with open(ranks_path, "rb") as f:
            _encoders[ranks_path, pattern] = Encoder(read_ranks(f.readlines()), pattern)
    return _encoders[ranks_path, pattern]


def encode_table(docs: DataFrame, ranks_path: str, pattern: str, keep: list[str], text_col: str = "text", return_ids: bool = True) -> DataFrame:
    """Kept columns, n_tokens, ids_sha256, decoded_sha256 and ids (array, if asked for) of every row's whole text.

    ranks_path: lines of base64 token and rank, in a file that every machine has (such as an installed package's). A null
    text is empty (no ids; digests of nothing). Repeated rows are encoded alike. An empty table gives an empty result.
    """
    out = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    if return_ids:
        out.append(("ids", T.ArrayType(T.IntegerType())))

    def rows(texts: list[bytes]) -> list[list]:
        from roadlake.llm.byte_bpe import encoder

        e = encoder(ranks_path, pattern)
        made: list[list] = [[] for _ in out]
        for pieces in e.pieces([b.decode("utf-8", "replace") for b in texts]):
            ids, decimal, n, decoded = zip(*pieces, strict=True) if pieces else ((), (), (), ())
            row = [sum(n), hashlib.sha256(",".join(decimal).encode()).hexdigest(), hashlib.sha256(b"".join(decoded)).hexdigest()]
            if return_ids:
                row.append([i for part in ids for i in part])
            for column, value in zip(made, row, strict=True):
                column.append(value)
        return made

    return map_text(docs, keep, out, rows, text_col)


def decode_table(encoded: DataFrame, ranks_path: str, keep: list[str], ids_col: str = "ids") -> DataFrame:
    """Kept columns and text, from a column of ids. Null ids give a null text; ids that are no tokens raise KeyError."""
    import pyarrow as pa

    schema = T.StructType([*encoded.select(*keep).schema.fields, T.StructField("text", T.StringType())])

    def run(batches):
        from roadlake.llm.byte_bpe import read_ranks

        with open(ranks_path, "rb") as f:
            bytes_of = {v: k for k, v in read_ranks(f.readlines()).items()}
        for batch in batches:
            texts = [None if ids is None else b"".join(bytes_of[i] for i in ids).decode("utf-8", "replace") for ids in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string())], names=[*keep, "text"])

    return encoded.select(*keep, F.col(ids_col).alias("__ids__")).mapInArrow(run, schema)
