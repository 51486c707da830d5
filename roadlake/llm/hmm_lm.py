"""Hidden Markov language model: Baum-Welch over partitions, exact likelihood by the scaled forward recursion.

Training: every task runs forward-backward over its documents and gives expected counts (one row per word of the head vocabulary, and
one per state); Spark sums them, and the next round starts from the sums. Scoring runs the scaled forward recursion over each
whole text, so the likelihood is exact for the model at any length.

Vocabulary: the most frequent words (at most ``head`` of them, by a count threshold) have emissions of their own and are sent
to tasks; that table has a fixed bound. All rarer words share one symbol in the chain, times the word's own share of that symbol's
mass. Rare words are looked up by an equality join with the table of counts, which grows with the corpus and is never
broadcast or collected.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import log, log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import cut

#: Latent states, Baum-Welch rounds, and bound of the head vocabulary.
STATES, ROUNDS, HEAD = 4, 2, 50_000
#: Key of the end token in count tables; a word cannot hold a space.
END = b" "
#: Distinct words that a task counts before it passes them on.
FLUSH = 400_000
#: Cells of one batch of the recursions; steps between kept states of a very long text; texts encoded together.
BATCH_TOKENS, SPAN, ROWS = 2_000_000, 1024, 4096


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """w (binary), c: counts over all texts, the end token of each text included; counted in the tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        give = lambda: pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["w", "c"])
        for batch in batches:
            for x in batch.column(0):
                counts.update(tokens(x.as_py() or b""))
                counts[END] += 1
            if len(counts) > FLUSH:
                yield give()
                counts.clear()
        yield give()

    return docs.select(F.col(text_col).cast("binary").alias("t")).mapInArrow(run, "w binary, c long").groupBy("w").agg(F.sum("c").alias("c"))


class Chain:
    """Initial, transition and emission probabilities; symbols are 0..n-1."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.start, self.move, self.emit = start, move, emit  # emit: (symbols, states), columns sum to 1

    def log_likelihood(self, seqs: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of each sequence (all of length 1 at least), time-major over a batch sorted by length."""
        order = np.argsort([-len(s) for s in seqs], kind="stable")
        out = np.zeros(len(seqs))
        for part in _batches([len(seqs[i]) for i in order]):
            rows = order[part]
            lengths = np.array([len(seqs[i]) for i in rows])
            grid = _grid([seqs[i] for i in rows])
            alive = np.searchsorted(-lengths, -np.arange(len(grid)), side="left")
            total = np.zeros(len(rows))
            a = None
            for t, n in enumerate(alive):
                e = self.emit[grid[t, :n]]
                a = self.start * e if a is None else (a[:n] @ self.move) * e
                c = a.sum(1)
                a /= c[:, None]
                total[:n] += np.log(c)
            out[rows] = total
        return out

    def expected(self, seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected counts (start, move, emit) and the log likelihood. States are kept every SPAN steps and computed anew
        between them, so a very long text needs memory for one span."""
        k = len(self.start)
        start, move, emit, total = np.zeros(k), np.zeros((k, k)), np.zeros_like(self.emit), 0.0
        order = np.argsort([-len(s) for s in seqs], kind="stable")
        for part in _batches([len(seqs[i]) for i in order]):
            rows = order[part]
            lengths = np.array([len(seqs[i]) for i in rows])
            grid = _grid([seqs[i] for i in rows])
            alive = np.searchsorted(-lengths, -np.arange(len(grid)), side="left")
            kept = []
            a = None
            for t, n in enumerate(alive):
                if t % SPAN == 0:
                    kept.append(a)
                a, c = self._step(a, grid[t, :n], n)
                total += float(np.log(c).sum())
            beta = np.ones((len(rows), k))
            for b in range(len(kept) - 1, -1, -1):
                first, last = b * SPAN, min(len(grid), (b + 1) * SPAN)
                alphas, scales = [], []
                a = kept[b]
                for t in range(first, last):
                    a, c = self._step(a, grid[t, : alive[t]], alive[t])
                    alphas.append(a)
                    scales.append(c)
                gammas = np.empty((sum(int(alive[t]) for t in range(first, last)), k))
                top = len(gammas)
                for t in range(last - 1, first - 1, -1):
                    n = alive[t]
                    gammas[top - n : top] = alphas[t - first] * beta[:n]
                    top -= n
                    into = self.emit[grid[t, :n]] * beta[:n] / scales[t - first][:, None]
                    before = alphas[t - first - 1] if t > first else kept[b]
                    if before is not None:
                        move += self.move * (before[:n].T @ into)
                        beta[:n] = into @ self.move.T
                    else:
                        start += (alphas[0] * beta[:n]).sum(0) if t > first else gammas[:n].sum(0)
                symbols = np.concatenate([grid[t, : alive[t]] for t in range(first, last)])
                for s in range(k):
                    emit[:, s] += np.bincount(symbols, gammas[:, s], len(emit))
        return start, move, emit, total

    def _step(self, a: np.ndarray | None, symbols: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        e = self.emit[symbols]
        a = self.start * e if a is None else (a[:n] @ self.move) * e
        c = a.sum(1)
        a /= c[:, None]
        return a, c


def _batches(lengths: list[int]) -> Iterator[slice]:
    """Slices of a list sorted by falling length, of at most BATCH_TOKENS cells or one row."""
    at = 0
    while at < len(lengths):
        n = max(1, min(1024, BATCH_TOKENS // max(1, lengths[at])))
        yield slice(at, at + n)
        at += n


def _grid(seqs: list[np.ndarray]) -> np.ndarray:
    grid = np.zeros((len(seqs[0]), len(seqs)), np.int32)
    for j, s in enumerate(seqs):
        grid[: len(s), j] = s
    return grid


def first_chain(counts: np.ndarray, states: int, seed: int = 1) -> Chain:
    """Sticky states over the word shares, each tilted another way so that training can tell them apart."""
    tilt = np.random.default_rng(seed).uniform(0.2, 1.8, (len(counts), states))
    emit = (counts[:, None] + 0.5) * tilt
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    return Chain(np.full(states, 1 / states), move, emit / emit.sum(0))


def chain_from(start: np.ndarray, move: np.ndarray, emit: np.ndarray, counts: np.ndarray) -> Chain:
    """Probabilities from expected counts; every state keeps a little of the overall shares, so nothing is impossible."""
    shares = (counts + 0.5) / (counts + 0.5).sum()
    k = len(start)
    emit = emit + 50.0 * shares[:, None]
    move = move + 1.0
    start = start + 1.0
    return Chain(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0) if k else emit)


def _encode(text: bytes | None, ids: dict[bytes, int]) -> tuple[np.ndarray, Counter]:
    """Symbols of a text (head words, one symbol for all others, the end) and its counts of other words."""
    words = tokens(text or b"")
    rare, end = len(ids), len(ids) + 1
    seq = np.fromiter((ids.get(w, rare) for w in words), np.int32, len(words))
    return np.append(seq, np.int32(end)), Counter([words[i] for i in np.flatnonzero(seq == rare).tolist()])


def baum_welch(docs: DataFrame, chain: Chain, ids: dict[bytes, int], counts: np.ndarray, text_col: str = "text") -> Chain:
    """One round over all documents. Rows shuffled: one per symbol and task, and one per state and task."""
    k = len(chain.start)
    names = [f"g{s}" for s in range(k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros_like(chain.emit)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                a, b, c, _ = chain.expected([_encode(x.as_py(), ids)[0] for x in batch.slice(at, ROWS).column(0)])
                start, move, emit = start + a, move + b, emit + c
        used = np.flatnonzero(emit.sum(1))
        rows = np.vstack([emit[used], start[None], move])
        keys = np.concatenate([used, -1 - np.arange(k + 1)])  # -1: start; -2 - s: moves from state s
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *[pa.array(rows[:, s]) for s in range(k)]], names=["sym", *names])

    summed = docs.select(F.col(text_col).cast("binary").alias("t")).mapInArrow(run, "sym long, " + ", ".join(f"{n} double" for n in names)).groupBy("sym").agg(*[F.sum(n).alias(n) for n in names])
    start, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros_like(chain.emit)
    for r in summed.collect():  # at most one row for each symbol and state: bounded by the head
        if r.sym >= 0:
            emit[r.sym] = r[1:]
        elif r.sym == -1:
            start[:] = r[1:]
        else:
            move[-2 - r.sym] = r[1:]
    return chain_from(start, move, emit, counts)


def score_texts(docs: DataFrame, training: Column, states: int = STATES, rounds: int = ROUNDS, head: int = HEAD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Unigram and HMM log10 probability of every row's whole text; the model learns from the rows where training holds.

    -> id_col, held_out, n_tokens, n_known, train_tokens, base_score, score. A null text is empty: one end token. Rows with a null
    id, or whose training flag is null, are scored as held out. Repeated rows are scored each by itself. An empty table
    gives an empty result; without training rows every word is unknown and score equals base_score.
    """
    flagged = docs.select(F.col(id_col), F.coalesce(training, F.lit(False)).alias("train"), F.col(text_col).alias("text"))
    train = flagged.filter("train")
    counts = cut(word_counts(train))
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    # The least count that leaves at most head words, from the histogram of counts (few distinct values).
    histogram = counts.filter(F.col("w") != F.lit(END)).groupBy("c").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("c")).limit(head).collect()
    least, total = None, 0
    for r in histogram:
        total += r.words
        if total > head:
            break
        least = r.c
    top = sorted(((bytes(r.w), r.c) for r in counts.filter((F.col("c") >= least) & (F.col("w") != F.lit(END))).collect()), key=lambda x: (-x[1], x[0])) if least else []
    n_end = train.count() if n else 0
    ids = {w: i for i, (w, _) in enumerate(top)}
    head_counts = np.array([c for _, c in top], np.int64)
    n_rare_tokens, n_rare = n - int(head_counts.sum()) - n_end, v - len(top) - (1 if n_end else 0)
    symbols = np.array([*head_counts, n_rare_tokens, n_end], float)

    chain = first_chain(symbols, states)
    for _ in range(rounds if n else 0):
        chain = baum_welch(train, chain, ids, symbols, "text")

    norm = log10(n + 0.5 * (v + 1))
    base = np.log10(np.array([*head_counts, 0, n_end]) + 0.5) - norm
    rare_mass = log10(n_rare_tokens + 0.5 * (n_rare + 1)) - norm
    n_head = len(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                encoded = [_encode(x.as_py(), ids) for x in part.column(2)]
                seqs = [x[0] for x in encoded]
                likelihood = chain.log_likelihood(seqs) / log(10) if n else np.zeros(len(seqs))
                out: list[list] = [[] for _ in range(8)]
                for i, (seq, rare) in enumerate(encoded):
                    uid = part.column(3)[i].as_py()
                    n_here = sum(rare.values())
                    known = seq[seq != n_head]
                    row = (uid, part.column(0)[i].as_py(), part.column(1)[i].as_py(), b" " + str(uid).encode(), len(seq), len(seq) - n_here if n else 0, float(base[known].sum()), float(likelihood[i]) if n else 0.0)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                    for w, c in rare.items():
                        for column, value in zip(out, (uid, None, None, w, c, None, None, None), strict=True):
                            column.append(value)
                kinds = [pa.int64(), part.schema.field(0).type, pa.bool_(), pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=["uid", id_col, "train", "w", "k", "known", "base", "like"])

    id_type = docs.schema[id_col].dataType.simpleString()
    # uid tells repeated rows apart; both passes over it are within one job.
    source = flagged.select(id_col, "train", F.col("text").cast("binary").alias("t"), F.monotonically_increasing_id().alias("uid"))
    pieces = source.mapInArrow(run, f"uid long, {id_col} {id_type}, train boolean, w binary, k long, known long, base double, like double")
    found = pieces.join(counts.withColumnRenamed("w", "cw"), F.col("w") == F.col("cw"), "left")
    word = F.col("train").isNull()
    log_word = F.log10(F.coalesce(F.col("c"), F.lit(0)) + 0.5) - F.lit(norm)
    parts = found.select(
        "uid", F.col(id_col), "train",
        F.when(~word, F.col("k")).alias("n_tokens"),
        F.when(word, F.when(F.col("c") > 0, F.col("k")).otherwise(F.lit(0))).otherwise(F.col("known")).alias("known"),
        F.when(word, F.col("k") * log_word).otherwise(F.col("base")).alias("base"),
        F.when(word, F.col("k") * (log_word - F.lit(rare_mass))).otherwise(F.col("like")).alias("like"),
    )
    summed = parts.groupBy("uid").agg(F.max(id_col).alias(id_col), F.max("train").alias("train"), F.max("n_tokens").alias("n_tokens"), F.sum("known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("like").alias("score"))
    score = F.col("score") if n else F.col("base_score")
    return summed.select(id_col, (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", score.alias("score"))

