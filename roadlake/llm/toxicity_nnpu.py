"""Toxicity by non-negative positive-unlabelled (nnPU) learning.

Numpy classifiers are trained from confirmed toxic documents (positives) and unlabelled text. With class prior p, losses
l+ and l- and means over positives (P) and unlabelled (U), the risk is  p * P[l+] + max(0, U[l-] - p * P[l-]):  the second
term corrects the unlabelled rows for the positives among them and is kept from turning negative.

Spark's part: the prior is counted over all labelled rows of the training folds; a bounded sample (``max_positive``,
``max_unlabelled``: the rows with the smallest hashes) is drawn by a broadcast join of its ids; one task trains each classifier;
scoring is one pass over the texts without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake.llm.common import crc_mod, cut, map_text, small_or_not

#: Bounds of the training sample, in rows, and the number of classifiers that share it out.
MAX_POSITIVE, MAX_UNLABELLED, CLASSIFIERS = 3_000, 6_000, 3
#: A feature is used if its count among positives is this many standard deviations from its share of all sample documents;
#: the log ratio that scales it is shrunken by this many documents; weights are held back by PULL / number of positives.
#: Chosen by cross-validation between the two training folds of sf0.01 and sf0.1.
LEAST_Z, SHRINK, PULL = 3.0, 2.0, 0.005
#: A task remembers the features of this many words.
CACHE = 150_000

_words = re.compile(r"\w+").findall


def word_features(word: str) -> list[str]:
    """The word itself and, for longer words, its beginnings, so inflected and joined forms share evidence."""
    return [word, *(f"{word[:n]}*" for n in (4, 5, 6) if len(word) > n)]


def text_features(text: str) -> set[str]:
    return {f for w in set(_words(text.lower())) for f in word_features(w)}


def train_nnpu(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, positive: np.ndarray, n_features: int, prior: float, steps: int = 200, rate: float = 0.05, l2: float = 1e-4, beta: float = 0.0, gamma: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic model on sparse rows (row, column, value sorted by row) by Adam on the nnPU risk; returns weights and bias."""
    n = len(positive)
    w, b = np.full(n_features, 0.5), -2.0
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    n_pos, n_unl = max(1, positive.sum()), max(1, (~positive).sum())
    for step in range(1, steps + 1):
        z = np.clip(np.bincount(rows, values * w[cols], n) + b, -30, 30)
        p = 1 / (1 + np.exp(-z))  # slope of l-(z) = log(1 + e^z); that of l+ is p - 1
        minus = np.logaddexp(0, z)
        rest = minus[~positive].sum() / n_unl - prior * minus[positive].sum() / n_pos
        slope_rest = np.where(positive, -prior * p / n_pos, p / n_unl)
        slope = np.where(positive, prior * (p - 1) / n_pos, 0.0) + slope_rest if rest >= -beta else -gamma * slope_rest
        grad = np.append(np.bincount(cols, values * slope[rows], n_features) + l2 * w, slope.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        change = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - change[:-1], b - change[-1]
    return w, b


def fit_sample(features: Iterable[set[str]], positive: np.ndarray, prior: float) -> tuple[dict[str, float], float]:
    """One classifier from the feature sets of sample documents: feature weights (scale included) and bias.

    The sets are turned into numbers one by one, so only one of them is held at a time."""
    n_pos, n_unl = int(positive.sum()), int((~positive).sum())
    if not n_pos or not n_unl:
        return {}, float(np.log(max(prior, 1e-6) / (1 - min(prior, 1 - 1e-6))))
    ids: dict[str, int] = {}
    coded = [np.fromiter((ids.setdefault(f, len(ids)) for f in s), np.int32, len(s)) for s in features]
    cols = np.concatenate(coded)
    rows = np.repeat(np.arange(len(coded)), [len(s) for s in coded])
    in_pos = np.bincount(cols, positive[rows], len(ids))
    in_all = np.bincount(cols, minlength=len(ids))
    expected = in_all * n_pos / (n_pos + n_unl)
    ratio = np.log((in_pos + SHRINK) / (expected + SHRINK))
    use = np.abs(in_pos - expected) >= LEAST_Z * np.sqrt(expected + 0.5)
    new = np.cumsum(use) - 1
    inside = use[cols]
    rows, cols = rows[inside], cols[inside]
    w, b = train_nnpu(rows, new[cols], ratio[cols], positive, int(use.sum()), prior, l2=PULL / n_pos)
    names = list(ids)
    return {names[i]: float(w[new[i]] * ratio[i]) for i in np.flatnonzero(use)}, float(b)


def train(docs: DataFrame, labels: DataFrame, held_out_mod: int = 3, held_out_rest: int = 1, max_positive: int | None = MAX_POSITIVE, max_unlabelled: int | None = MAX_UNLABELLED, classifiers: int = CLASSIFIERS) -> tuple[dict[str, float], float]:
    """Mean of the classifiers. Labels are read only in the training folds (crc32(doc_id) mod held_out_mod <> held_out_rest).

    With a bound of None all positives, or all documents as unlabelled, are used; then take classifiers in proportion, as each is trained in one task.
    """
    fold = crc_mod("doc_id", held_out_mod) != held_out_rest
    known = labels.filter(fold & F.col("toxic").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    share = known.agg(F.avg("toxic")).first()[0]
    if not share:
        return {}, -10.0
    prior = min(0.9, max(1e-4, float(share)))
    pick = F.xxhash64("doc_id", F.lit(7))
    some = lambda ids, most: ids.distinct() if most is None else ids.distinct().orderBy(pick).limit(most)
    pos = some(known.filter("toxic = 1").select("doc_id"), max_positive).withColumn("positive", F.lit(True))
    unl = some(docs.filter(fold).select("doc_id"), max_unlabelled).withColumn("positive", F.lit(False))
    wanted = pos.unionByName(unl)
    if max_positive is not None and max_unlabelled is not None:
        wanted = small_or_not(wanted, max_positive + max_unlabelled)
    sample = cut(docs.select("doc_id", "text").join(wanted, "doc_id").dropDuplicates(["doc_id", "positive"]).select("positive", F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(classifiers)).alias("bag"), F.coalesce("text", F.lit("")).alias("text")))
    model = sample.groupBy("bag").applyInPandas(_train_bag(prior), "feature string, weight double").groupBy("feature").agg(F.sum("weight").alias("weight"))
    bags = max(1, sample.select("bag").distinct().count())
    weights = {r.feature: r.weight / bags for r in model.collect()}  # features of a bounded sample
    return weights, weights.pop("", 0.0)


def _train_bag(prior: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(part: pd.DataFrame) -> pd.DataFrame:
        weights, bias = fit_sample((text_features(t) for t in part["text"]), part["positive"].to_numpy(bool), prior)
        return pd.DataFrame({"feature": ["", *weights], "weight": [bias, *weights.values()]})

    return run


def scorer(weights: dict[str, float], bias: float) -> Callable[[list[bytes]], list[float]]:
    state: dict[str, dict[str, tuple[str, ...]]] = {}

    def score(texts: list[bytes]) -> list[float]:
        seen = state.setdefault("seen", {})
        out = []
        for b in texts:
            hit: set[str] = set()
            for w in set(_words(b.decode("utf-8", "replace").lower())):
                got = seen.get(w)
                if got is None:
                    if len(seen) >= CACHE:
                        seen.clear()
                    got = seen[w] = tuple(f for f in word_features(w) if f in weights)
                if got:
                    hit.update(got)
            z = bias + sum(weights[f] for f in sorted(hit))
            out.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
        return out

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, keep: list[str], keep_text: bool = False, **bounds: int) -> DataFrame:
    """Kept columns and toxic_score (0 to 1) of every row's whole text.

    A null or empty text gets the score of a text without features. Labels of unknown documents and null labels are
    ignored; without a positive label in the training folds every score is near 0. A row with a null doc_id is scored and never learned from. Repeated rows score alike; the sample takes an id once. An empty table gives an empty result.
    """
    weights, bias = train(docs, labels, **bounds)
    score = scorer(weights, bias)
    return map_text(docs, keep, [("toxic_score", T.DoubleType())], lambda texts: [score(texts)], keep_text=keep_text)
