"""Quality rules: minimum-covariance-determinant (MCD) outlier rejection per language and source.

Every text gives a vector of transformed statistics. For each (language, source) group a robust centre and
covariance are fitted by concentration steps over *all* rows of the group that pass the base rules: keep the half of the rows with
the smallest Mahalanobis distances, re-estimate, repeat until the determinant stands still; of two starts that with the least determinant counts; one
reweighting step follows. Estimates of groups are drawn towards those of their language in proportion to prior_rows, so small groups need no other rule.
A document whose distance from its own group's estimate is above a chi-square cut-off is rejected.

Spark's part: only the small table of statistics is read again by each step. A step is two aggregations with partial
sums (a mergeable quantile sketch and moment sums), so a group that holds a third of all rows costs one row per task.
The half's boundary is a percentile sketch, exact for small groups and within 1/10000 of the ranks for large ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from roadlake.llm.common import cut, map_text, small_or_not

_SPACE = bytes([0x20, *range(0x09, 0x0E)])
_CONTINUED = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())

STATS = [
    ("n_words", T.LongType()),
    ("word_chars", T.LongType()),
    ("n_symbols", T.LongType()),
    ("n_dup_lines", T.LongType()),
    ("n_repeat_words", T.LongType()),
    ("n_upper", T.LongType()),
    ("n_marks", T.LongType()),
    ("n_lines", T.LongType()),
]

#: Robust spread under which a statistic counts as constant in its group.
RIDGE = 0.005
#: Spread that stands for that of a constant statistic, and only there. Without it, a group where most rows share one value
#: (no symbols, no repeated lines) has a zero determinant and would reject every row that differs at all. A heading
#: that a short text repeats once must stay within a few floors. All other statistics have the group's own covariance.
FLOORS = {"v_length": 0.08, "v_symbols": 0.05, "v_dup": 0.2, "v_repeat": 0.2, "v_upper": 0.06, "v_marks": 0.06}
FEATURES = list(FLOORS)
#: Rows of statistics, and estimates, in one task of a step; both are small beside the texts.
TASK_ROWS, TASK_GROUPS = 200_000, 2_000
#: Rows that the estimate of the next wider level weighs; concentration steps at most; fall of a log determinant that counts as none.
PRIOR_ROWS, MAX_STEPS, SETTLED = 25.0, 12, 1e-3


def repeat_words(words: list[bytes]) -> int:
    """Words in 3-word windows that the text holds twice or more, the first place included."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    n = len(seen)
    pairs = ids[:-1] * n + ids[1:]
    if n >= 2_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, inverse, counts = np.unique(pairs[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k : k + len(again)] |= again
    return int(inside.sum())


def _statistics(texts: list[bytes]) -> list[list]:
    out: list[list] = [[] for _ in STATS]
    for b in texts:
        words = b.split()
        lines = [x for x in b.split(b"\n") if x.strip()]
        row = (
            len(words),
            len(b.translate(None, _SPACE + _CONTINUED)),
            len(b) - len(b.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)),
            repeat_words(words),
            len(b) - len(b.translate(None, _UPPER)),
            len(b) - len(b.translate(None, _MARKS)),
            len(lines),
        )
        for column, value in zip(out, row, strict=True):
            column.append(value)
    return out


def text_statistics(docs: DataFrame, keep: list[str], text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Counts of the whole text of each row (a null text counts as empty) beside the kept columns."""
    return map_text(docs, keep, STATS, _statistics, text_col, keep_text)


def base_failed(min_words: int = 50, repeat_percent: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


def vectors() -> dict[str, Column]:
    """Transformed statistics: log mean word length, and arcsine roots of shares (their variance hardly follows the mean)."""
    share = lambda a, b: F.asin(F.sqrt(F.least(F.lit(1.0), F.col(a) / F.greatest(F.col(b), F.lit(1)))))
    return {
        "v_length": F.log(F.greatest(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)), F.lit(0.1))),
        "v_symbols": share("n_symbols", "word_chars"),
        "v_dup": share("n_dup_lines", "n_lines"),
        "v_repeat": share("n_repeat_words", "n_words"),
        "v_upper": share("n_upper", "word_chars"),
        "v_marks": share("n_marks", "word_chars"),
    }


def chi2_quantile(p: int, prob: float) -> float:
    """Quantile of the chi-square law by bisection on its distribution function (series of the incomplete gamma)."""
    from math import exp, lgamma, log

    def cdf(x: float) -> float:
        a, z = p / 2, x / 2
        term = total = 1 / a
        n = a
        while term > total * 1e-14:
            n += 1
            term *= z / n
            total += term
        return total * exp(-z + a * log(z) - lgamma(a)) if z > 0 else 0.0

    low, high = 0.0, 10.0 * p + 200
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid) < prob else (low, mid)
    return (low + high) / 2


_ARRAY = T.ArrayType(T.DoubleType())
_PARAMS = T.StructType([T.StructField("g", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("m", _ARRAY), T.StructField("cov", _ARRAY), T.StructField("w", _ARRAY), T.StructField("logdet", T.DoubleType()), T.StructField("s", _ARRAY), T.StructField("was", T.DoubleType())])


def _moments(rows: DataFrame) -> DataFrame:
    """Sums per group and start with partial aggregation: one row per group and task is shuffled."""
    p = len(FEATURES)
    sums = [F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES)]
    products = [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"p{i}_{j}") for i in range(p) for j in range(i, p)]
    return rows.groupBy("g", "start").agg(F.count(F.lit(1)).alias("n"), *sums, *products)


def whitening(cov: np.ndarray) -> tuple[np.ndarray, float]:
    """Whitening matrix of a covariance, and the logarithm of its determinant."""
    unit = np.sqrt(np.diag(cov))
    values, basis = np.linalg.eigh(cov / np.outer(unit, unit))
    values = np.maximum(values, 1e-3)  # a numerical bound only, for statistics that determine each other
    return (basis / np.sqrt(values)).T / unit, float(np.log(values).sum() + 2 * np.log(unit).sum())


def _estimate(moments: DataFrame) -> DataFrame:
    """Centre, covariance, whitening matrix and determinant of each group and start, from its sums and robust spreads s; s and the determinant before (was) come through."""
    floors = np.array([FLOORS[f] for f in FEATURES])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = len(floors)
        for part in parts:
            out = []
            for r in part.to_dict("records"):
                mean = np.array([r[f"s{i}"] for i in range(p)]) / r["n"]
                cov = np.empty((p, p))
                for i in range(p):
                    for j in range(i, p):
                        cov[i, j] = cov[j, i] = r[f"p{i}_{j}"] / r["n"] - mean[i] * mean[j]
                constant = np.array(r["s"]) < RIDGE
                cov[constant, :] = cov[:, constant] = 0.0
                cov[constant, constant] = floors[constant] ** 2
                cov[np.diag_indices(p)] = np.maximum(np.diag(cov), RIDGE * RIDGE)
                white, logdet = whitening(cov)
                out.append((r["g"], r["start"], r["n"], mean.tolist(), cov.ravel().tolist(), white.ravel().tolist(), logdet, list(r["s"]), r.get("was")))
            yield pd.DataFrame(out, columns=["g", "start", "n", "m", "cov", "w", "logdet", "s", "was"])

    return moments.mapInPandas(run, _PARAMS)


def _shrink(levels: DataFrame, prior_rows: float) -> DataFrame:
    """Own estimate of each group, drawn towards its language's and that towards all rows', as if those were prior_rows rows more."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = len(FEATURES)
        for part in parts:
            out = []
            for r in part.to_dict("records"):
                mean, cov = np.array(r["m_all"]), np.array(r["cov_all"])
                for level in ("lang", "own"):
                    if r[f"n_{level}"] > 0:
                        share = r[f"n_{level}"] / (r[f"n_{level}"] + prior_rows)
                        mean, cov = share * np.array(r[f"m_{level}"]) + (1 - share) * mean, share * np.array(r[f"cov_{level}"]) + (1 - share) * cov
                out.append((r["g_own"], mean.tolist(), whitening(cov.reshape(p, p))[0].ravel().tolist()))
            yield pd.DataFrame(out, columns=["g_own", "m", "w"])

    return levels.mapInPandas(run, T.StructType([T.StructField("g_own", T.StringType()), T.StructField("m", _ARRAY), T.StructField("w", _ARRAY)]))


def _distance(prefix: str = "") -> Column:
    """Squared Mahalanobis distance from columns m (centre) and w (whitening matrix, by rows), in generated code."""
    p = len(FEATURES)
    total = F.lit(0.0)
    for i in range(p):
        part = F.lit(0.0)
        for j, f in enumerate(FEATURES):
            part = part + F.col(f"{prefix}w")[i * p + j] * (F.col(f"{prefix}{f}") - F.col(f"{prefix}m")[j])
        total = total + part * part
    return total


def own_group() -> Column:
    """Name of the row's (lang, source) group."""
    return F.concat_ws("\x1f", F.lit("own"), F.coalesce(F.col("lang"), F.lit("\x00")), F.coalesce(F.col("source"), F.lit("\x00")))


def assign_groups(rows: DataFrame) -> DataFrame:
    """Names of the row's (lang, source) group and of its language."""
    return rows.withColumns({"g_own": own_group(), "g_lang": F.concat_ws("\x1f", F.lit("lang"), F.coalesce(F.col("lang"), F.lit("\x00")))})


def fit(stats: DataFrame, prior_rows: float = PRIOR_ROWS, max_steps: int = MAX_STEPS) -> tuple[DataFrame, int]:
    """Robust estimates of every (lang, source) group. stats needs lang, source and the counts of text_statistics.

    Estimates are made alike for every group, every language and all rows. Each has two starts, the robust spreads of the single statistics and
    the plain covariance; concentration steps run until no determinant falls any more, and the start with the least determinant counts.
    Returns (table of g_own, m, w; its number of rows).
    """
    n_rows, cores = stats.count(), stats.sparkSession.sparkContext.defaultParallelism
    stats = stats.coalesce(max(cores, ceil(n_rows / TASK_ROWS)))  # every step reads them again, and tasks follow rows, not the files of texts
    good = assign_groups(stats.withColumns(vectors())).withColumn("good", ~base_failed()).select("g_own", "g_lang", "good", *FEATURES)
    groups = cut(good.select("g_own", "g_lang").distinct())
    n_groups = 3 * groups.count() + 1
    # One row per estimate, below Python, which starts once a partition. An exchange of its own: sketches and sums are merged in the shuffle's partitions before it.
    # Only there: each stage and each broadcast table of a step takes a block of some MB of the driver's heap, however few its rows.
    few = lambda df: df.repartition(ceil(n_groups / TASK_GROUPS))
    rows = cut(good.filter("good").select(F.explode(F.array("g_own", "g_lang", F.lit("all"))).alias("g"), *FEATURES))

    p = len(FEATURES)
    quarter = lambda q: [F.percentile_approx(f, q, 10_000).alias(f"q_{f}") for f in FEATURES]
    middle = rows.groupBy("g").agg(*quarter([0.25, 0.5, 0.75]))
    middle = cut(few(middle).select("g", F.array(*[F.col(f"q_{f}")[1] for f in FEATURES]).alias("m"), F.array(*[(F.col(f"q_{f}")[2] - F.col(f"q_{f}")[0]) / 1.349 for f in FEATURES]).alias("s")))
    first = lambda i: F.lit(1.0) / F.when(F.col("s")[i] < RIDGE, FLOORS[FEATURES[i]]).otherwise(F.col("s")[i])
    single = middle.select("g", F.lit(0).alias("start"), "m", F.array(*[first(i) if i == j else F.lit(0.0) for i in range(p) for j in range(p)]).alias("w"), F.lit(float("inf")).alias("logdet"))
    spreads = small_or_not(middle.select("g", "s"), n_groups)
    plain = _estimate(few(_moments(rows.withColumn("start", F.lit(1))).join(spreads, "g"))).select("g", "start", "m", "w", F.lit(float("inf")).alias("logdet"))
    falling = cut(few(single.unionByName(plain)))

    def distances(of: DataFrame) -> DataFrame:
        return rows.join(small_or_not(of.select("g", "start", "m", "w"), 2 * n_groups), "g").withColumn("d2", _distance())

    settled = falling.limit(0).select("g", "start", "m", "w", "logdet")
    falling = falling.join(spreads, "g")
    for _ in range(max_steps):  # only estimates whose determinant still falls are stepped again
        at = distances(falling)
        half = at.groupBy("g", "start").agg(F.percentile_approx("d2", 0.5, 10_000).alias("h"))
        inner = at.join(small_or_not(half, 2 * n_groups), ["g", "start"]).filter("d2 <= h")
        before = small_or_not(falling.select("g", "start", "s", F.col("logdet").alias("was")), 2 * n_groups)
        params = cut(_estimate(few(_moments(inner)).join(before, ["g", "start"])))
        on = F.col("was") - F.col("logdet") > SETTLED
        settled = settled.unionByName(params.filter(~on).select("g", "start", "m", "w", "logdet"))
        falling = params.filter(on).select("g", "start", "m", "w", "logdet", "s")
        if falling.isEmpty():
            break
    best = settled.unionByName(falling.drop("s")).withColumn("place", F.row_number().over(W.partitionBy("g").orderBy("logdet", "start"))).filter("place = 1").select("g", "start", "m", "w")
    at = distances(cut(few(best)))
    # The half's covariance is too small; the median distance, to which constant statistics add nothing, says by how much. It never shrinks the spread.
    medians = F.array(F.lit(1.0), *[F.lit(chi2_quantile(k, 0.5)) for k in range(1, p + 1)])
    moving = F.size(F.filter("s", lambda x: x >= RIDGE))
    scale = at.groupBy("g").agg(F.percentile_approx("d2", 0.5, 10_000).alias("h")).join(spreads, "g").select("g", F.greatest(F.lit(1.0), F.col("h") / F.element_at(medians, moving + 1)).alias("scale"))
    inner = at.join(small_or_not(scale, n_groups), "g").filter(F.col("d2") / F.col("scale") <= chi2_quantile(p, 0.975))
    final = cut(_estimate(few(_moments(inner).join(spreads, "g"))).select("g", "n", "m", "cov"))
    level = lambda name: small_or_not(final.select(F.col("g").alias(f"g_{name}"), F.col("n").alias(f"n_{name}"), F.col("m").alias(f"m_{name}"), F.col("cov").alias(f"cov_{name}")), n_groups)
    levels = groups.join(level("own"), "g_own", "left").join(level("lang"), "g_lang", "left").withColumn("g_all", F.lit("all")).join(level("all"), "g_all").fillna(0, ["n_own", "n_lang"])
    return cut(_shrink(few(levels), prior_rows)), n_groups


#: Columns of the judge's own start so, beside whatever columns the rows bring.
RESERVED = "__mcd_"
VERDICTS = ("base_failed", "distance", "kept")


def judge(stats: DataFrame, estimates: DataFrame, n_groups: int, prob: float = 0.9999) -> DataFrame:
    """Add base_failed, distance (squared; null where no estimate exists) and kept.

    Every other column of stats comes through with its values, whatever its name; only the prefix __mcd_ is reserved.
    """
    cut_off = chi2_quantile(len(FEATURES), prob)
    names = [F.col(f"`{c}`") for c in stats.columns if c.lower() not in VERDICTS]
    known = estimates.select(*[F.col(c).alias(RESERVED + c) for c in ("g_own", "m", "w")])
    at = stats.withColumns({RESERVED + n: c for n, c in {**vectors(), "g_own": own_group()}.items()}).join(small_or_not(known, n_groups), RESERVED + "g_own", "left")
    return at.select(*names, base_failed().alias("base_failed"), _distance(RESERVED).alias("distance")).withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= cut_off, F.lit(True)))


def quality_verdicts(docs: DataFrame, keep: list[str] | None = None, keep_text: bool = False, prior_rows: float = PRIOR_ROWS, prob: float = 0.9999) -> DataFrame:
    """Statistics, base rules and MCD verdict of every document.

    Nulls: a null text is empty (base_failed); null lang or source are groups of their own; a null doc_id stays null.
    Repeated rows are judged alike. Kept columns may have any names but those of the counts and verdicts, which take their place. An empty table gives an empty result. The estimate of a group with few good rows leans on its language's,
    and that on all rows' (prior_rows); without any good row every row is base_failed.
    Texts are read twice and never shuffled.
    """
    keep = keep or ["doc_id", "lang", "source"]
    stats = cut(text_statistics(docs, ["lang", "source"]))
    estimates, n = fit(stats, prior_rows)
    return judge(text_statistics(docs, keep, keep_text=keep_text), estimates, n, prob)
