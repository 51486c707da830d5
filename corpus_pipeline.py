"""Corpus pipeline: quality, toxicity, near duplicates, mixing, tokens. Each stage works on all its predecessor kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.llm import fair_mix, quality_mcd, simhash_texts, toxicity_nnpu
from roadlake.llm.common import cut, small_or_not, table
from roadlake.llm.queries import TOXIC, bpe_digests


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; columns as they came."""
    used = ("lang", "source", "text")
    mine = {c: c if c in used else f"own {i}" for i, c in enumerate(docs.columns)}  # an extra column may have any name, one of the counts' included
    named = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in mine.items()])
    judged = quality_mcd.quality_verdicts(named, named.columns, keep_text=True)
    return judged.filter("kept").select(*[F.col(f"`{n}`").alias(c) for c, n in mine.items()])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxic score; the classifiers learn from the labels of those that came here."""
    named = docs.withColumnRenamed("toxic_score", "own toxic_score")
    scored = toxicity_nnpu.score_toxicity(named, table(spark, sf_dir, "labels"), named.columns, keep_text=True)
    return scored.filter(F.col("toxic_score") < TOXIC).withColumnRenamed("own toxic_score", "__own__").drop("toxic_score").withColumnRenamed("__own__", "toxic_score").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (5-word shingles, Jaccard 0.8 or more): that with the smallest id.

    A row's fate hangs on its id and its text, so rows that share an id but not a text are judged each by itself. Of rows that repeat
    id and text one stays. Rows without an id stay.
    """
    found = cut(simhash_texts.near_texts(docs))
    gone = found.filter("NOT leads").select("doc_id", "text_hash").distinct()
    again = found.filter("leads").groupBy("doc_id", "text_hash").count().filter("count > 1").select("doc_id", "text_hash")
    verdicts = cut(gone.withColumn("fate", F.lit("gone")).unionByName(again.withColumn("fate", F.lit("again"))))
    verdicts = small_or_not(verdicts.select(F.col("doc_id").alias("__id__"), F.col("text_hash").alias("__hash__"), F.col("fate").alias("__fate__")), verdicts.count())
    judged = docs.join(verdicts, (F.col("doc_id") == F.col("__id__")) & (F.xxhash64("text") == F.col("__hash__")), "left")
    once = judged.filter("__fate__ IS NULL").select(*docs.columns)
    repeated = judged.filter("__fate__ = 'again'").dropDuplicates(["__id__", "__hash__"]).select(*docs.columns)
    return once.unionByName(repeated)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it (0, 1 or 2 rows). Id, source and size, nulls included, decide a row's fate."""
    taken = fair_mix.mix_sources(docs).filter("n_taken > 0").select(F.col("doc_id").alias("__id__"), F.col("source").alias("__source__"), F.col("size").alias("__taken_size__"), F.col("n_taken").alias("__n__")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__id__")) & F.col("source").eqNullSafe(F.col("__source__")) & (F.col("__size__") == F.col("__taken_size__"))
    found = docs.withColumn("__size__", fair_mix.n_words()).join(taken, same)
    return found.withColumn("__copy__", F.explode(F.sequence(F.lit(1), F.col("__n__").cast("int")))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row of the mix."""
    return bpe_digests(docs)


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("mixing", mixing), ("tokens", tokens)]

#: The verdicts, scores and fingerprints of the stages are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each stage's rows are written as Parquet in the shared checkpoint folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        cut(spark.range(0))  # sets a checkpoint folder where none is named
        path = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
