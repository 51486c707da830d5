"""Helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that a table may have to be broadcast; beyond it the joins shuffle.
BROADCAST_ROWS = 100_000


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir, for tables and checkpoints between steps.

    Only where that setting is empty (tests, a laptop) is a folder of our own made.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoints-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def small_or_not(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast df if its known number of rows is within the limit; else leave the join to shuffle."""
    return F.broadcast(df) if rows <= limit else df


def map_text(
    df: DataFrame,
    keep: Iterable[str],
    out: list[tuple[str, T.DataType]],
    rows: Callable[[list[bytes]], list[list]],
    text_col: str = "text",
    keep_text: bool = False,
) -> DataFrame:
    """Run rows() over the texts of each Arrow batch and put its columns beside the kept ones.

    rows() gets UTF-8 bytes (b"" for a null text) and gives one list for each output column. A column of
    ``out`` replaces a kept column of the same name; with keep_text the text itself comes through as well. Texts reach Python as bytes, so nothing is decoded twice.
    """
    names = {n for n, _ in out}
    keep = [c for c in dict.fromkeys(keep) if c not in names and c != text_col]
    texts = [text_col] if keep_text and text_col not in names else []
    schema = T.StructType([f for f in df.select(*[F.col(f"`{c}`") for c in keep]).schema] + [T.StructField(c, T.StringType()) for c in texts] + [T.StructField(n, t) for n, t in out])
    arrow_types = [_arrow(t) for _, t in out]
    source = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("binary").alias("__text__"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                made = rows([x or b"" for x in part.column(len(keep)).to_pylist()])
                arrays = [part.column(i) for i in range(len(keep))] + [part.column(len(keep)).cast(pa.string()) for _ in texts] + [pa.array(v, t) for v, t in zip(made, arrow_types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *texts, *[n for n, _ in out]])

    return source.mapInArrow(run, schema)


def _arrow(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(t)


def crc_mod(id_col: str, mod: int) -> Column:
    """crc32 of the id's decimal text, modulo mod: the folds that contracts name."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % mod


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
