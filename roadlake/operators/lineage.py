"""Cutting lineage in loops."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def _folder(df: DataFrame) -> None:
    """Sets the folder that the cluster names in spark.checkpoint.dir; one of our own only where it is unset."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoints-"))


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint in the folder of _folder."""
    _folder(df)
    return df.checkpoint()


def land(df: DataFrame) -> DataFrame:
    """Rows written once as Parquet beside the checkpoints, so that each reader takes only the columns it needs."""
    _folder(df)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/landed-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
