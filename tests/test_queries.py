"""Every query with an oracle, side by side with DuckDB on the small tables."""

import datetime

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from roadlake.plans import road_queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", [n for n in road_queries.ORACLES])
def test_oracle(spark, duck, name):
    ours = road_queries.QUERIES[name](spark, SF).toPandas()
    theirs = duck.execute(road_queries.ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    cols = sorted(ours.columns)
    key = lambda df: df[cols].sort_values(cols, ignore_index=True, na_position="last")
    pd.testing.assert_frame_equal(key(ours), key(theirs), check_dtype=False, atol=2e-7, rtol=0)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_gate(spark):
    from roadlake.streaming.gate import movement_gate

    t = datetime.datetime(2024, 1, 1)
    rows = [(1, i, t + datetime.timedelta(seconds=i), float(x), 0.0, 0.0, 0.0) for i, x in enumerate((0, 40, 60, 100, 111))]
    poses = spark.createDataFrame(rows, "actor_id long, event_id long, ts timestamp, x double, y double, z double, yaw double")
    assert [r.x for r in movement_gate(poses).orderBy("ts").collect()] == [0, 60, 111]


def test_gate_holds_one_batch(spark):
    """An actor's history over many batches is gated as one; no call sees more than a batch."""
    from roadlake.streaming import gate

    t = datetime.datetime(2024, 1, 1)
    rows = [(a, i, t + datetime.timedelta(seconds=i), float(20 * i), 0.0, 0.0, 0.0) for a in (None, 1, 2**60, 2**60 + 1) for i in range(100)]
    poses = spark.createDataFrame(rows, "actor_id long, event_id long, ts timestamp, x double, y double, z double, yaw double")
    plan = gate.movement_gate(poses)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "FlatMapGroupsInPandas" not in plan
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted((r.actor_id or 0, r.event_id) for r in gate.movement_gate(poses).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == [(a, i) for a in (0, 1, 2**60, 2**60 + 1) for i in range(0, 100, 3)]
