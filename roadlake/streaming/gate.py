"""Movement gate: a pose passes if it moved or turned far enough since the last one that passed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_POSE = ["x", "y", "z", "yaw"]
_STATE = "x double, y double, z double, yaw double"


def _moved(p: tuple, last: tuple | None, moved: float, turned: float) -> bool:
    """Yaw differences are not wrapped."""
    return last is None or sum((a - b) ** 2 for a, b in zip(p[:3], last[:3], strict=True)) > moved * moved or abs(p[3] - last[3]) > turned


def _passing(poses: pd.DataFrame, last: tuple | None, moved: float, turned: float) -> tuple[pd.DataFrame, tuple | None]:
    """The order is that of ts, then event_id."""
    poses = poses.sort_values(["ts", "event_id"], kind="stable")
    keep = np.zeros(len(poses), bool)
    for i, p in enumerate(poses[_POSE].itertuples(index=False, name=None)):
        if _moved(p, last, moved, turned):
            keep[i], last = True, p
    return poses[keep], last


def movement_gate(poses: DataFrame, moved: float = 50.0, turned: float = 5.0) -> DataFrame:
    """Batch form: poses (actor_id, event_id, ts, x, y, z, yaw), the passing ones of each actor.

    The rule compares with the last pose that passed, not the last one, so it is sequential within an actor. Spark sorts
    (and spills); a task holds one batch of rows and the last passing pose, however long an actor's history is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        actor, last = None, None
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            columns = [batch.column(c).to_numpy(zero_copy_only=False).tolist() for c in _POSE]
            for i, (own, *p) in enumerate(zip(batch.column("actor_id").to_pylist(), *columns, strict=True)):
                if own != actor:
                    actor, last = own, None
                if _moved(p, last, moved, turned):
                    keep[i], last = True, p
            yield batch.filter(pa.array(keep))

    order = [F.col("actor_id"), F.col("ts").asc_nulls_last(), F.col("event_id").asc_nulls_last()]
    return poses.repartition("actor_id").sortWithinPartitions(*order).mapInArrow(run, poses.schema)


def movement_gate_stream(poses: DataFrame, moved: float = 50.0, turned: float = 5.0) -> DataFrame:
    """Streaming form; the last passing pose of each actor is the state. Rows are ordered within a micro-batch."""

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        part = pd.concat(list(parts))
        out, last = _passing(part, state.get if state.exists else None, moved, turned)
        if last is not None:
            state.update(last)
        yield out

    return poses.groupBy("actor_id").applyInPandasWithState(step, poses.schema, _STATE, "append", GroupStateTimeout.NoTimeout)
