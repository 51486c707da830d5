"""Sequential rules over each actor's poses, in the order of event time, for tables and for streams.

A stream's rows come late and out of order. They wait in their actor's state until the watermark has passed them, then go through the rule in order, so
rows late by less than the delay give what a table would. Later ones are dropped, and so is a repeat of a row still waiting or just passed (same ts and event_id).
State per actor: the rule's own carry, and the rows of one delay.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: rule(carry, rows): rows are those of one actor in order, as a frame; carry is anything JSON holds, None at first. Gives a frame and the new carry.
Rule = Callable[[object, pd.DataFrame], tuple[pd.DataFrame, object]]


def over_table(poses: DataFrame, keys: list[str], rule: Rule, schema: str) -> DataFrame:
    """The rule over a table. Spark sorts, and spills; a task holds one batch of rows and one carry, however long an actor's history is."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, carry = None, None
        for batch in batches:
            for key, part in batch.groupby(keys, sort=False, dropna=False):
                if key != own:
                    own, carry = key, None
                out, carry = rule(carry, part)
                yield out

    once = poses.dropDuplicates([*keys, "ts", "event_id"])
    return once.repartition(*keys).sortWithinPartitions(*keys, "ts", "event_id").mapInPandas(run, schema)


def over_stream(poses: DataFrame, keys: list[str], rule: Rule, schema: str, delay: str = "10 seconds") -> DataFrame:
    """The rule over a stream; ts is the event time, delay the time for which the watermark lags behind it. Rows without ts are dropped."""
    columns = poses.columns
    timed = poses.filter("ts IS NOT NULL").withWatermark("ts", delay)

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        carry, waiting, passed = json.loads(state.get[0]) if state.exists else (None, [], None)
        for part in parts:
            part = part.assign(ts=part["ts"].astype("datetime64[us]").astype("int64"))
            waiting += part[columns].astype(object).where(part[columns].notna(), None).values.tolist()
        at, name = columns.index("ts"), columns.index("event_id")
        order = lambda r: (r[at], r[name])
        mark = state.getCurrentWatermarkMs() * 1000
        waiting = sorted({(*order(r), *map(str, r)): r for r in waiting if passed is None or order(r) > tuple(passed)}.values(), key=order)
        ready = [r for r in waiting if r[at] <= mark]
        waiting = waiting[len(ready) :]
        if ready:
            passed = order(ready[-1])
            frame = pd.DataFrame(ready, columns=columns)
            out, carry = rule(carry, frame.assign(ts=pd.to_datetime(frame["ts"], unit="us")))
            yield out
        state.update((json.dumps([carry, waiting, passed]),))
        if waiting:
            state.setTimeoutTimestamp(max(waiting[0][at] // 1000 + 1, state.getCurrentWatermarkMs() + 1))

    return timed.groupBy(*keys).applyInPandasWithState(step, schema, "held string", "append", GroupStateTimeout.EventTimeTimeout)
