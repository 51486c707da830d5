"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Each source's documents are shuffled (by the MD5 of seed and id) and queued; a document's virtual finish time is the
running sum of its source's tokens divided by the source's target. Serving documents by finish time interleaves the
sources in proportion to their targets; the global order is cut where the budget is used up. A source whose target exceeds its size is
queued again (a second pass), up to ``max_repeats`` passes.

Spark's part: running sums are two-level. Sums per (source, hash range) are a small table; exact sums follow inside
each range. A source with a third of all rows is so spread over as many tasks as it has ranges. The cut needs an order only
inside the one range of finish times where the budget ends.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from roadlake.llm.common import WORD, cut, small_or_not

#: Rows that a hash range or range of finish times should hold.
RANGE_ROWS = 20_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), budget_share: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """key, source_size -> key, source_size, source_rank, target.

    Sources in order of key get the weights in turn. Targets share the budget by weight; a target stops at max_repeats
    times its source's size and the excess is shared again among the others by weight. In closed form: order by
    cap / weight, cap the leading sources, and give the others what is left of the budget by weight.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("source_rank") - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("source_rank", F.row_number().over(W.orderBy("key"))).withColumn("weight", w).withColumn("cap", F.col("source_size") * float(max_repeats))
    order = W.orderBy(F.col("cap") / F.col("weight"), "key")
    total = W.partitionBy()
    upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    budget = F.sum("source_size").over(total) * F.lit(budget_share)
    level = (budget - (F.sum("cap").over(upto) - F.col("cap"))) / (F.sum("weight").over(total) - (F.sum("weight").over(upto) - F.col("weight")))
    # A source is capped while its cap is at most what the level left for it and those after it would give.
    first = ranked.withColumns({"budget": budget, "level": level}).withColumn("free", F.max((F.col("cap") > F.col("level") * F.col("weight")).cast("int")).over(upto))
    share = F.first(F.when(F.col("free") == 1, F.col("level")), ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return first.withColumn("share", share).select("key", "source_size", "source_rank", F.when(F.col("free") == 1, F.col("share") * F.col("weight")).otherwise(F.col("cap")).alias("target"), "budget")


def n_words() -> Column:
    """Words of the whole text; a null text has 0."""
    return F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), budget_share: float = 1.5, max_repeats: int = 2, seed: str = "mix") -> DataFrame:
    """documents -> doc_id, size, source, source_size, target, n_taken, taken.

    size counts words of the whole text (null: 0). n_taken is how often the mix takes the document (0..max_repeats),
    taken = size * n_taken. Nulls: a null source is a source of its own, last in order; a null doc_id is shuffled as
    an empty id. Rows that agree in id, source and size share their fate, so a rerun gives the same result.
    A document without words takes nothing. An empty table gives an empty result.
    """
    key = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))
    shuffled = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = cut(docs.select("doc_id", "source", n_words().alias("size"), key.alias("key"), shuffled.alias("h")))
    n = sized.count()
    digits = max(1, ceil(log(max(n, 1) / RANGE_ROWS, 16))) if n > RANGE_ROWS else 1

    ranged = sized.withColumn("range", F.substring("h", 1, digits))
    parts = cut(ranged.groupBy("key", "range").agg(F.sum("size").alias("part_size")))
    targets = cut(source_targets(parts.groupBy("key").agg(F.sum("part_size").alias("source_size")), weights, budget_share, max_repeats))
    n_parts = parts.count()
    before = parts.withColumn("before", F.sum("part_size").over(W.partitionBy("key").orderBy("range")) - F.col("part_size")).join(small_or_not(targets, n_parts), "key").select("key", "range", "before", "source_size", "target", "source_rank", "budget")
    inside = W.partitionBy("key", "range").orderBy("h", "doc_id", "size")
    queued = ranged.join(small_or_not(before, n_parts), ["key", "range"]).withColumn("queue", F.col("before") + F.sum("size").over(inside))
    # RANGE frame: equal rows share a place in the queue.
    finish = lambda k: (F.col("queue") + k * F.col("source_size")) / F.col("target")
    timed = queued.withColumns({f"f{k}": F.when(F.col("target") > 0, finish(k)) for k in range(max_repeats)})
    timed = cut(timed.select("doc_id", "source", "size", "source_size", "target", "source_rank", "budget", *[f"f{k}" for k in range(max_repeats)]))

    spread = max(1, n * max_repeats // RANGE_ROWS)
    slot = lambda f: F.floor(f * spread).cast("long")
    entries = timed.select("doc_id", "size", "source_rank", "budget", F.explode(F.array(*[F.struct(F.col(f"f{k}").alias("f"), F.lit(k).alias("pass")) for k in range(max_repeats)])).alias("e")).filter("size > 0 AND e.f IS NOT NULL").select("*", slot(F.col("e.f")).alias("slot"))
    # Finish times far beyond 1 are never reached: at time 1 every source has had its target.
    slots = entries.filter(F.col("slot") <= 2 * spread).groupBy("slot").agg(F.sum("size").alias("slot_size"), F.max("budget").alias("budget"))
    served = slots.withColumn("upto", F.sum("slot_size").over(W.orderBy("slot")))
    last = served.filter("upto > budget").orderBy("slot").limit(1).select("slot", (F.col("budget") - (F.col("upto") - F.col("slot_size"))).alias("room"))
    order_key = F.struct(F.col("e.f").alias("f"), F.col("source_rank").alias("r"), F.col("e.pass").alias("p"), F.col("doc_id").alias("d"))
    at_end = entries.join(F.broadcast(last), "slot").select(order_key.alias("k"), "size", "room")
    cut_key = at_end.withColumn("used", F.sum("size").over(W.orderBy("k"))).filter("used <= room").agg(F.max("k").alias("last_k"))
    ends = cut(cut_key.crossJoin(last.agg(F.max("slot").alias("last_slot"))))

    def taken_in(k: int) -> Column:
        f = F.col(f"f{k}")
        mine = F.struct(f.alias("f"), F.col("source_rank").alias("r"), F.lit(k).alias("p"), F.col("doc_id").alias("d"))
        inside_cut = F.col("last_slot").isNull() | (slot(f) < F.col("last_slot")) | ((slot(f) == F.col("last_slot")) & F.coalesce(mine <= F.col("last_k"), F.lit(False)))
        return F.coalesce((F.col("size") > 0) & f.isNotNull() & (slot(f) <= 2 * spread) & inside_cut, F.lit(False)).cast("long")

    n_taken = sum((taken_in(k) for k in range(1, max_repeats)), taken_in(0))
    out = timed.crossJoin(F.broadcast(ends)).withColumn("n_taken", n_taken)
    return out.select("doc_id", "size", "source", "source_size", F.col("target"), "n_taken", (F.col("size") * F.col("n_taken")).alias("taken"))
