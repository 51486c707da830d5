"""As-of and interval lookups along a road: records in force from s0 until s1.

Every join and window is keyed by map_id first, as maps repeat road ids. Keys are equi-join columns, so a lookup is a hash or sort-merge join with a residual condition; hot roads fall to
Spark's skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from roadlake.functions.scalar import poly_eval


def with_ends(records: DataFrame, keys: list[str], s: str = "s0", end: str = "s1", last: Column | float = float("inf")) -> DataFrame:
    """Add the end of each record: the next distinct start of its key, or last."""
    starts = records.select(*keys, s).distinct().withColumn("next_start", F.lead(s).over(W.partitionBy(*keys).orderBy(s)))
    return records.join(starts, [*keys, s]).withColumn(end, F.coalesce("next_start", last if isinstance(last, Column) else F.lit(last))).drop("next_start")


def as_of(points: DataFrame, records: DataFrame, keys: list[str], how: str = "left", s: str = "s") -> DataFrame:
    """Every point with the records in force at its s (last start at or before it); records carry s0 and s1."""
    named = records.withColumnsRenamed({k: f"__{k}" for k in [*keys, "s0", "s1"]})
    cond = (F.col(s) >= F.col("__s0")) & (F.col(s) < F.col("__s1"))
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"__{k}"))
    met = points.drop("s0", "s1").join(named, cond, how)
    return met.drop(*[f"__{k}" for k in keys]).withColumnsRenamed({"__s0": "s0", "__s1": "s1"})


def records_between(records: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Records whose start lies in [lo, hi] of a range; descending order where lo > hi. ord numbers them in reading order."""
    low, high = F.least("lo", "hi"), F.greatest("lo", "hi")
    met = ranges.join(records, keys).filter((F.col("s0") >= low) & (F.col("s0") <= high))
    signed = F.when(F.col("lo") <= F.col("hi"), F.col("s0")).otherwise(-F.col("s0"))
    return met.withColumn("ord", F.row_number().over(W.partitionBy(*keys, "range_id").orderBy(signed)))


def section_ends(sections: DataFrame, roads: DataFrame) -> DataFrame:
    """s1 of each lane section: the next start, or the road's length."""
    return with_ends(sections.join(roads.select("map_id", "road_id", "length"), ["map_id", "road_id"]), ["map_id", "road_id"], last=F.col("length"))


def lane_extent(sections: DataFrame, lanes: DataFrame) -> DataFrame:
    """First and last section that hold each lane id of a road."""
    at = lanes.join(sections.select("map_id", "road_id", "section_id", "s0"), ["map_id", "road_id", "section_id"])
    return at.groupBy("map_id", "road_id", "lane_id").agg(F.min_by("section_id", "s0").alias("first_section"), F.max_by("section_id", "s0").alias("last_section"))


def next_section_of_lane(sections: DataFrame, lanes: DataFrame) -> DataFrame:
    """For each lane, the nearest later and earlier section of its road that holds the same lane id."""
    at = lanes.join(sections.select("map_id", "road_id", "section_id", "s0"), ["map_id", "road_id", "section_id"])
    order = W.partitionBy("map_id", "road_id", "lane_id").orderBy("s0")
    return at.withColumns({"next_section": F.lead("section_id").over(order), "prev_section": F.lag("section_id").over(order)})


def lane_width_at(points: DataFrame, widths: DataFrame) -> DataFrame:
    """points (map_id, road_id, lane_id, s) with width; 0 where no record is in force."""
    got = as_of(points, widths, ["map_id", "road_id", "lane_id"])
    return got.withColumn("width", F.coalesce(poly_eval(F.col("a"), F.col("b"), F.col("c"), F.col("d"), F.col("s") - F.col("s0")), F.lit(0.0))).drop("a", "b", "c", "d", "s0", "s1")
