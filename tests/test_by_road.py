"""Rows of plan records are dealt by road once; lanes, sections and samples are made after that."""

import re

import pytest

import __spark_entry__  # noqa: F401  (registers the queries)
from roadlake.operators import graph
from roadlake.plans import derived, road_queries
from roadlake.plans.derived import ALL_KEYS

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["lr9_lane_transforms", "sf1_lane_strips", "sf3_tessellated_lanes", "sf10_lane_marks", "wg10_trees"])
def test_lanes_are_not_shuffled(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        plan = road_queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert dealt and all(re.fullmatch(r"(l_orderkey|o_orderkey|road_id)#\d+L, 4", x) for x in dealt)


def test_links_are_searched_without_shuffling_lanes(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        plan = road_queries.QUERIES["jg1_lane_edges"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [x for x in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan) if "wanted" in x]


def test_other_queries_keep_the_rule_of_joins(spark):
    road_queries.QUERIES["sf1_lane_strips"](spark, SF)
    assert spark.conf.get(ALL_KEYS) == "false"
    road_queries.QUERIES["sf24_decimated_strips"](spark, SF)
    assert spark.conf.get(ALL_KEYS) == "true"


@pytest.mark.parametrize("name", ["jg9_topology", "jg5_successors", "sf10_lane_marks", "wg9_remaining_lengths", "lr16_nearest_lanes_at_signals", "io2_roads"])
def test_large_tables_are_not_coalesced_by_narrow_rows(spark, monkeypatch, name):
    """Tasks follow the records, not their bytes, and the multiplied rows stay in that deal."""
    monkeypatch.setattr(derived, "RECORDS", 500)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    built = []
    monkeypatch.setattr(derived, "dealt", lambda records, f=derived.dealt: built.append(f(records)) or built[-1])
    try:
        plan = road_queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    (records,) = built
    n = -(-records.count() // 500)
    assert n > 4 and records.rdd.getNumPartitions() == n
    if name != "io2_roads":  # its plan reads the documents
        assert f", {n}), REPARTITION_BY_NUM" in plan


@pytest.mark.parametrize("name", ["jg6_waypoints_ahead", "jg7_waypoints_behind"])
def test_edges_are_found_once(spark, monkeypatch, name):
    """Rounds read the landed edges; none orders the lanes by their links again."""
    kept = []
    monkeypatch.setattr(graph, "cut", lambda d, f=graph.cut: kept.append(d._jdf.queryExecution().optimizedPlan().toString()) or f(d))
    road_queries.QUERIES[name](spark, SF)
    assert len(kept) > 2 and not [x for x in kept if "wanted" in x]


def test_nearest_lanes_are_found_where_the_road_lies(spark):
    """Points at which lanes are compared are not shuffled again: nothing is dealt by anything but the road."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        plan = road_queries.QUERIES["lr16_nearest_lanes_at_signals"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert dealt and all(re.fullmatch(r"(o_orderkey|road_id)#\d+L, 4", x) for x in dealt)
