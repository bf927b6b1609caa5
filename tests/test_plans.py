"""Physical plans: what reaches the scan, what is shuffled, what stays off Python workers."""

import re

import pytest

from tidemark.operators import graph, relational as rel
from tidemark.plans import REGISTRY
from tidemark.session import cut_lineage
from conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_in_list_and_columns_reach_the_scan(tables):
    text = plan(rel.orders_parts(tables.orders, tables.lineitem, tables.part, keys=[1, 7]))
    assert "In(o_orderkey, [1,7])" in text and "In(l_orderkey, [1,7])" in text
    scans = sorted(re.findall(r"ReadSchema: struct<(.*?)>\n", text))
    assert scans == ["l_orderkey:bigint,l_partkey:bigint", "o_orderkey:bigint,o_totalprice:double", "p_partkey:bigint,p_name:string"]


def test_edges_are_not_shuffled_again(spark, tables):
    from tidemark.plans import standins as si

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with graph.spread(graph.both_ways(si.edges(tables))) as laid:
            points = cut_lineage(graph.vertices(laid.edges))
            text = plan(laid.follow(points, "id")).split("InMemoryRelation")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) <= 1



@pytest.mark.parametrize("name", [
    "orders_denorm", "word_count", "parse_logs", "top_page", "popular_pages", "relative_score", "temp_range", "previous_day",
    "average_goals", "describe", "corr_matrix", "chi_squared", "exact_match", "simple_edges", "rgb_to_lab", "rgb_to_hsv",
    "mean_iou", "page_links", "one_hot", "train_split", "contributions",
])
def test_no_python_workers_and_no_cross_join(spark, name):
    text = plan(REGISTRY[name](spark, SMALL))
    assert "Python" not in text and "Pandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
