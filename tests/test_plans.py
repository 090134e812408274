"""What the physical plans must and must not contain."""

import re

import pytest

from cartloom.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def plan(spark, capsys):
    def explain(name):
        QUERIES[name](spark, SF_DIR).explain()
        return capsys.readouterr().out

    return explain


@pytest.fixture
def sort_merge(spark):
    """Plan as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_python_in_any_plan(plan, sort_merge, name):
    text = plan(name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert node not in text


@pytest.mark.parametrize(
    "name, condition",
    [("orders_by_status", "EqualTo(o_orderstatus,F)")],
)
def test_filters_reach_the_scan(plan, name, condition):
    assert condition in plan(name)


def test_pages_are_top_k_not_sorts(plan):
    for name in ("orders_by_status", "top_states"):
        assert "TakeOrderedAndProject" in plan(name)


def shuffles(text):
    return re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)


def columns(shuffle):
    return re.sub(r"#\d+L?", "", shuffle)


def test_summaries_shuffle_each_source_once_by_order(plan, sort_merge):
    """Orders, items and payments; the distinct count per group adds no shuffle by order."""
    for name in ("sales_summary", "state_summary", "product_summary"):
        by_order = [s for s in map(columns, shuffles(plan(name))) if "order_id" in s]
        assert by_order == ["order_id"] * 3


def test_master_shuffles_each_source_once_by_order(plan, sort_merge):
    keys = [columns(s) for s in shuffles(plan("master_table"))]
    assert keys.count("order_id") == 3 and keys.count("customer_id") == 2


def test_summaries_read_only_the_columns_they_need(plan):
    text = plan("state_summary")
    items = re.search(r"FileScan parquet \[(l_[^\]]*)\]", text).group(1)
    assert columns(items).split(",") == ["l_orderkey", "l_extendedprice"]
