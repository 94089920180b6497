"""What the plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest
from plans import executed_nodes
from pyspark.sql import functions as F

import __spark_entry__ as entry
from bench import HEADLINE
from ordermill.operators.ranking import global_rank
from ordermill.operators.sharing import shared
from ordermill.plans import activity, gold, silver, summary
from ordermill.sources import tables

QUERIES = (*HEADLINE, "date_dim", "clv_segments", "rfm_segments", "churn_status", "loyalty_segments", "pricing_kpis")

# Items and options both come from the lineitem table, so reports on both read it twice, and so does
# a report at two grains. All others read it once, whatever thresholds they compare with.
TWICE = {
    "clv_orders", "clv_kpis", "clv_segments", "loyalty_category_preference", "pricing", "pricing_line_join", "pricing_kpis",
}


@pytest.mark.parametrize("name", QUERIES)
def test_reads_lines_once_and_runs_no_python_or_cross_join(spark, small, name):
    nodes = executed_nodes(entry.queries()[name](spark, small))
    names = [n.nodeName() for n in nodes]
    lineitem = [n for n in nodes if n.nodeName().startswith("Scan parquet") and "l_orderkey" in n.output().mkString(",")]
    assert len(lineitem) == (2 if name in TWICE else 1)
    assert not [n for n in names if "Python" in n or "Arrow" in n or "Cartesian" in n or "NestedLoop" in n]


@pytest.mark.parametrize("name", ["clv_orders", "rfm", "churn", "loyalty", "location", "pricing", "category_pricing"])
def test_no_single_task_takes_unbounded_rows(spark, small, name):
    """Only global aggregates, which get one partial row per task, may end in one partition."""
    for node in executed_nodes(entry.queries()[name](spark, small)):
        if node.nodeName() == "Exchange" and "SinglePartition" in node.outputPartitioning().toString():
            below = node.child()
            while below.nodeName().startswith(("WholeStageCodegen", "InputAdapter", "Project")):
                below = below.child()
            assert "Aggregate" in below.nodeName()


@pytest.mark.parametrize("name", ["clv_orders", "rfm", "loyalty", "location"])
def test_no_window_runs_on_a_handful_of_keys_and_no_aggregate_sorts(spark, small, name):
    """A window's task holds one bracket of a quantile or one range of a rank, never all values of a column."""
    nodes = executed_nodes(entry.queries()[name](spark, small))
    for node in nodes:
        if node.nodeName() == "Window":
            keys = node.partitionSpec().mkString(",")
            assert "range" in keys or "slot" in keys
    assert not [n for n in nodes if n.nodeName() == "SortAggregate"]


def test_rank_deals_the_values_out_once(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 503).alias("v"))
    nodes = executed_nodes(global_rank(shared(df), "v", "r", 6))
    ranged = [n for n in nodes if n.nodeName() == "Exchange" and "rangepartitioning" in n.outputPartitioning().toString()]
    assert len(ranged) == 1


def test_the_summary_reads_orders_twice_and_days_for_the_rest(spark, small):
    i = entry._Inputs(spark, small)
    facts = tables.stage(i.order_facts, "facts")
    options = tables.stage(silver.order_option_facts(i.options), "options")
    days = tables.stage(activity.restaurant_days(facts), "days")
    daily = tables.stage(gold.daily_clv(facts), "daily")
    nodes = executed_nodes(summary.kpi_summary(summary.kpi_cards(facts, options, days, daily)))
    scans = [n.output().mkString(",") for n in nodes if n.nodeName().startswith("Scan parquet")]
    assert sum("orderid" in columns and "order_revenue" not in columns for columns in scans) <= 4  # orders and options, twice each
    assert len(scans) <= 9


def explained(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_only_needed_columns_are_read(spark, small):
    read = re.findall(r"ReadSchema: struct<(.*)>", explained(entry.queries()["gold_order_metrics"](spark, small)))
    columns = {c.split(":")[0] for schema in read for c in schema.split(",")}
    assert columns == {"l_orderkey", "l_partkey", "l_quantity", "o_orderkey", "o_orderdate", "p_partkey", "p_retailprice"}


def test_null_filters_reach_a_stored_table(spark, small, tmp_path):
    path = str(tmp_path / "facts")
    tables.write_parquet(entry._Inputs(spark, small).order_facts, path)
    from ordermill.plans.loyalty import loyalty

    plan = explained(loyalty(tables.read_parquet(spark, path)))
    assert "IsNotNull(restaurantid)" in plan and "IsNotNull(orderid)" in plan
    assert "items" not in re.search(r"ReadSchema: struct<(.*)>", plan).group(1)


def test_top_lists_are_not_full_sorts(spark, small):
    for name in ("clv_top20", "rfm_top20", "loyalty_top20", "location_top20"):
        assert "TakeOrderedAndProject" in explained(entry.queries()[name](spark, small))


def test_the_calendar_is_broadcast_by_its_size(spark, small):
    plan = explained(entry.queries()["sales_daily"](spark, small))
    assert "BroadcastHashJoin LeftOuter" in plan


def test_lines_are_summed_before_they_are_shuffled(spark, small):
    facts = silver.order_facts(entry._Inputs(spark, small).items)
    nodes = executed_nodes(facts)
    shuffles = [n for n in nodes if n.nodeName() == "Exchange"]
    assert len(shuffles) == 1
    below = shuffles[0].child()
    while "Aggregate" not in below.nodeName():
        below = below.child()
    assert "partial_sum" in below.toString()
