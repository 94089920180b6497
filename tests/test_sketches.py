from __future__ import annotations

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from plans import executed_nodes
from pyspark.sql import functions as F

from ordermill.operators.quantiles import quantiles
from ordermill.operators.sketches import merged_sketches, sketched, sketched_quantile
from ordermill.plans import activity, bronze, clv, pricing, sales, silver
from ordermill.sources import buckets, sample_orders, tables

WANTED = {"low": ("amount", "0.20"), "mid": ("amount", "0.5"), "high": ("amount", "0.80"), "other": ("n", "0.5")}


def amounts(spark, n, seed=1):
    rng = random.Random(seed)
    rows = [(k % 7, None if rng.random() < 0.05 else Decimal(rng.randrange(-(10**6), 10**9)) / 100, rng.randrange(50)) for k in range(n)]
    return spark.createDataFrame(rows, "month int, amount decimal(20,2), n bigint")


def test_exact_quantiles_from_stored_sketches(spark):
    df = amounts(spark, 30_000)
    stored = tables.stage(sketched(df, ["amount", "n"], ["month"]), "sketches")
    assert stored.count() == 14
    plain = spark.range(1).select(quantiles(df, WANTED).alias("q")).first().q
    assert spark.range(1).select(quantiles(df, WANTED, sketches=stored).alias("q")).first().q == plain
    near = spark.range(1).select(quantiles(df, WANTED, "approx", sketches=stored).alias("q")).first().q
    values = sorted(row.amount for row in df.where("amount is not null").collect())
    for name, p in (("low", 0.2), ("mid", 0.5), ("high", 0.8)):
        below, to = sum(v < near[name] for v in values), sum(v <= near[name] for v in values)
        assert below / len(values) - 0.005 <= p <= to / len(values) + 0.005


def test_sketches_of_other_rows_are_an_error_and_of_none_give_null(spark):
    df = amounts(spark, 2000)
    other = tables.stage(sketched(df.withColumn("amount", F.col("amount") + 10**9), ["amount", "n"]), "sketches")
    with pytest.raises(Exception, match="do not fit"):
        spark.range(1).select(quantiles(df, WANTED, sketches=other).alias("q")).collect()
    none = df.where("false")
    stored = tables.stage(sketched(none, ["amount", "n"], ["month"]), "sketches")
    for method in ("exact", "approx"):
        assert set(spark.range(1).select(quantiles(none, WANTED, method, sketches=stored).alias("q")).first().q) == {None}


def test_sketches_of_months_merge_to_any_period(spark):
    df = amounts(spark, 5000).where("amount is not null")
    stored = sketched(df, ["amount"], ["month"])
    part = merged_sketches(stored.where("month < 3"), ["amount"]).select(sketched_quantile("amount", "0.5").alias("q")).first().q
    values = sorted(row.amount for row in df.where("month < 3").collect())
    assert values[int(len(values) * 0.49)] <= part <= values[int(len(values) * 0.51)]


def test_days_count_once_however_often_they_are_loaded(spark):
    rows = [("a", d, 1) for d in (1, 1, 31)] + [("a", None, 0), ("b", None, 1), ("c", 15, 2)]
    facts = [(r, datetime(2024, 1, d, 8) if d else None, o) for r, d, o in rows]
    days = spark.createDataFrame(facts, "restaurantid string, at timestamp_ntz, orders bigint").selectExpr(
        "restaurantid", "to_date(at) AS day", "to_date(at) AS order_date", "at AS first_ts", "at AS last_ts", "orders", "CAST(1 AS decimal(28,2)) AS revenue"
    )
    months = activity.restaurant_months(days)
    expected = {("a", 2, 1), ("b", 0, 0), ("c", 1, 1)}
    assert {tuple(row) for row in activity.active_days(months).collect()} == expected
    assert {tuple(row) for row in activity.active_days(months, months.where("restaurantid <> 'b'")).collect()} == expected
    later = months.where("restaurantid = 'a'").withColumns({"day_bits": F.lit(0b110), "month": F.lit("2024-01")})
    assert {tuple(row) for row in activity.active_days(months, later).collect()} == {("a", 4, 1), ("b", 0, 0), ("c", 1, 1)}


@pytest.fixture(scope="module")
def stored(spark, small):
    items = bronze.bronze_order_items(sample_orders.raw_order_items(spark, small))
    options = bronze.bronze_order_item_options(sample_orders.raw_order_item_options(spark, small))
    return (
        buckets.write_bucketed(silver.order_facts(items), "bucketed_facts", "orderid", 4),
        buckets.write_bucketed(silver.order_option_facts(options), "bucketed_options", "orderid", 4),
    )


def test_bucketed_tables_meet_without_a_shuffle(spark, stored):
    assert buckets.buckets_of(spark, "bucketed_facts") == buckets.buckets_of(spark, "bucketed_options") == (["orderid"], 4)
    for make in (clv.order_values, pricing.order_ledger):
        apart, together = make(*stored), make(*stored, co_located=True)
        names = [node.nodeName() for node in executed_nodes(together)]
        assert "Exchange" not in names and any("Join" in name for name in names)
        assert "Exchange" in [node.nodeName() for node in executed_nodes(apart)]
        columns = sorted(apart.columns)
        assert sorted(map(repr, apart.select(columns).collect())) == sorted(map(repr, together.select(columns).collect()))
    exchanges = [node.toString() for node in executed_nodes(clv.clv_orders(*stored, co_located=True)) if node.nodeName() == "Exchange"]
    assert not any("hashpartitioning(orderid" in text for text in exchanges)


def test_the_calendar_decides_which_months_are_read(spark, tmp_path):
    folder = str(tmp_path / "daily")
    rows = [(f"o{k}", date(2024, 1 + k % 12, 1 + k % 28), Decimal(k)) for k in range(400)]
    daily = spark.createDataFrame(rows, "orderid string, order_date date, order_revenue decimal(20,2)")
    tables.write_parquet(daily.withColumn("order_month", F.date_format("order_date", "yyyy-MM")), folder, ["order_month"])
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-12-31')) AS date_key").withColumn("month_num", F.month("date_key"))
    calendar = tables.stage(days, "calendar")
    df = sales.sales_on_days(tables.read_parquet(spark, folder), calendar, "month_num = 5 AND dayofmonth(date_key) < 15")
    scan = next(node for node in executed_nodes(df) if node.nodeName().startswith("Scan parquet") and "order_revenue" in node.output().mkString(","))
    assert "dynamicpruning" in scan.toString()
    metrics = {name: scan.metrics().apply(name).value() for name in ("numPartitions", "numOutputRows")}
    assert metrics["numPartitions"] == 1 and metrics["numOutputRows"] == sum(row[1].month == 5 for row in rows)
    expected = [row for row in rows if row[1].month == 5 and row[1].day < 15]
    assert [tuple(row) for row in df.collect()] == [("2024-05", len(expected), sum(row[2] for row in expected))]
