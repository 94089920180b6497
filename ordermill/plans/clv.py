"""Lifetime value per order: item revenue plus option add-ons and discounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.amounts import MONEY, MONEY_SUM, mean_money, money
from ordermill.functions.order_time import tolerant_order_ts
from ordermill.operators.distribution import distribution_over
from ordermill.operators.quantiles import quantiles
from ordermill.operators.ranking import top
from ordermill.operators.sharing import shared

SEGMENTS = ("High", "Medium", "Low")


def order_values(item_facts: DataFrame, option_facts: DataFrame, co_located: bool = False) -> DataFrame:
    """Total value of each order with a known id; both facts at any grain.

    This is the left join of two per-order sums, done as one grouping of both inputs: one shuffle,
    no sort, and no order can multiply another side's rows. Orders with options only are not orders.

    With `co_located`, for inputs stored in buckets by order id (`sources.buckets`), it is that join: a union
    would lose the buckets, the join needs no shuffle at all.
    """
    if co_located:
        items = item_facts.where("orderid IS NOT NULL").groupBy("orderid").agg(F.sum("revenue").alias("items"))
        options = option_facts.where("orderid IS NOT NULL").groupBy("orderid").agg(F.sum("option_revenue").alias("options"))
        return items.join(options.hint("shuffle_hash"), "orderid", "left").select("orderid", _value())
    sides = (
        item_facts.select("orderid", "revenue", F.lit(None).cast(MONEY_SUM).alias("option_revenue"), "lines")
        .unionByName(
            option_facts.select(
                "orderid",
                F.lit(None).cast(MONEY_SUM).alias("revenue"),
                "option_revenue",
                F.lit(0).cast("bigint").alias("lines"),
            )
        )
        .filter(F.col("orderid").isNotNull())
    )
    return (
        sides.groupBy("orderid")
        .agg(F.sum("revenue").alias("items"), F.sum("option_revenue").alias("options"), F.sum("lines").alias("lines"))
        .filter(F.col("lines") > 0)
        .select("orderid", _value())
    )


def _value() -> Column:
    return money(F.col("items") + F.coalesce("options", F.lit(0).cast(MONEY))).alias("total_clv")


def clv_orders(
    item_facts: DataFrame,
    option_facts: DataFrame,
    method: str = "exact",
    ordered: bool = False,
    sketches: DataFrame | None = None,
    co_located: bool = False,
) -> DataFrame:
    """Orders with value and segment: High from the 80th percentile, Low up to the 20th.

    With `sketches`, the stored ones of these orders' values (`sketches.value_sketches`), the exact percentiles need one pass less, and
    `approx` none at all.

    An order without a value compares with nothing and is Medium. The global sort of all orders,
    highest value first, is left to those who ask for it.
    """
    orders = shared(order_values(item_facts, option_facts, co_located))
    wanted = {"p20": ("total_clv", "0.20"), "p80": ("total_clv", "0.80")}
    limits = quantiles(orders, wanted, method, sketches=sketches)
    report = orders.withColumn("limits", limits).select(
        "orderid",
        F.to_date(tolerant_order_ts(F.col("orderid"))).cast("string").alias("order_date"),
        "total_clv",
        F.when(F.col("total_clv") >= F.col("limits.p80"), "High")
        .when(F.col("total_clv") <= F.col("limits.p20"), "Low")
        .otherwise("Medium")
        .alias("clv_segment"),
    )
    return report.orderBy(F.desc_nulls_last("total_clv"), "orderid") if ordered else report


def clv_kpis(clv: DataFrame) -> DataFrame:
    return clv.agg(
        F.count("*").alias("total_orders"),
        mean_money(F.sum("total_clv"), F.count("total_clv")).alias("avg_order_clv"),
        F.max("total_clv").alias("top_order_clv"),
        F.count_if(F.col("clv_segment") == "High").alias("high_value_orders"),
    )


def clv_segments(clv: DataFrame) -> DataFrame:
    return distribution_over(clv, "clv_segment", SEGMENTS, "orders")


def clv_top(clv: DataFrame, k: int = 20) -> DataFrame:
    return top(clv, "total_clv", "orderid", k)
