"""Loyalty by order frequency, as the source's own loyalty flag is never filled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.amounts import MONEY, half_up_ratio, mean_money, money
from ordermill.functions.order_time import elapsed_days
from ordermill.operators.distribution import label_counts
from ordermill.operators.quantiles import quantiles
from ordermill.operators.ranking import top
from ordermill.operators.sharing import shared
from ordermill.plans.activity import with_orders
from ordermill.plans.sales import named_categories


def loyalty(facts: DataFrame, method: str = "exact", ordered: bool = True) -> DataFrame:
    """Restaurants with orders, spend, mean line spend, monthly order rate and frequency segment.

    `orders_per_month` divides whole orders by whole days and drops the fraction before the factor
    of 30, so it is 0, 30, 60 and so on; `orders_per_month_exact` does not. Both are NULL if all
    orders fall within one day. `facts` are orders or restaurant days.
    """
    base = shared(
        with_orders(facts)
        .filter(F.col("restaurantid").isNotNull())
        .groupBy("restaurantid")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.sum("revenue").alias("spend"),
            F.sum("priced_lines").alias("priced_lines"),
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
        )
    )
    limits = quantiles(base, {"p75": ("total_orders", "0.75")}, method)
    days = F.nullif(elapsed_days(F.col("first_ts"), F.col("last_ts")).cast("bigint"), F.lit(0).cast("bigint"))
    per_day = F.call_function("div", F.col("total_orders"), days)
    report = base.withColumn("limits", limits).select(
        "restaurantid",
        "total_orders",
        money(F.col("spend")).alias("total_spend"),
        mean_money(F.col("spend"), F.col("priced_lines")).alias("avg_item_spend"),
        (per_day * 30).cast(MONEY).alias("orders_per_month"),
        half_up_ratio(F.col("total_orders") * 30, days, 2).alias("orders_per_month_exact"),
        F.when(F.col("total_orders") >= F.col("limits.p75"), "High Frequency")
        .otherwise("Low Frequency")
        .alias("frequency_segment"),
    )
    return report.orderBy(F.desc_nulls_last("total_orders"), "restaurantid") if ordered else report


def loyalty_kpis(loyalty: DataFrame) -> DataFrame:
    """Number and mean spend of each segment; the mean of an empty segment is NULL."""
    figures = []
    for short, segment in (("high", "High Frequency"), ("low", "Low Frequency")):
        inside = F.col("frequency_segment") == segment
        spend = F.when(inside, F.col("total_spend"))
        figures += [
            F.count_if(inside).alias(f"{short}_frequency_restaurants"),
            mean_money(F.sum(spend), F.count(spend)).alias(f"avg_spend_{short}_frequency"),
        ]
    return loyalty.agg(*figures)


def loyalty_segments(loyalty: DataFrame) -> DataFrame:
    return label_counts(loyalty, "frequency_segment", "restaurants")


def loyalty_top(loyalty: DataFrame, k: int = 20) -> DataFrame:
    return top(loyalty, "total_orders", "restaurantid", k).select(
        "restaurantid", "total_orders", "total_spend", "orders_per_month", "frequency_segment"
    )


def loyalty_category_preference(items: DataFrame, loyalty: DataFrame) -> DataFrame:
    """Revenue, items and revenue share of each named category within a frequency segment.

    Lines are summed per restaurant and category before they meet the segments. The totals to take
    the share of are two rows, one per segment.
    """
    per_restaurant = (
        named_categories(items)
        .filter(F.col("restaurantid").isNotNull() & F.col("orderid").isNotNull())
        .groupBy("restaurantid", "itemcategory")
        .agg(
            F.sum(F.col("itemprice") * F.col("itemquantity")).alias("revenue"),
            F.sum("itemquantity").alias("items"),
        )
    )
    per_segment = shared(
        per_restaurant.join(loyalty.select("restaurantid", "frequency_segment"), "restaurantid")
        .groupBy("frequency_segment", "itemcategory")
        .agg(money(F.sum("revenue")).alias("total_revenue"), F.sum("items").alias("total_items"))
    )
    best_first = F.struct(F.col("total_revenue"), F.col("itemcategory"))
    totals = per_segment.groupBy("frequency_segment").agg(
        F.sum("total_revenue").alias("segment_revenue"),
        F.max("total_revenue").alias("top_revenue"),
        F.max(F.when(F.col("total_revenue").isNotNull(), best_first)).alias("best"),
    )
    return per_segment.join(F.broadcast(totals), "frequency_segment").select(
        "frequency_segment",
        "itemcategory",
        "total_revenue",
        "total_items",
        half_up_ratio(F.col("total_revenue"), F.col("segment_revenue"), 4).alias("revenue_share"),
        F.coalesce(F.col("itemcategory") == F.col("best.itemcategory"), F.lit(False)).alias("is_top_category"),
    )
