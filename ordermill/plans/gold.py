"""Gold tables. `facts` is any grain of the silver item facts unless a docstring says otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.amounts import money
from ordermill.functions.order_time import strict_order_date
from ordermill.plans.activity import as_days


def order_metrics(facts: DataFrame) -> DataFrame:
    """Revenue and items of each order; lines without an order id form one group."""
    return facts.groupBy("orderid").agg(
        money(F.sum("revenue")).alias("order_revenue"),
        F.sum("items").alias("items_per_order"),
    )


def daily_clv(facts: DataFrame) -> DataFrame:
    """Revenue of each order with its date. The id fixes the date, so it is the only grouping key."""
    return order_metrics(facts).select(
        "orderid", strict_order_date(F.col("orderid")).alias("order_date"), "order_revenue"
    )


def category_revenue(items: DataFrame) -> DataFrame:
    """Revenue and items of each category of the order lines, NULL and '' included."""
    return items.groupBy("itemcategory").agg(
        money(F.sum(F.col("itemprice") * F.col("itemquantity"))).alias("total_revenue"),
        F.sum("itemquantity").alias("total_items"),
    )


def retention(facts: DataFrame) -> DataFrame:
    """Distinct orders of each restaurant and day, from orders or restaurant days. Both hold each order once, so they add up."""
    return as_days(facts).groupBy("restaurantid", "order_date").agg(F.sum("orders").alias("orders"))


def cohort(facts: DataFrame) -> DataFrame:
    """Month of each restaurant's first dated order; takes any rows with `order_date`."""
    return facts.groupBy("restaurantid").agg(
        F.date_format(F.min("order_date"), "yyyy-MM").alias("cohort_month")
    )
