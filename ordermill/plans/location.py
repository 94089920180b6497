"""Revenue ranking of restaurants."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.amounts import mean_money, money
from ordermill.operators.ranking import global_rank, top
from ordermill.operators.sharing import shared
from ordermill.plans.activity import with_orders


def location_figures(facts: DataFrame, cohort: DataFrame | None = None) -> DataFrame:
    """Revenue, orders, mean line value and active days of each restaurant, not yet ranked.

    `cohort` is the gold table; without it the cohort month comes out of the same grouping. Days are
    counted by grouping on them first, which spreads a large restaurant over many tasks. `facts` are orders or restaurant days.
    """
    days = (
        with_orders(facts)
        .filter(F.col("restaurantid").isNotNull())
        .groupBy("restaurantid", "day")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("priced_lines").alias("priced_lines"),
            F.sum("orders").alias("orders"),
            F.min("order_date").alias("first_date"),
        )
    )
    figures = days.groupBy("restaurantid").agg(
        F.date_format(F.min("first_date"), "yyyy-MM").alias("own_cohort_month"),
        money(F.sum("revenue")).alias("total_revenue"),
        F.sum("orders").alias("total_orders"),
        mean_money(F.sum("revenue"), F.sum("priced_lines")).alias("avg_order_value"),
        F.count("day").alias("active_days"),
    )
    if cohort is None:
        joined, month = figures, F.col("own_cohort_month")
    else:
        joined = figures.join(cohort.select("restaurantid", "cohort_month"), "restaurantid", "left")
        month = F.col("cohort_month")
    return joined.select(
        "restaurantid", month.alias("cohort_month"), "total_revenue", "total_orders", "avg_order_value", "active_days"
    )


def location(facts: DataFrame, cohort: DataFrame | None = None, ordered: bool = True) -> DataFrame:
    report = global_rank(shared(location_figures(facts, cohort)), "total_revenue", "revenue_rank")
    return report.orderBy(F.desc_nulls_last("total_revenue"), "restaurantid") if ordered else report


def location_kpis(figures: DataFrame) -> DataFrame:
    return figures.agg(
        F.count("*").alias("total_locations"),
        F.max("total_revenue").alias("top_location_revenue"),
        mean_money(F.sum("total_revenue"), F.count("total_revenue")).alias("avg_location_revenue"),
        mean_money(F.sum("avg_order_value"), F.count("avg_order_value")).alias("avg_order_value"),
    )


def location_top(figures: DataFrame, k: int = 20) -> DataFrame:
    """The k best with their rank, which needs only the k rows: no lower row can change it."""
    by_revenue = Window.orderBy(F.desc_nulls_last("total_revenue"))
    return top(figures, "total_revenue", "restaurantid", k).select(
        F.rank().over(by_revenue).alias("revenue_rank"),
        "restaurantid",
        "cohort_month",
        "total_revenue",
        "total_orders",
        "avg_order_value",
    )


def location_series(figures: DataFrame, k: int = 20) -> DataFrame:
    return top(figures, "total_revenue", "restaurantid", k).select("restaurantid", "total_revenue")
