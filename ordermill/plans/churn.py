"""Churn risk of each restaurant, from the gold retention table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.amounts import half_up_ratio
from ordermill.operators.distribution import distribution_over
from ordermill.operators.sharing import shared

STATUSES = ("At Risk", "Watch", "Active")
# Days without an order beyond which a restaurant gets the status.
AT_RISK_DAYS = 45
WATCH_DAYS = 20


def churn(retention: DataFrame, ordered: bool = True) -> DataFrame:
    """Days since the last order, mean gap between active days and status, by calendar days.

    Retention holds each day of a restaurant once, so its days are counted as they are. The NULL
    restaurant is kept; one without a dated order has no day difference and counts as Active.
    """
    activity = shared(
        retention.groupBy("restaurantid").agg(
            F.min("order_date").alias("first_date"),
            F.max("order_date").alias("last_date"),
            F.count("order_date").alias("active_days"),
            F.sum("orders").alias("total_orders"),
        )
    )
    latest = activity.agg(F.max("last_date").alias("latest")).scalar()
    span = F.date_diff("last_date", "first_date")
    gaps = F.when(F.col("active_days") > 1, F.col("active_days") - 1)
    days = F.col("days_since_last_order")
    report = activity.withColumn("days_since_last_order", F.date_diff(latest, F.col("last_date"))).select(
        "restaurantid",
        F.col("last_date").cast("string").alias("last_order_date"),
        "days_since_last_order",
        "total_orders",
        half_up_ratio(span, gaps, 1).alias("avg_order_gap_days"),
        F.when(days > AT_RISK_DAYS, "At Risk").when(days > WATCH_DAYS, "Watch").otherwise("Active").alias("churn_status"),
    )
    return report.orderBy(F.desc_nulls_last("days_since_last_order"), "restaurantid") if ordered else report


def churn_kpis(churn: DataFrame) -> DataFrame:
    days = F.col("days_since_last_order")
    return churn.agg(
        F.count("*").alias("total_restaurants"),
        F.count_if(F.col("churn_status") == "At Risk").alias("at_risk"),
        F.count_if(F.col("churn_status") == "Watch").alias("watch"),
        half_up_ratio(F.sum(days), F.count(days), 0).cast("bigint").alias("avg_days_since_order"),
    )


def churn_status(churn: DataFrame) -> DataFrame:
    return distribution_over(churn, "churn_status", STATUSES, "restaurants")


def churn_at_risk(churn: DataFrame) -> DataFrame:
    return churn.filter(F.col("churn_status") == "At Risk").select(
        "restaurantid", "last_order_date", "days_since_last_order", "avg_order_gap_days"
    )


def churn_histogram(churn: DataFrame) -> DataFrame:
    """Restaurants per number of days since the last order; those without one are not counted."""
    days = F.col("days_since_last_order")
    return churn.filter(days.isNotNull()).groupBy(days).agg(F.count("*").alias("restaurants")).orderBy(days)
