"""Recency, frequency and monetary value of each restaurant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.amounts import mean_money, money
from ordermill.functions.order_time import elapsed_days
from ordermill.operators.distribution import label_counts
from ordermill.operators.quantiles import quantiles
from ordermill.operators.ranking import top
from ordermill.operators.sharing import shared
from ordermill.plans.activity import with_orders


def rfm(facts: DataFrame, method: str = "exact", ordered: bool = True) -> DataFrame:
    """Restaurants with recency in elapsed days, distinct orders, revenue and segment.

    The reference time is the latest order of all, restaurants without an id included; they are
    dropped only after it is known, so one grouping serves both. `facts` are orders or restaurant days.
    """
    per_restaurant = shared(
        with_orders(facts)
        .groupBy("restaurantid")
        .agg(
            F.max("last_ts").alias("last_ts"),
            F.sum("orders").alias("frequency"),
            money(F.sum("revenue")).alias("monetary"),
            F.count("restaurantid").alias("known"),
        )
    )
    latest = per_restaurant.agg(F.max("last_ts").alias("latest")).scalar()
    base = per_restaurant.filter(F.col("known") > 0).select(
        "restaurantid",
        elapsed_days(F.col("last_ts"), latest).alias("recency_days"),
        "frequency",
        "monetary",
    )
    limits = quantiles(
        shared(base),
        {
            "r_p33": ("recency_days", "0.33"),
            "r_p66": ("recency_days", "0.66"),
            "f_p33": ("frequency", "0.33"),
            "f_p66": ("frequency", "0.66"),
            "m_p66": ("monetary", "0.66"),
        },
        method,
    )
    recent = F.col("recency_days") <= F.col("limits.r_p33")
    lapsed = F.col("recency_days") >= F.col("limits.r_p66")
    frequent = F.col("frequency") >= F.col("limits.f_p66")
    rare = F.col("frequency") <= F.col("limits.f_p33")
    report = base.withColumn("limits", limits).select(
        "restaurantid",
        "recency_days",
        "frequency",
        "monetary",
        F.when(recent & frequent & (F.col("monetary") >= F.col("limits.m_p66")), "VIP")
        .when(recent & rare, "New Customer")
        .when(lapsed & rare, "Churn Risk")
        .otherwise("Active")
        .alias("rfm_segment"),
    )
    return report.orderBy(F.desc_nulls_last("monetary"), "restaurantid") if ordered else report


def rfm_kpis(rfm: DataFrame) -> DataFrame:
    return rfm.agg(
        F.count("*").alias("total_restaurants"),
        F.count_if(F.col("rfm_segment") == "VIP").alias("vip_restaurants"),
        F.count_if(F.col("rfm_segment") == "Churn Risk").alias("churn_risk"),
        mean_money(F.sum("monetary"), F.count("monetary")).alias("avg_monetary"),
    )


def rfm_segments(rfm: DataFrame) -> DataFrame:
    return label_counts(rfm, "rfm_segment", "restaurants")


def rfm_top(rfm: DataFrame, k: int = 20) -> DataFrame:
    return top(rfm, "monetary", "restaurantid", k)


def rfm_avg_monetary(rfm: DataFrame) -> DataFrame:
    return (
        rfm.groupBy("rfm_segment")
        .agg(mean_money(F.sum("monetary"), F.count("monetary")).alias("avg_monetary"))
        .orderBy("rfm_segment")
    )
