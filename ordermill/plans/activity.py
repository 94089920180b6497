"""What each restaurant did on each day: the small table behind the reports per restaurant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.amounts import MONEY_SUM


def as_days(facts: DataFrame) -> DataFrame:
    """Order facts under the columns of `restaurant_days`, not yet grouped; a table of days as it is.

    Revenue and lines without an order id are left out; such a row counts no orders.
    """
    if "last_ts" in facts.columns:
        return facts
    known = F.col("orderid").isNotNull()
    return facts.select(
        "restaurantid",
        "order_date",
        F.to_date("order_ts").alias("day"),
        F.col("order_ts").alias("first_ts"),
        F.col("order_ts").alias("last_ts"),
        known.cast("bigint").alias("orders"),
        F.when(known, F.col("revenue")).alias("revenue"),
        F.when(known, F.col("priced_lines")).alias("priced_lines"),
    )


def with_orders(facts: DataFrame) -> DataFrame:
    """`as_days` of the rows that have an order."""
    return as_days(facts).filter("orders > 0") if "last_ts" in facts.columns else as_days(facts.filter("orderid IS NOT NULL"))


def restaurant_days(order_facts: DataFrame) -> DataFrame:
    """Orders, revenue, priced lines, first and last order time of each restaurant and day, NULL keys included.

    An order id belongs to one restaurant, so orders of several days or restaurants add up.
    """
    return (
        as_days(order_facts)
        .groupBy("restaurantid", "order_date", "day")
        .agg(
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
            F.sum("orders").alias("orders"),
            F.sum("revenue").cast(MONEY_SUM).alias("revenue"),
            F.sum("priced_lines").alias("priced_lines"),
        )
    )


def restaurant_months(days: DataFrame) -> DataFrame:
    """Per restaurant and month: the days with orders as bits (bit d - 1 for day d), orders, revenue, first and last order time.

    Day bits of overlapping loads combine by OR, so a day counts once however often it is loaded; orders and revenue add up over separate loads. Rows without a day
    have month NULL and no bits.
    """
    return (
        days.groupBy("restaurantid", F.date_format("day", "yyyy-MM").alias("month"))
        .agg(
            F.coalesce(F.bit_or(F.call_function("shiftleft", F.lit(1), F.dayofmonth("day") - 1)), F.lit(0)).alias("day_bits"),
            F.sum("orders").alias("orders"),
            F.sum("revenue").cast(MONEY_SUM).alias("revenue"),
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
        )
    )


def active_days(*months: DataFrame) -> DataFrame:
    """(restaurantid, active_days, active_months): distinct days and months with orders over all given tables of months, which may overlap.

    At most one small row per restaurant, month and table is grouped, not the days again.
    """
    whole = months[0].select("restaurantid", "month", "day_bits")
    for other in months[1:]:
        whole = whole.unionByName(other.select("restaurantid", "month", "day_bits"))
    merged = whole.groupBy("restaurantid", "month").agg(F.bit_or("day_bits").alias("day_bits"))
    return merged.groupBy("restaurantid").agg(
        F.sum(F.bit_count("day_bits")).cast("bigint").alias("active_days"), F.count_if(F.col("day_bits") != 0).alias("active_months")
    )
