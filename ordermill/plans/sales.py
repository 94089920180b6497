"""Sales trends and seasonality, from gold daily_clv, gold category_revenue and the calendar.

The calendar is joined without a hint: Spark broadcasts it after looking at its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.amounts import mean_money, money


def sales_daily(daily_clv: DataFrame, date_dim: DataFrame, ordered: bool = False) -> DataFrame:
    """One row per order with its calendar day, if it has one.

    The global sort by date is optional; revenue comes second in it so that a date with very many
    orders, or the missing one, is not a single task's range.
    """
    report = daily_clv.join(date_dim, F.col("order_date") == F.col("date_key"), "left").select(
        "order_date", "order_revenue", "day_of_week", "month", "year", "is_weekend"
    )
    return report.orderBy(F.asc_nulls_last("order_date"), "order_revenue") if ordered else report


def _by_calendar_day(daily_clv: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Revenue of each day with its calendar attributes: days are few, so sum before joining.

    Days outside the calendar drop out, as a left join would only give them NULL attributes.
    """
    days = daily_clv.groupBy("order_date").agg(F.sum("order_revenue").alias("day_revenue"))
    return days.join(date_dim, F.col("order_date") == F.col("date_key"), "left").filter(
        F.col("month").isNotNull() & F.col("is_weekend").isNotNull()
    )


def sales_monthly(daily_clv: DataFrame, date_dim: DataFrame) -> DataFrame:
    return (
        _by_calendar_day(daily_clv, date_dim)
        .groupBy("month", "month_num", "year")
        .agg(money(F.sum("day_revenue")).alias("monthly_revenue"))
        .orderBy(F.asc_nulls_last("year"), F.asc_nulls_last("month_num"))
    )


def sales_weekend(daily_clv: DataFrame, date_dim: DataFrame) -> DataFrame:
    return (
        _by_calendar_day(daily_clv, date_dim)
        .groupBy("is_weekend")
        .agg(money(F.sum("day_revenue")).alias("total_revenue"))
        .select(F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type"), "total_revenue")
    )


def named_categories(df: DataFrame) -> DataFrame:
    return df.filter(F.col("itemcategory").isNotNull() & (F.col("itemcategory") != ""))


def sales_category(category_revenue: DataFrame) -> DataFrame:
    return (
        named_categories(category_revenue)
        .select("itemcategory", "total_revenue")
        .orderBy(F.desc_nulls_last("total_revenue"), "itemcategory")
    )


def sales_kpis(daily_clv: DataFrame) -> DataFrame:
    """Totals over orders and over days.

    The two figures called daily average over, and take the peak of, single orders: that is the
    grain of the daily table. The true per-day figures stand next to them.
    """
    days = daily_clv.groupBy("order_date").agg(
        F.sum("order_revenue").alias("day_revenue"),
        F.count("order_revenue").alias("orders"),
        F.max("order_revenue").alias("peak"),
    )
    dated = F.when(F.col("order_date").isNotNull(), F.col("day_revenue"))
    return days.agg(
        money(F.sum("day_revenue")).alias("total_revenue"),
        mean_money(F.sum("day_revenue"), F.sum("orders")).alias("avg_daily_revenue"),
        F.max("peak").alias("peak_daily_revenue"),
        mean_money(F.sum(dated), F.count(dated)).alias("avg_revenue_per_day"),
        money(F.max(dated)).alias("peak_revenue_per_day"),
    )


def sales_series(daily_clv: DataFrame, ordered: bool = False) -> DataFrame:
    """Revenue of each order under its date."""
    series = daily_clv.select("order_date", "order_revenue")
    return series.orderBy(F.asc_nulls_last("order_date"), "order_revenue") if ordered else series


def sales_by_day(daily_clv: DataFrame) -> DataFrame:
    """Revenue of each day; orders without a date form one group."""
    return (
        daily_clv.groupBy("order_date")
        .agg(money(F.sum("order_revenue")).alias("day_revenue"), F.count("*").alias("orders"))
        .orderBy(F.asc_nulls_last("order_date"))
    )


def sales_monthly_series(monthly: DataFrame) -> DataFrame:
    return monthly.select(F.concat_ws(" ", "month", "year").alias("month_label"), "monthly_revenue")


def sales_on_days(daily_clv: DataFrame, date_dim: DataFrame, days: str) -> DataFrame:
    """Orders and revenue per month on the calendar's days that satisfy a condition (SQL text), from `daily_clv` stored in folders by month.

    The join is on the month too, which is the folder: the days that are left decide at run time which folders are read, without the condition
    having to name them.
    """
    chosen = date_dim.where(days).select("date_key", F.date_format("date_key", "yyyy-MM").alias("calendar_month"))
    same = (F.col("order_month") == F.col("calendar_month")) & (F.col("order_date") == F.col("date_key"))
    return (
        daily_clv.join(chosen, same)
        .groupBy("order_month")
        .agg(F.count(F.lit(1)).alias("total_orders"), money(F.sum("order_revenue")).alias("total_revenue"))
        .orderBy("order_month")
    )
