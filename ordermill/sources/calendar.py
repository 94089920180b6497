"""The calendar dimension: one row per day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The calendar's default bounds.
FIRST_DAY = date(2019, 1, 1)
LAST_DAY = date(2025, 12, 31)


def date_dim(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY) -> DataFrame:
    """Calendar from `first` to `last`, both included."""
    bounds = spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last"))
    return _with_attributes(_days(bounds))


def date_dim_spanning(df: DataFrame, day: str) -> DataFrame:
    """Calendar of all whole years from the earliest to the latest `day` in `df`."""
    bounds = df.agg(F.min(day).alias("a"), F.max(day).alias("b")).select(
        F.trunc("a", "year").alias("first"),
        F.make_date(F.year("b"), F.lit(12), F.lit(31)).alias("last"),
    )
    return _with_attributes(_days(bounds))


def _days(bounds: DataFrame) -> DataFrame:
    return bounds.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date_key"))


def _with_attributes(days: DataFrame) -> DataFrame:
    day = F.col("date_key")
    return days.select(
        day,
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.weekofyear(day).alias("week"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMMM").alias("month"),
        F.year(day).alias("year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        F.lit(None).cast("string").alias("holiday_name"),
    )
