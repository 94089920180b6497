"""Raw order tables derived from the given lineitem, orders and part tables.

The source system's own tables are not available, so these stand in for them: raw column names and
raw types, as a JDBC read would return them, with the data-quality problems the pipeline must take
(NULL ids, ids without milliseconds, NULL and empty categories).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.order_time import ISO_MILLIS

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# Ends before and starts after the first orders, so that some stay without a calendar day.
CALENDAR_FIRST = date(1996, 1, 1)
CALENDAR_LAST = date(2001, 12, 31)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their time of day and text id, derived before any join: once per order."""
    key = F.col("o_orderkey")
    seconds = (key * 7919 % 86400000 / F.lit(1000).cast("decimal(4,0)")).cast("decimal(18,6)")
    at = F.col("o_orderdate") + F.make_dt_interval(secs=seconds)
    return (
        _table(spark, folder, "orders")
        .select("o_orderkey", "o_custkey", at.alias("placed_at"))
        .withColumn(
            "order_id",
            F.when(key % 997 == 0, F.lit(None))
            .when(key % 501 == 0, F.date_format("placed_at", ISO_SECONDS))
            .otherwise(F.date_format("placed_at", ISO_MILLIS)),
        )
    )


def raw_order_items(spark: SparkSession, folder: str, restaurants: int | None = None) -> DataFrame:
    """Order lines; with `restaurants` all customers' orders go to that many restaurants, some of them very large."""
    restaurant = F.col("o_custkey") if restaurants is None else F.col("o_custkey") % restaurants
    category = (
        F.when(F.col("p_size") % 17 == 0, F.lit(None)).when(F.col("p_size") % 19 == 0, F.lit("")).otherwise(F.col("p_type"))
    )
    part = _table(spark, folder, "part").select(
        "p_partkey",
        "p_name",
        F.col("p_retailprice").cast("decimal(10,2)").alias("item_price"),
        category.alias("item_category"),
    )
    return (
        _table(spark, folder, "lineitem")
        .join(_orders(spark, folder), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.lit("app").alias("app_name"),
            restaurant.alias("restaurant_id"),
            F.col("placed_at").alias("creation_time_utc"),
            "order_id",
            F.lit(None).cast("string").alias("user_id"),
            F.lit(None).cast("string").alias("printed_card_number"),
            F.lit(None).cast("int").alias("is_loyalty"),
            F.lit("USD").alias("currency"),
            F.col("l_linenumber").alias("lineitem_id"),
            "item_category",
            F.col("p_name").alias("item_name"),
            "item_price",
            F.col("l_quantity").alias("item_quantity"),
        )
    )


def raw_order_item_options(spark: SparkSession, folder: str) -> DataFrame:
    is_discount = F.col("l_returnflag") == "A"
    lines = _table(spark, folder, "lineitem").filter(
        (F.col("l_linenumber") <= 3) & F.col("l_returnflag").isin("A", "N") & (F.col("l_orderkey") % 3 == 0)
    )
    return lines.join(_orders(spark, folder), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("order_id").alias("ORDER_ID"),
        F.col("l_linenumber").alias("LINEITEM_ID"),
        F.when(is_discount, "Discount").otherwise("Add-on").alias("OPTION_GROUP_NAME"),
        F.col("l_returnflag").alias("OPTION_NAME"),
        F.when(is_discount, -F.col("l_discount") * 100).otherwise(F.col("l_tax") * 100).alias("OPTION_PRICE"),
        (1 + F.col("l_linenumber") % 3).alias("OPTION_QUANTITY"),
    )
