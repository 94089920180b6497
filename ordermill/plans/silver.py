"""Silver tables: order lines with times and amounts, and the additive facts reports roll up.

`item_facts` and `order_facts` have the same measures at line and at order grain, as have
`option_facts` and `order_option_facts`. A plan that only sums measures takes either: line grain
saves a shuffle when it starts from bronze, order grain saves reading lines when it is stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.amounts import MONEY_SUM
from ordermill.functions.order_time import strict_order_date, tolerant_order_ts
from ordermill.plans import bronze

ITEM_MEASURES = ("revenue", "items", "lines", "priced_lines")


def _flags(df: DataFrame, **columns: str) -> list[Column]:
    """For each flag whether its column has a value or, of a traced table, one that could not be read."""
    traced = bronze.UNREADABLE in df.columns
    bad = F.col(bronze.UNREADABLE) if traced else F.array().cast("array<string>")
    return [F.array_contains(bad, column).alias(flag) for flag, column in columns.items()]


def silver_order_items(items: DataFrame) -> DataFrame:
    """Bronze lines plus both readings of the order time and the line's revenue.

    Rows with an unreadable id or amount are flagged, not dropped. Of a traced bronze table the column `unreadable` stays, so an
    absent amount can be told from one that could not be read.
    """
    revenue = F.col("itemprice") * F.col("itemquantity")
    return items.select(
        "*",
        tolerant_order_ts(F.col("orderid")).alias("order_ts"),
        strict_order_date(F.col("orderid")).alias("order_date"),
        revenue.alias("line_revenue"),
    ).select(
        "*",
        F.col("order_ts").isNotNull().alias("has_order_time"),
        F.col("line_revenue").isNotNull().alias("has_amount"),
    )


def silver_order_item_options(options: DataFrame) -> DataFrame:
    """Bronze options plus the order time and the option's amount, with flags for what is missing or was unreadable."""
    amount = F.col("optionprice") * F.col("optionquantity")
    return options.select(
        *[c for c in options.columns if c != bronze.UNREADABLE],
        tolerant_order_ts(F.col("orderid")).alias("order_ts"),
        amount.alias("option_amount"),
        F.col("orderid").isNotNull().alias("has_order_id"),
        amount.isNotNull().alias("has_amount"),
        *_flags(options, unreadable_price="optionprice", unreadable_quantity="optionquantity"),
    )


def item_facts(items: DataFrame) -> DataFrame:
    """Measures of each order line."""
    revenue = (F.col("itemprice") * F.col("itemquantity")).cast(MONEY_SUM)
    return items.select(
        "restaurantid",
        "orderid",
        revenue.alias("revenue"),
        F.col("itemquantity").cast("bigint").alias("items"),
        F.lit(1).cast("bigint").alias("lines"),
        revenue.isNotNull().cast("bigint").alias("priced_lines"),
    )


def order_facts(items: DataFrame) -> DataFrame:
    """Measures of each (restaurant, order), NULL keys included, with both order times.

    Grouping on both ids spreads a restaurant that holds a large share of all lines; the times are
    read from the id after the grouping, once per order.
    """
    facts = item_facts(items)
    return (
        facts.groupBy("restaurantid", "orderid")
        .agg(
            F.sum("revenue").cast(MONEY_SUM).alias("revenue"),
            *[F.sum(m).alias(m) for m in ITEM_MEASURES if m != "revenue"],
        )
        .withColumn("order_ts", tolerant_order_ts(F.col("orderid")))
        .withColumn("order_date", strict_order_date(F.col("orderid")))
    )


def option_facts(options: DataFrame) -> DataFrame:
    """Measures of each option; a price below zero is a discount, above zero an add-on."""
    price = F.col("optionprice")
    amount = (price * F.col("optionquantity")).cast(MONEY_SUM)
    nothing = F.lit(0).cast(MONEY_SUM)
    return options.select(
        "orderid",
        amount.alias("option_revenue"),
        F.when(price < 0, amount).otherwise(nothing).alias("discount"),
        F.when(price > 0, amount).otherwise(nothing).alias("addon"),
        F.lit(1).cast("bigint").alias("options"),
        F.when(price < 0, 1).otherwise(0).cast("bigint").alias("discount_options"),
    )


def order_option_facts(options: DataFrame) -> DataFrame:
    """Option measures of each order, NULL id included."""
    amounts = ("option_revenue", "discount", "addon")
    return (
        option_facts(options)
        .groupBy("orderid")
        .agg(
            *[F.sum(m).cast(MONEY_SUM).alias(m) for m in amounts],
            *[F.sum(m).alias(m) for m in ("options", "discount_options")],
        )
    )
