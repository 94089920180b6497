"""Effect of discounts and category prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.amounts import MONEY_SUM, mean_money, money
from ordermill.plans.sales import named_categories

ORDER_TYPES = ("Discounted", "Full Price")


def order_ledger(item_facts: DataFrame, option_facts: DataFrame, co_located: bool = False) -> DataFrame:
    """Item and option measures of each order with a known id, in one grouping of both inputs.

    With `co_located`, for inputs stored in buckets by order id, as a join of two groupings, which needs no shuffle.
    """
    if co_located:
        known = F.col("orderid").isNotNull()
        items = item_facts.where(known).groupBy("orderid").agg(F.sum("revenue").cast(MONEY_SUM).alias("revenue"), F.sum("lines").alias("lines"))
        sums = [F.sum(m).cast(MONEY_SUM).alias(m) for m in ("discount", "addon")] + [F.sum(m).alias(m) for m in ("options", "discount_options")]
        options = option_facts.where(known).groupBy("orderid").agg(*sums)
        return items.join(options.hint("shuffle_hash"), "orderid", "left").na.fill(0, ["options", "discount_options"]).withColumns(
            {m: F.coalesce(m, F.lit(0).cast(MONEY_SUM)) for m in ("discount", "addon")}
        )
    none, nothing = F.lit(0).cast("bigint"), F.lit(0).cast(MONEY_SUM)
    sides = (
        item_facts.select(
            "orderid",
            "revenue",
            "lines",
            nothing.alias("discount"),
            nothing.alias("addon"),
            none.alias("options"),
            none.alias("discount_options"),
        )
        .unionByName(
            option_facts.select(
                "orderid",
                F.lit(None).cast(MONEY_SUM).alias("revenue"),
                none.alias("lines"),
                "discount",
                "addon",
                "options",
                "discount_options",
            )
        )
        .filter(F.col("orderid").isNotNull())
    )
    return (
        sides.groupBy("orderid")
        .agg(
            *[F.sum(m).cast(MONEY_SUM).alias(m) for m in ("revenue", "discount", "addon")],
            *[F.sum(m).alias(m) for m in ("lines", "options", "discount_options")],
        )
        .filter(F.col("lines") > 0)
    )


def pricing(item_facts: DataFrame, option_facts: DataFrame, line_join: bool = False, co_located: bool = False) -> DataFrame:
    """Orders, gross, discounts, net and mean gross of discounted and full-price orders.

    `line_join` gives the figures of joining every line with every option of its order: an order's
    revenue then counts once per option, and its options once per line. Those sums follow from the
    order's own sums and counts, so the pairs are never formed. The default counts everything once.
    """
    per_option = F.greatest(F.col("options"), F.lit(1)) if line_join else F.lit(1)
    per_line = F.col("lines") if line_join else F.lit(1)
    orders = order_ledger(item_facts, option_facts, co_located).select(
        (F.col("discount_options") > 0).alias("is_discounted"),
        (F.col("revenue") * per_option).cast(MONEY_SUM).alias("gross"),
        (F.col("discount") * per_line).cast(MONEY_SUM).alias("discounts"),
        (F.col("addon") * per_line).cast(MONEY_SUM).alias("addons"),
    )
    return (
        orders.groupBy("is_discounted")
        .agg(
            F.count("*").alias("total_orders"),
            money(F.sum("gross")).alias("gross_revenue"),
            money(F.sum("discounts")).alias("total_discounts"),
            money(F.sum(F.col("gross") + F.col("discounts") + F.col("addons"))).alias("net_revenue"),
            mean_money(F.sum("gross"), F.count("gross")).alias("avg_order_value"),
        )
        .withColumn("is_discounted", F.when(F.col("is_discounted"), ORDER_TYPES[0]).otherwise(ORDER_TYPES[1]))
        .withColumnRenamed("is_discounted", "order_type")
    )


def pricing_kpis(pricing: DataFrame) -> DataFrame:
    """One row also without any orders: all figures are then 0."""
    zero = F.lit(0).cast("bigint")

    def orders(order_type: str):
        return F.coalesce(F.sum(F.when(F.col("order_type") == order_type, F.col("total_orders"))), zero)

    return pricing.agg(
        orders("Discounted").alias("discounted_orders"),
        orders("Full Price").alias("full_price_orders"),
        money(F.coalesce(F.abs(F.sum("total_discounts")), zero)).alias("total_discount_given"),
        money(F.coalesce(F.sum("net_revenue"), zero)).alias("net_revenue"),
    )


def pricing_by_type(pricing: DataFrame) -> DataFrame:
    return pricing.select("order_type", "total_orders", "gross_revenue", "net_revenue")


def category_pricing(items: DataFrame) -> DataFrame:
    """Revenue, items, mean price and distinct orders of each named category.

    Grouping on the order first keeps the distinct count of a large category spread over tasks.
    """
    per_order = (
        named_categories(items)
        .groupBy("itemcategory", "orderid")
        .agg(
            F.sum(F.col("itemprice") * F.col("itemquantity")).alias("revenue"),
            F.sum("itemquantity").alias("items"),
            F.sum("itemprice").alias("prices"),
            F.count("itemprice").alias("priced"),
        )
    )
    return (
        per_order.groupBy("itemcategory")
        .agg(
            money(F.sum("revenue")).alias("total_revenue"),
            F.sum("items").alias("total_items"),
            mean_money(F.sum("prices"), F.sum("priced")).alias("avg_price"),
            F.count("orderid").alias("total_orders"),
        )
        .orderBy(F.desc_nulls_last("total_revenue"), "itemcategory")
    )


def category_price_series(category_pricing: DataFrame) -> DataFrame:
    return category_pricing.select("itemcategory", "total_revenue", "avg_price")
