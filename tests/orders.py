"""Small hand-written order tables."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

ITEMS = "restaurantid string, orderid string, itemcategory string, itemprice decimal(10,2), itemquantity int"
OPTIONS = "orderid string, optionprice decimal(10,2), optionquantity int"


def dec(text: object) -> Decimal | None:
    return None if text is None else Decimal(str(text))


def items(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (restaurant, order, price, quantity) or (restaurant, order, category, price, quantity)."""
    full = [r if len(r) == 5 else (r[0], r[1], "food", r[2], r[3]) for r in rows]
    return spark.createDataFrame([(a, b, c, dec(p), q) for a, b, c, p, q in full], ITEMS)


def options(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame([(o, dec(p), q) for o, p, q in rows], OPTIONS)


def at(day: str, time: str = "12:00:00.000") -> str:
    return f"{day}T{time}Z"
