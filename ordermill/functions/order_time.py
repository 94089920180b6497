"""Order time, recovered from the order id, which is an ISO-8601 text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The strict id format, and the shapes the tolerant reading accepts.
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
ORDER_TIME_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?)?Z?$"


def strict_order_date(orderid: Column) -> Column:
    """Date of an id in exactly `ISO_MILLIS`; NULL otherwise, so an id without a fraction has none."""
    return F.to_date(F.try_to_timestamp(orderid, F.lit(ISO_MILLIS)))


def tolerant_order_ts(orderid: Column) -> Column:
    """Timestamp of an id with or without time, seconds or fraction; NULL for anything else.

    Spark's own cast reads both the `T` and the blank separator. It also reads a bare number
    as a year, hence the shape test in front.
    """
    return F.when(
        orderid.rlike(ORDER_TIME_SHAPE),
        F.rtrim(orderid, F.lit("Z")).try_cast("timestamp_ntz"),
    )


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole 24-hour days between two timestamps, whatever the session time zone."""
    return F.extract(F.lit("DAY"), end - start)
