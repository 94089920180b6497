from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from ordermill.functions.order_time import elapsed_days, strict_order_date, tolerant_order_ts

NOON = datetime(2001, 1, 2, 12, 0)
CASES = {
    "2001-01-02T12:00:00.000Z": (date(2001, 1, 2), NOON),
    "2001-01-02T12:00:00Z": (None, NOON),
    "2001-01-02T12:00:00.1Z": (date(2001, 1, 2), datetime(2001, 1, 2, 12, 0, 0, 100000)),
    "2001-01-02 12:00:00": (None, NOON),
    "2001-01-02T12:00Z": (None, NOON),
    "2001-01-02": (None, datetime(2001, 1, 2)),
    "2001-01-02Z": (None, datetime(2001, 1, 2)),
    "2001-02-30T12:00:00.000Z": (None, None),
    "garbage": (None, None),
    "12345": (None, None),
    "2001": (None, None),
    "": (None, None),
    None: (None, None),
}


def test_both_readings(spark):
    df = spark.createDataFrame([(k,) for k in CASES], "orderid string")
    read = df.select("orderid", strict_order_date(F.col("orderid")), tolerant_order_ts(F.col("orderid")))
    assert {r[0]: (r[1], r[2]) for r in read.collect()} == CASES


def test_readings_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2021-03-14T02:30:00.000Z",)], "orderid string")
        row = df.select(strict_order_date(F.col("orderid")), tolerant_order_ts(F.col("orderid"))).first()
        assert tuple(row) == (date(2021, 3, 14), datetime(2021, 3, 14, 2, 30))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_elapsed_days_are_whole_days_not_dates(spark):
    row = spark.sql("SELECT timestamp_ntz'2001-01-01 23:00:00' AS a, timestamp_ntz'2001-01-03 01:00:00' AS b")
    assert row.select(elapsed_days(F.col("a"), F.col("b")), F.date_diff("b", "a")).first()[:] == (1, 2)
