from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from ordermill.plans.bronze import ITEM_COLUMNS, bronze_order_item_options, bronze_order_items, repaired
from ordermill.plans.silver import silver_order_item_options
from ordermill.sources.jdbc import SourceSchemaError

RAW = (
    "app_name string, restaurant_id bigint, creation_time_utc timestamp_ntz, order_id string, user_id string,"
    " printed_card_number string, is_loyalty string, currency string, lineitem_id string, item_category string,"
    " item_name string, item_price string, item_quantity string"
)


def raw(spark, **changes):
    row = {
        "app_name": "app", "restaurant_id": 7, "creation_time_utc": datetime(2001, 1, 2, 3, 4, 5, 678999),
        "order_id": "o1", "user_id": None, "printed_card_number": None, "is_loyalty": None, "currency": "USD",
        "lineitem_id": "1", "item_category": "food", "item_name": "soup", "item_price": "1.005", "item_quantity": "2",
        **changes,
    }
    return spark.createDataFrame([tuple(row.values())], RAW)


def test_names_types_and_order(spark):
    df = bronze_order_items(raw(spark))
    assert tuple(df.columns) == ITEM_COLUMNS
    types = dict(df.dtypes)
    assert (types["restaurantid"], types["lineitemid"], types["itemprice"], types["isloyalty"]) == (
        "string", "int", "decimal(10,2)", "boolean",
    )
    row = df.first()
    assert row["restaurantid"] == "7"
    assert row["creationtimeutc"] == "2001-01-02T03:04:05.678Z"
    assert row["itemprice"] == Decimal("1.01")


@pytest.mark.parametrize(
    "column, bad, target",
    [
        ("item_price", "123456789.00", "itemprice"),
        ("item_price", "free", "itemprice"),
        ("item_quantity", "99999999999", "itemquantity"),
        ("lineitem_id", "x", "lineitemid"),
        ("is_loyalty", "perhaps", "isloyalty"),
    ],
)
def test_a_bad_value_becomes_null(spark, column, bad, target):
    assert bronze_order_items(raw(spark, **{column: bad})).first()[target] is None


def test_columns_without_a_fixed_type_may_be_missing(spark):
    df = bronze_order_items(raw(spark).drop("app_name", "currency", "creation_time_utc"))
    assert tuple(df.columns) == tuple(c for c in ITEM_COLUMNS if c not in ("appname", "currency", "creationtimeutc"))


def test_a_typed_column_may_not_be_missing(spark):
    with pytest.raises(SourceSchemaError, match="isloyalty"):
        bronze_order_items(raw(spark).drop("is_loyalty"))


def test_a_source_without_columns_is_refused(spark):
    with pytest.raises(SourceSchemaError):
        bronze_order_items(spark.createDataFrame([], "a int").select())


def test_names_that_are_flat_already_and_extra_columns(spark):
    flat = raw(spark).withColumnsRenamed({"order_id": "orderid"}).selectExpr("*", "1 AS surplus")
    assert tuple(bronze_order_items(flat).columns) == ITEM_COLUMNS


def test_options_keep_unknown_columns(spark):
    df = spark.createDataFrame(
        [("o1", 2, "Discount", "A", -1.255, "3", "kept")],
        "ORDER_ID string, LINEITEM_ID int, OPTION_GROUP_NAME string, OPTION_NAME string, OPTION_PRICE double,"
        " OPTION_QUANTITY string, NOTE string",
    )
    out = bronze_order_item_options(df)
    assert dict(out.dtypes) == {
        "orderid": "string", "lineitemid": "string", "optiongroupname": "string", "optionname": "string",
        "optionprice": "decimal(10,2)", "optionquantity": "int", "NOTE": "string",
    }
    row = out.first()
    assert (row["lineitemid"], row["optionquantity"], row["NOTE"]) == ("2", 3, "kept")


@pytest.mark.parametrize("change", [str.upper, str.lower, lambda name: name.replace("_", "")])
def test_names_in_any_case_give_all_columns(spark, change):
    source = raw(spark)
    df = bronze_order_items(source.toDF(*[change(c) for c in source.columns]))
    assert tuple(df.columns) == ITEM_COLUMNS and df.first()["currency"] == "USD"


def test_two_columns_for_one_target_are_an_error(spark):
    with pytest.raises(SourceSchemaError, match="itemprice"):
        bronze_order_items(raw(spark).withColumn("ItemPrice", F.lit("1")))
    options = spark.createDataFrame([("o", "1", "g", "n", "1", "1", "2")], "order_id string, LINEITEM_ID string, g string, n string, OPTION_PRICE string, OPTION_QUANTITY string, ORDERID string")
    with pytest.raises(SourceSchemaError, match="orderid"):
        bronze_order_item_options(options)


def test_a_trace_tells_unreadable_from_absent(spark):
    items = bronze_order_items(raw(spark, item_price="free", item_quantity=None), trace=True).first()
    assert (items["itemprice"], items["itemquantity"], items["unreadable"]) == (None, None, ["itemprice"])
    options = spark.createDataFrame(
        [("o", "1", "abc", "1"), ("o", "1", None, "1"), ("o", "1", "1.5", "x"), (None, "1", "2", "3")],
        "ORDER_ID string, LINEITEM_ID string, OPTION_PRICE string, OPTION_QUANTITY string",
    )
    rows = silver_order_item_options(bronze_order_item_options(options, trace=True)).collect()
    assert [(r["has_order_id"], r["has_amount"], r["unreadable_price"], r["unreadable_quantity"]) for r in rows] == [
        (True, False, True, False), (True, False, False, False), (True, False, False, True), (False, True, False, False),
    ]


def test_rescued_values_can_be_read_again(spark):
    source = raw(spark, item_price="12,50 EUR", item_quantity="two", lineitem_id="7")
    items = bronze_order_items(source.unionByName(raw(spark)), trace=True, rescue=True)
    again = repaired(items, {"itemprice": lambda text: F.replace(F.regexp_replace(text, "[^0-9,]", ""), F.lit(","), F.lit(".")), "itemquantity": lambda text: text})
    row = again.where("lineitemid = 7").selectExpr("itemprice", "itemquantity", "unreadable", "CAST(rescued AS string) AS left_over").first()
    assert (str(row.itemprice), row.itemquantity, row.unreadable, row.left_over) == ("12.50", None, ["itemquantity"], '{"itemquantity":"two"}')
    other = again.where("lineitemid <> 7")
    assert other.where("rescued IS NULL AND size(unreadable) = 0").count() == 1
    assert items.selectExpr("CAST(rescued AS string) AS r").where("r IS NOT NULL").first().r == '{"itemprice":"12,50 EUR","itemquantity":"two"}'
    options = spark.createDataFrame([("o", "1", "abc", "1", "x")], "ORDER_ID string, LINEITEM_ID string, OPTION_PRICE string, OPTION_QUANTITY string, more string")
    assert bronze_order_item_options(options, rescue=True).selectExpr("CAST(rescued AS string) AS r").first().r == '{"optionprice":"abc"}'


def test_lists_and_variants_are_compiled(spark):
    df = bronze_order_items(raw(spark), trace=True, rescue=True)
    again = repaired(df, {"itemprice": lambda text: F.rtrim(text, F.lit(" EUR"))})
    for frame in (df, again):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "lambda" not in plan and "filter(" not in plan
