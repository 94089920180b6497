from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from ordermill.session import shared_folder
from ordermill.sources import sample_orders, tables
from ordermill.sources.calendar import FIRST_DAY, LAST_DAY, date_dim, date_dim_spanning
from ordermill.sources.jdbc import JdbcSplit, SourceSchemaError, balanced_predicates, jdbc_options, read_jdbc, require_columns

URL = "jdbc:example://host/db"


def test_jdbc_options_of_a_whole_table():
    assert jdbc_options(URL, "dbo.t", {"user": "u", "driver": "d"}) == {
        "url": URL, "dbtable": "dbo.t", "fetchsize": "10000", "user": "u", "driver": "d",
    }


def test_jdbc_options_of_a_split_table():
    options = jdbc_options(URL, "t", split=JdbcSplit("created", "2020-01-01", "2024-01-01", 64), fetch_size=5)
    assert options == {
        "url": URL, "dbtable": "t", "fetchsize": "5", "partitionColumn": "created", "lowerBound": "2020-01-01",
        "upperBound": "2024-01-01", "numPartitions": "64",
    }


class Reader:
    """Stands in for a session: no database is started for a test."""

    def __init__(self, columns):
        self.read, self.calls, self.columns = self, [], columns

    def format(self, name):
        self.calls.append(("format", name))
        return self

    def options(self, **options):
        self.calls.append(("options", options))
        return self

    def load(self):
        return self

    def jdbc(self, url, table, predicates, properties):
        self.calls.append(("jdbc", url, table, predicates, properties))
        return self


def test_read_jdbc_passes_its_options_on():
    reader = Reader(["a"])
    assert read_jdbc(reader, URL, "t", {"user": "u"}) is reader
    assert reader.calls == [("format", "jdbc"), ("options", jdbc_options(URL, "t", {"user": "u"}))]


def test_read_jdbc_by_predicates():
    reader = Reader(["a"])
    read_jdbc(reader, URL, "t", {"user": "u"}, predicates=["a < 5", "a >= 5 OR a IS NULL"])
    assert reader.calls == [("jdbc", URL, "t", ["a < 5", "a >= 5 OR a IS NULL"], {"fetchsize": "10000", "user": "u"})]
    with pytest.raises(ValueError):
        read_jdbc(reader, URL, "t", predicates=["true"], split=JdbcSplit("a", "0", "1", 2))


def test_a_source_without_columns_fails():
    with pytest.raises(SourceSchemaError):
        read_jdbc(Reader([]), URL, "t")


def test_needed_columns(spark):
    df = spark.range(1)
    assert require_columns(df, ["id"]) is df
    with pytest.raises(SourceSchemaError, match="price"):
        require_columns(df, ["id", "price"])


def test_default_calendar(spark):
    df = date_dim(spark)
    row = df.agg(F.min("date_key"), F.max("date_key"), F.count("*"), F.count_distinct("date_key")).first()
    assert tuple(row) == (FIRST_DAY, LAST_DAY, 2557, 2557)
    assert df.columns == [
        "date_key", "day_of_week", "week", "month_num", "month", "year", "is_weekend", "is_holiday", "holiday_name",
    ]


def test_calendar_attributes(spark):
    rows = {r["date_key"]: r for r in date_dim(spark, date(2020, 12, 31), date(2021, 1, 4)).collect()}
    assert len(rows) == 5
    friday, saturday, monday = (rows[date(2021, 1, d)] for d in (1, 2, 4))
    assert tuple(friday)[1:] == ("Friday", 53, 1, "January", 2021, False, False, None)
    assert (saturday["is_weekend"], rows[date(2021, 1, 3)]["is_weekend"], monday["is_weekend"]) == (True, True, False)
    assert monday["week"] == 1


def test_calendar_spanning_data_covers_whole_years(spark):
    df = spark.createDataFrame([(date(2020, 6, 1),), (None,), (date(2021, 2, 3),)], "d date")
    row = date_dim_spanning(df, "d").agg(F.min("date_key"), F.max("date_key"), F.count("*")).first()
    assert tuple(row) == (date(2020, 1, 1), date(2021, 12, 31), 366 + 365)
    assert date_dim_spanning(df.filter("d IS NULL"), "d").count() == 0


def test_write_returns_its_audit(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    assert tables.write_parquet(df, str(tmp_path / "t")) == {"rows": 3, "nulls_a": 1, "nulls_b": 2}
    assert tables.read_parquet(spark, str(tmp_path / "t")).count() == 3
    audit = {r["column_name"]: tuple(r) for r in tables.audit_table(df, "t").collect()}
    assert audit == {"a": ("t", "a", "int", 3, 1), "b": ("t", "b", "string", 3, 2)}


def test_overwrite_replaces_the_table_or_only_its_partitions(spark, tmp_path):
    path, parts = str(tmp_path / "t"), str(tmp_path / "p")
    two = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    one = spark.createDataFrame([(9, "a")], "v int, k string")
    for df in (two, one):
        tables.write_parquet(df, path)
        tables.write_parquet(df, parts, partition_by=["k"])
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [9]
    assert sorted(r["v"] for r in spark.read.parquet(parts).collect()) == [2, 9]


def test_views(spark):
    assert tables.register_views({"gold/kpi_summary": spark.range(3)}, "shop") == ["shop_gold_kpi_summary"]
    assert tables.read_view(spark, "shop_gold_kpi_summary").count() == 3


def test_stage_writes_to_the_checkpoint_folder(spark):
    staged = tables.stage(spark.range(5), "numbers")
    assert staged.count() == 5
    assert all(f"{shared_folder(spark)}/numbers-" in path for path in staged.inputFiles())
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


class Session:
    """A session without a checkpoint folder."""

    def __init__(self):
        self.conf = self.sparkContext = self

    def get(self, key, *default):
        return default[0] if default else {"spark.sql.warehouse.dir": "store://warehouse/"}[key]

    def getCheckpointDir(self):
        return None


def test_without_a_checkpoint_folder_the_warehouse_holds_staged_tables():
    assert shared_folder(Session()) == "store://warehouse/staged"


def test_staged_folders_are_dropped_by_name_only(spark, tmp_path):
    from ordermill.session import drop_folder, new_folder

    folder = new_folder(spark, "mine")
    spark.range(3).write.parquet(f"{folder}/table")
    assert spark.read.parquet(f"{folder}/table").count() == 3
    drop_folder(spark, folder)
    with pytest.raises(Exception, match="does not exist|PATH_NOT_FOUND"):
        spark.read.parquet(f"{folder}/table")
    with pytest.raises(ValueError, match="not made by this run"):
        drop_folder(spark, str(tmp_path))
    assert tmp_path.exists()


def test_few_restaurants_keep_all_lines(spark, small):
    dense = sample_orders.raw_order_items(spark, small, 20)
    assert dense.count() == sample_orders.raw_order_items(spark, small).count()
    assert dense.select("restaurant_id").distinct().count() == 20


@pytest.mark.parametrize(
    "key", ["CAST(pow(id, 3) AS bigint)", "CAST(sqrt(id) * 10 AS decimal(20,2))", "date_add(DATE'2020-01-01', CAST(log2(id + 1) * 50 + id / 20 AS int))",
            "CAST('2020-01-01' AS timestamp) + make_dt_interval(0, 0, 0, id * id)"],
)
def test_balanced_predicates_cover_uneven_keys_once(spark, key):
    keys = spark.range(10_000).select(F.when(F.col("id") % 100 > 0, F.expr(key)).alias("k"))
    conditions = balanced_predicates(keys, "k", 20)
    assert len(conditions) == 21
    sizes = [keys.where(condition).count() for condition in conditions]
    assert sum(sizes) == 10_000 and max(sizes) < 2 * 10_000 / 20
    whole = keys.select(sum((F.coalesce(F.expr(c), F.lit(False)).cast("int") for c in conditions), F.lit(0)).alias("n"))
    assert whole.distinct().collect() == [(1,)]


def test_balanced_predicates_of_one_key_or_none(spark):
    one = spark.range(50).selectExpr("7 AS k")
    assert balanced_predicates(one, "k", 4) == ["k < 7", "k >= 7", "k IS NULL"]
    assert balanced_predicates(one.where("false"), "k", 4) == balanced_predicates(one, "k", 1) == ["k IS NOT NULL", "k IS NULL"]
