from __future__ import annotations

import time

import pytest

from ordermill.plans import gold, refresh
from ordermill.sources import sample_orders, tables
from ordermill.sources.calendar import date_dim


@pytest.fixture(scope="module")
def run(spark, small, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    audits = refresh.refresh(
        sample_orders.raw_order_items(spark, small),
        sample_orders.raw_order_item_options(spark, small),
        date_dim(spark, sample_orders.CALENDAR_FIRST, sample_orders.CALENDAR_LAST),
        root,
    )
    return root, audits


def test_every_table_is_written_and_counted(spark, run):
    root, audits = run
    assert tuple(audits) == refresh.TABLES
    for table, df in refresh.open_tables(spark, root).items():
        assert df.count() == audits[table]["rows"] > 0


def test_audits_show_the_null_ids(run):
    _, audits = run
    assert audits["bronze/order_items"]["nulls_orderid"] > 0
    assert audits["bronze/order_items"]["nulls_userid"] == audits["bronze/order_items"]["rows"]
    assert audits["gold/order_metrics"]["nulls_orderid"] == 1


def test_tables_answer_sql(spark, run):
    refresh.open_tables(spark, run[0], "shop")
    summary = tables.read_view(spark, "shop_gold_kpi_summary")
    assert summary.count() == 1
    total = spark.sql("SELECT sum(order_revenue) FROM shop_gold_daily_clv d JOIN shop_bronze_date_dim ON date_key = order_date")
    everything = summary.first()["sales_total_revenue"]
    assert 0 < total.first()[0] < everything
    ranks = spark.sql("SELECT count(*) FROM shop_gold_cohort c JOIN shop_gold_retention USING (restaurantid)")
    assert ranks.first()[0] == tables.read_view(spark, "shop_gold_retention").count()


def inputs(spark, small):
    return (
        sample_orders.raw_order_items(spark, small).limit(500),
        sample_orders.raw_order_item_options(spark, small),
        date_dim(spark, sample_orders.CALENDAR_FIRST, sample_orders.CALENDAR_LAST),
    )


def test_a_failed_run_leaves_the_last_one(spark, small, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    with pytest.raises(FileNotFoundError):
        refresh.open_tables(spark, root)
    refresh.refresh(*inputs(spark, small), root)
    before = refresh.table_paths(spark, root)
    rows = {name: df.count() for name, df in refresh.open_tables(spark, root).items()}

    def failing(facts):
        raise RuntimeError("half-way")

    with monkeypatch.context() as patch:
        patch.setattr(gold, "order_metrics", failing)
        with pytest.raises(RuntimeError, match="half-way"):
            refresh.refresh(*inputs(spark, small), root)
    assert refresh.table_paths(spark, root) == before
    assert {name: df.count() for name, df in refresh.open_tables(spark, root).items()} == rows
    for _ in range(2):
        refresh.refresh(*inputs(spark, small), root, keep=1)
    left = sorted(path.name for path in (tmp_path / "lake").iterdir() if not path.name.startswith("."))
    assert left == ["generation-00000004"]


def test_a_month_reads_its_folder_only(spark, run):
    root, _ = run
    for table in refresh.BY_MONTH:
        df = refresh.open_tables(spark, root)[table]
        month = df.where("order_month is not null").first()["order_month"]
        picked = df.where(df.order_month == month)
        plan = picked._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(order_month" in plan
        assert 0 < picked.count() < df.count()
        assert df.where("order_month is null").count() == df.where("order_date is null").count() > 0


def test_external_tables_are_read_by_another_session(spark, run):
    root, audits = run
    names = tables.register_external(spark, refresh.table_paths(spark, root), "lasting")
    assert len(names) == len(refresh.TABLES)
    other = spark.newSession()
    assert not other.catalog.listTables("default") == []
    assert other.table("lasting_gold_cohort").count() == audits["gold/cohort"]["rows"]
    tables.register_external(spark, {"gold/cohort": refresh.table_paths(spark, root)["gold/cohort"]}, "lasting")
    assert other.table("lasting_gold_cohort").count() == audits["gold/cohort"]["rows"]
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    assert refresh.open_tables(spark, root)["gold/cohort"].count() == audits["gold/cohort"]["rows"]


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for at in range(files.size()) if (name := files.apply(at).getName()).startswith("shuffle_")}


def test_shuffle_files_go_with_each_write_and_stored_lines_are_not_moved(spark, small, tmp_path, monkeypatch):
    before, left, plans = shuffle_files(spark), {}, {}
    write = refresh.write_parquet

    def watched(df, path, *args, **kwargs):
        table = "/".join(path.split("/")[-2:])
        plans[table] = df._jdf.queryExecution().optimizedPlan().toString()
        audit = write(df, path, *args, **kwargs)
        until = time.time() + 0.5
        while (found := shuffle_files(spark) - before) and time.time() < until:
            time.sleep(0.1)
        left[table] = len(found)
        return audit

    monkeypatch.setattr(refresh, "write_parquet", watched)
    keys = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.maxConcurrentOutputFileWriters")
    settings = [spark.conf.get(key, None) for key in keys]
    refresh.refresh(*inputs(spark, small), str(tmp_path / "lake"))
    assert left == dict.fromkeys(refresh.TABLES, 0)
    moved = {table for table, plan in plans.items() if "RebalancePartitions" in plan}
    assert moved == set(refresh.MONTHLY) - {"silver/order_items", "silver/order_item_options"}
    assert "Aggregate" not in plans["gold/kpi_summary"]
    assert [spark.conf.get(key, None) for key in keys] == settings
