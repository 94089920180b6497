from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordermill.plans import gold, refresh
from ordermill.sources import generations, sample_orders
from ordermill.sources.calendar import date_dim
from ordermill.sources.expectations import Expectation, ExpectationFailed
from ordermill.sources.generations import ConcurrentRun
from ordermill.sources.schemas import SchemaNarrowed, widened

MONTHS = ("1997-03", "1997-04", "1998-11", "1999-01")


@pytest.fixture(scope="module")
def source(spark, small, tmp_path_factory):
    """Raw lines and options of four months and of orders without a date, stored."""
    folder = str(tmp_path_factory.mktemp("source"))
    month = F.substring("order_id", 1, 7)
    for name, df in (("items", sample_orders.raw_order_items(spark, small)), ("options", sample_orders.raw_order_item_options(spark, small))):
        df.where(month.isin(*MONTHS) | F.col("order_id").isNull()).coalesce(1).write.parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/items"), spark.read.parquet(f"{folder}/options")


@pytest.fixture(scope="module")
def dates(spark):
    return date_dim(spark, sample_orders.CALENDAR_FIRST, sample_orders.CALENDAR_LAST)


def contents(spark, root):
    """Every table of the last generation as sorted rows, columns by name."""
    out = {}
    for table, df in refresh.open_tables(spark, root).items():
        out[table] = sorted(map(repr, df.select(*sorted(df.columns)).collect()))
    return out


def files(tmp, generation):
    folder = tmp / f"generation-{generation:08d}"
    return {str(path.relative_to(folder).parent) for path in folder.rglob("part-*.parquet")}


def test_an_increment_equals_a_full_run_and_writes_its_months_only(spark, source, dates, tmp_path):
    items, options = source
    late = F.substring("order_id", 1, 7).isin("1997-03", "1998-11") & (F.col("lineitem_id") >= 2)
    late = F.coalesce(late, F.lit(False))
    root = str(tmp_path / "lake")
    refresh.refresh(items.where(~late), options.where(~late), dates, root)
    untouched = files(tmp_path / "lake", 1)
    audits = refresh.refresh_increment(items.where(late), options.where(late), dates, root, "second")
    assert tuple(audits) == refresh.TABLES
    full = str(tmp_path / "full")
    refresh.refresh(items, options, dates, full)
    assert contents(spark, root) == contents(spark, full)
    months = {folder.split("order_month=")[1] for folder in files(tmp_path / "lake", 2) if "order_month=" in folder}
    assert months == {"1997-03", "1998-11"}
    assert files(tmp_path / "lake", 1) == untouched
    manifest = generations.latest(spark, root)
    assert manifest.written_by("silver/order_facts") == {"1997-03": 2, "1998-11": 2, "1997-04": 1, "1999-01": 1, generations.NO_MONTH: 1}
    with pytest.raises(ValueError, match="generations"):
        refresh.table_paths(spark, root)
    assert refresh.refresh_increment(items.where(late), options.where(late), dates, root, "second") == {}
    assert generations.latest(spark, root).number == 2
    # The whole source differs from what is stored in no month.
    assert refresh.refresh_changed(items, options, dates, root) == {}
    # Old months that nothing needs any more go, the carried ones stay.
    changed = items.where("order_id is not null AND NOT (order_id LIKE '1997-04%' AND lineitem_id = 1)").withColumn(
        "item_quantity", F.when(F.col("order_id").startswith("1998-11"), 9.0).otherwise(F.col("item_quantity"))
    )
    refresh.refresh_changed(changed, options, dates, root, keep=1)
    again = str(tmp_path / "again")
    refresh.refresh(changed, options, dates, again)
    assert contents(spark, root) == contents(spark, again)
    assert generations.latest(spark, root).written_by("gold/daily_clv") == {"1997-03": 2, "1997-04": 3, "1998-11": 3, "1999-01": 1}
    left = {folder for folder in files(tmp_path / "lake", 1)}
    assert left and all("1999-01" in folder or generations.NO_MONTH in folder for folder in left)


def test_names_show_the_last_run_for_three_runs(spark, source, dates, tmp_path):
    items, options = source
    root = str(tmp_path / "lake")
    seen = []
    for run in range(3):
        part = items.where(F.col("lineitem_id") <= run + 1)
        refresh.refresh(part, options, dates, root, keep=1, names="standing")
        other = spark.newSession()
        assert other.table("standing_bronze_order_items").count() == part.count()
        assert other.table("standing_gold_kpi_summary").count() == 1
        seen.append(other.table("standing_silver_order_facts").where("order_month = '1997-03'").agg(F.sum("lines")).first()[0])
    assert seen == sorted(set(seen))
    assert refresh.point_names(spark, root, "standing") == [f"standing_{table.replace('/', '_')}" for table in generations.latest(spark, root).tables]


def test_two_runs_at_once_have_folders_of_their_own_and_one_publishes(spark, source, dates, tmp_path, monkeypatch):
    items, options = source
    root = str(tmp_path / "lake")
    small = items.where("order_id LIKE '1997-03%'")
    refresh.refresh(small, options.limit(0), dates, root)
    metrics = gold.order_metrics
    inner = []

    def with_another_run(facts):
        if not inner:
            inner.append(1)
            refresh.refresh(small.limit(5), options.limit(0), dates, root)
        return metrics(facts)

    monkeypatch.setattr(gold, "order_metrics", with_another_run)
    with pytest.raises(ConcurrentRun):
        refresh.refresh_increment(items.where("order_id LIKE '1998-11%'"), options.limit(0), dates, root, "lost")
    assert generations.published(spark, root) == [1, 3]
    assert refresh.open_tables(spark, root)["bronze/order_items"].count() == 5
    assert generations.claim(spark, root) == 4 and generations.claim(spark, root) == 5


def test_of_two_publications_after_one_base_the_second_fails(spark, tmp_path):
    root = str(tmp_path)
    first, second = generations.claim(spark, root), generations.claim(spark, root)
    generations.publish(spark, root, generations.Manifest(second, 0))
    with pytest.raises(ConcurrentRun):
        generations.publish(spark, root, generations.Manifest(first, 0))
    assert generations.published(spark, root) == [second]


def test_an_unmet_expectation_leaves_the_last_generation(spark, source, dates, tmp_path):
    items, options = source
    part, none = items.where("order_id LIKE '1997-03%'"), options.limit(0)
    root = str(tmp_path / "lake")
    fine = {"silver/order_items": [Expectation("has_id", "orderid IS NOT NULL"), Expectation("some", least_rows=1)]}
    audits = refresh.refresh(part, none, dates, root, expect=fine)
    assert audits["silver/order_items"]["fails_has_id"] == 0
    for expected, message in (
        (Expectation("quantity", "itemquantity > 10", share=0.01), r"quantity: \d+ of \d+ rows fail itemquantity > 10"),
        (Expectation("many", least_rows=10**6), "at least 1000000 are expected"),
    ):
        with pytest.raises(ExpectationFailed, match=message):
            refresh.refresh(items, options, dates, root, expect={"silver/order_items": [expected]})
        assert generations.latest(spark, root).number == 1


def test_columns_may_come_and_widen_between_generations(spark, source, dates, tmp_path):
    items, options = source
    root = str(tmp_path / "lake")
    first, second = options.where("order_id LIKE '1997-03%'"), options.where("order_id LIKE '1997-04%'")
    refresh.refresh(items.where("order_id LIKE '1997-03%'"), first.withColumn("grams", F.lit(7)), dates, root)
    more = items.where("order_id LIKE '1997-04%'")
    refresh.refresh_increment(more, second.selectExpr("*", "8000000000L AS grams", "'x' AS colour"), dates, root, "wider")
    table = refresh.open_tables(spark, root)["bronze/order_item_options"]
    got = {(row.order_month, row.grams, row.colour) for row in table.collect()}
    assert got == {("1997-03", 7, None), ("1997-04", 8_000_000_000, "x")}
    with pytest.raises(SchemaNarrowed, match="grams"):
        refresh.refresh_increment(more.limit(1), second.limit(1).selectExpr("*", "'few' AS grams"), dates, root, "narrower")
    assert generations.latest(spark, root).number == 2


def test_widening():
    old = StructType.fromDDL("a int, b decimal(10,2), c string")
    assert widened(old, StructType.fromDDL("A bigint, b decimal(12,2), d date")).simpleString() == "struct<a:bigint,b:decimal(12,2),c:string,d:date>"
    for other in ("a string", "b decimal(10,4)", "b decimal(9,2)", "c int", "a smallint"):
        with pytest.raises(SchemaNarrowed):
            widened(old, StructType.fromDDL(other))


def test_fingerprints_are_exact_sums_and_leave_the_month_folder_out(spark):
    df = spark.range(500).select(F.col("id").alias("orderid"), F.lit("1997-03").alias(generations.MONTH))
    hashes = [r[0] for r in df.select(F.xxhash64("orderid")).collect()]
    found = generations.fingerprints(df, F.col(generations.MONTH))
    assert min(hashes) < 0 < max(hashes)
    assert found["1997-03"][:2] == [500, str(sum(hashes))]
