"""The daily run: bronze, silver and gold tables, each written once from the stored layer below, published together."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.amounts import MONEY_SUM, money
from ordermill.functions.order_time import strict_order_date
from ordermill.plans import bronze, gold, silver
from ordermill.plans.activity import restaurant_days
from ordermill.plans.summary import kpi_cards, kpi_summary
from ordermill.session import for_writes
from ordermill.sources import generations
from ordermill.sources.expectations import Expectation, ExpectationFailed, broken
from ordermill.sources.generations import MONTH, Manifest, name_of
from ordermill.sources.schemas import widened
from ordermill.sources.tables import read_parquet, register_views, stage, write_parquet

BRONZE = ("order_items", "order_item_options", "date_dim")
SILVER = ("order_items", "order_item_options", "order_facts", "order_option_facts", "restaurant_days", "category_months")
GOLD = ("order_metrics", "daily_clv", "category_revenue", "retention", "cohort", "kpi_summary")
TABLES = tuple(
    f"{layer}/{name}" for layer, names in (("bronze", BRONZE), ("silver", SILVER), ("gold", GOLD)) for name in names
)
#: Tables in folders by month of the order; orders without a date have a folder of their own. The rest are small and written anew by every run.
MONTHLY = (
    "bronze/order_items", "bronze/order_item_options", "silver/order_items", "silver/order_item_options", "silver/order_facts",
    "silver/order_option_facts", "silver/restaurant_days", "silver/category_months", "gold/order_metrics", "gold/daily_clv", "gold/retention",
)
#: Those of them that carry the order's date.
BY_MONTH = ("silver/order_items", "silver/order_facts", "gold/daily_clv")


def month_of(orderid: str = "orderid") -> Column:
    """The month that an order's rows are filed under. The id alone fixes it, so all of an order is in one month."""
    return F.date_format(strict_order_date(F.col(orderid)), "yyyy-MM")


def refresh(
    raw_items: DataFrame,
    raw_options: DataFrame,
    date_dim: DataFrame,
    root: str,
    keep: int = 2,
    expect: Mapping[str, Iterable[Expectation]] | None = None,
    names: str | None = None,
) -> dict[str, dict[str, int]]:
    """Write all tables as a new generation below `root` and publish it; returns each write's audit.

    Readers see the last published generation. A run that fails leaves it whole, and what it wrote stays unread
    until a later run removes it. The last `keep` generations are kept for readers who have them open.

    The source is read once, bronze lines once, silver lines twice; every order-grain gold table
    comes from the stored order facts, a fraction of the lines in size.

    `expect` has expectations by table. They are evaluated while the table is written; one that is not met ends the run before it is published
    (ExpectationFailed). With `names`, catalog views of that prefix show the new generation from then on.
    """
    return _run(raw_items, raw_options, date_dim, root, keep, expect, names, None, None)


def refresh_changed(
    raw_items: DataFrame,
    raw_options: DataFrame,
    date_dim: DataFrame,
    root: str,
    keep: int = 2,
    expect: Mapping[str, Iterable[Expectation]] | None = None,
    names: str | None = None,
) -> dict[str, dict[str, int]]:
    """`refresh` of the whole source that writes only months which differ from the last published generation; the others are carried forward.

    A month differs if its rows' fingerprint does: new, changed and vanished lines and options all count. The result equals a full refresh. The source is
    read twice, of the stored tables only small ones are. Without a published generation, everything is written. If nothing differs, nothing is published
    and the result is empty.
    """
    spark = raw_items.sparkSession
    if not generations.published(spark, root):
        return refresh(raw_items, raw_options, date_dim, root, keep, expect, names)
    marks = _marks(bronze.bronze_order_items(raw_items, trace=True), bronze.bronze_order_item_options(raw_options, trace=True))
    before = generations.latest(spark, root).marks
    changed = {
        month
        for source in marks
        for month in marks[source].keys() | before[source].keys()
        if marks[source].get(month) != before[source].get(month)
    }
    if not changed:
        return {}
    return _run(raw_items, raw_options, date_dim, root, keep, expect, names, changed, marks)


def refresh_increment(
    new_items: DataFrame,
    new_options: DataFrame,
    date_dim: DataFrame,
    root: str,
    batch: str,
    keep: int = 2,
    expect: Mapping[str, Iterable[Expectation]] | None = None,
    names: str | None = None,
) -> dict[str, dict[str, int]]:
    """Add lines and options that are not in the last published generation: their months are written anew from the stored rows and the new ones.

    `batch` names the increment, as a bookmark: one that a published generation already has is not added again, and the result is empty. The result equals a
    full refresh of all rows so far. Only the new rows and the stored bronze rows of their months are read, besides small tables.
    """
    spark = new_items.sparkSession
    base = generations.latest(spark, root)
    if batch in base.batches:
        return {}
    items = stage(bronze.bronze_order_items(new_items, trace=True), "new_items")  # read twice: the source, which may be slow, once
    options = stage(bronze.bronze_order_item_options(new_options, trace=True), "new_options")
    marks = _marks(items, options)
    changed = {month for source in marks for month in marks[source]}
    marks = {source: generations.added(base.marks[source], marks[source]) for source in marks}
    return _run(items, options, date_dim, root, keep, expect, names, changed, marks, batch, base)


def _marks(items: DataFrame, options: DataFrame, month: Column | None = None) -> dict[str, dict[str, list]]:
    month = month_of() if month is None else month
    return {"items": generations.fingerprints(items, month), "options": generations.fingerprints(options, month)}


def _in_months(df: DataFrame, months: set[str] | None, month: Column) -> DataFrame:
    return df if months is None else df.where(F.coalesce(month, F.lit(generations.NO_MONTH)).isin(*sorted(months)))


def _run(items, options, date_dim, root, keep, expect, names, changed, marks, batch=None, base=None) -> dict[str, dict[str, int]]:
    """One run. `changed`: the months to write, None for all. With a batch, `items` and `options` are bronze rows to add to the base generation."""
    with for_writes(items.sparkSession):
        return _write_all(items, options, date_dim, root, keep, expect, names, changed, marks, batch, base)


def _write_all(items, options, date_dim, root, keep, expect, names, changed, marks, batch, base) -> dict[str, dict[str, int]]:
    spark = items.sparkSession
    numbers = generations.published(spark, root)
    base = base or (generations.latest(spark, root) if numbers else Manifest(0, 0))
    number = generations.claim(spark, root)
    target = f"{root}/{name_of(number)}"
    carried = base if changed is not None else Manifest(0, 0)
    tables: dict[str, dict] = {}
    audits: dict[str, dict[str, int]] = {}
    manifest = Manifest(number, base.number, tables, {}, [*carried.batches, *([batch] if batch else [])])

    def write(table: str, df: DataFrame, by: tuple[str, ...] = ()) -> None:
        expected = tuple((expect or {}).get(table, ()))
        audits[table] = write_parquet(df, f"{target}/{table}", by, expect=expected)
        if failed := broken(audits[table], expected):
            raise ExpectationFailed(f"{table}: {'; '.join(failed)}")

    def store(table: str, df: DataFrame) -> DataFrame:
        """A small table, as a whole."""
        write(table, df)
        tables[table] = {"schema": df.schema.json(), "months": {"": number}}
        return read_parquet(spark, f"{target}/{table}")

    def store_months(table: str, df: DataFrame, month: Column, filed: bool = False) -> DataFrame:
        """The rows of the changed months, one folder each; the result is these rows. The other months stay where they are.

        `filed`: each row is one of a stored table and of its month, so a task that reads a few files has rows of a few months, and none need to move.
        """
        rows = df.select(*[c for c in df.columns if c != MONTH], month.alias(MONTH))
        if not filed:
            rows = rows.hint("rebalance", MONTH)  # large months stay several files
        known = carried.schema_of(table) if table in carried.tables else None
        schema = widened(known, rows.schema, table) if known else rows.schema
        write(table, rows, (MONTH,))
        months = {m: g for m, g in (carried.written_by(table) if table in carried.tables else {}).items() if m not in (changed or ())}
        tables[table] = {"schema": schema.json(), "months": months | {m: number for m in generations.months_in(spark, f"{target}/{table}")}}
        return generations.read_table(spark, root, manifest, table, changed)

    def whole(table: str) -> DataFrame:
        return generations.read_table(spark, root, manifest, table)

    def added(table: str, new: DataFrame) -> DataFrame:
        """The new rows with the stored ones of the changed months."""
        if batch is None:
            return _in_months(new, changed, month_of())
        old = generations.read_table(spark, root, base, table, changed).drop(MONTH)
        widened(old.schema, new.schema, table)  # refuses what the union would cast
        return old.unionByName(new, allowMissingColumns=True)

    if batch is None:
        items, options = bronze.bronze_order_items(items, trace=True), bronze.bronze_order_item_options(options, trace=True)
    items = store_months("bronze/order_items", added("bronze/order_items", items), month_of())
    options = store_months("bronze/order_item_options", added("bronze/order_item_options", options), month_of())
    store("bronze/date_dim", date_dim)
    if marks is None:
        marks = _marks(items, options, F.col(MONTH))  # stored rows have their month already
    manifest.marks.update(marks)
    items, options = items.drop(MONTH), options.drop(MONTH)

    dated = F.date_format("order_date", "yyyy-MM")
    lines = store_months("silver/order_items", silver.silver_order_items(items), dated, filed=True)
    store_months("silver/order_item_options", silver.silver_order_item_options(options), month_of(), filed=True)
    facts = store_months("silver/order_facts", silver.order_facts(lines), dated)
    store_months("silver/order_option_facts", silver.order_option_facts(options), month_of())
    days = store_months("silver/restaurant_days", restaurant_days(facts), dated)
    store_months("silver/category_months", category_months(lines), F.col(MONTH))

    store_months("gold/order_metrics", gold.order_metrics(facts), month_of())
    store_months("gold/daily_clv", gold.daily_clv(facts), dated)
    store("gold/category_revenue", category_revenue(whole("silver/category_months")))
    store_months("gold/retention", gold.retention(days), dated)
    all_days = whole("silver/restaurant_days")
    store("gold/cohort", gold.cohort(all_days))
    cards = kpi_cards(whole("silver/order_facts"), whole("silver/order_option_facts"), all_days, whole("gold/daily_clv"))
    cards = {name: stage(card, f"card_{name}") for name, card in cards.items()}  # one row each: a report's shuffle files go before the next report's come
    store("gold/kpi_summary", kpi_summary(cards))

    generations.publish(spark, root, manifest)
    if names:
        generations.point_names(spark, root, manifest, names)
    generations.clear(spark, root, keep)
    return {table: audits[table] for table in TABLES}


def category_months(lines: DataFrame) -> DataFrame:
    """Revenue and items of each category in each month, NULL and '' included: what the sums over all lines are made of."""
    return lines.groupBy(MONTH, "itemcategory").agg(
        F.sum(F.col("itemprice") * F.col("itemquantity")).cast(MONEY_SUM).alias("revenue"), F.sum("itemquantity").alias("items")
    )


def category_revenue(months: DataFrame) -> DataFrame:
    """`gold.category_revenue` from the stored months."""
    return months.groupBy("itemcategory").agg(money(F.sum("revenue")).alias("total_revenue"), F.sum("items").alias("total_items"))


def table_paths(spark: SparkSession, root: str) -> dict[str, str]:
    """The folders of the tables of the last published run, where each table is in one folder, as after a full refresh."""
    manifest = generations.latest(spark, root)
    paths = {}
    for table in manifest.tables:
        found = set(manifest.written_by(table).values()) or {manifest.number}
        if len(found) > 1:
            raise ValueError(f"{table} is in the folders of {len(found)} generations; open_tables and point_names read them together")
        paths[table] = f"{root}/{name_of(found.pop())}/{table}"
    return paths


def open_tables(spark: SparkSession, root: str, prefix: str | None = None) -> dict[str, DataFrame]:
    """The tables of the last published run, with `prefix` also as SQL views `<prefix>_<layer>_<name>`."""
    manifest = generations.latest(spark, root)
    tables = {table: generations.read_table(spark, root, manifest, table) for table in manifest.tables}
    if prefix:
        register_views(tables, prefix)
    return tables


def point_names(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """Catalog views `<prefix>_<layer>_<name>` over the last published run; `refresh(names=...)` does so with every run."""
    return generations.point_names(spark, root, generations.latest(spark, root), prefix)
