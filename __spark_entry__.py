"""

Every query starts from the given Parquet tables: `sample_orders` derives the raw order tables from
them, the bronze plan normalises these, and the report plans run on the result.
"""

from __future__ import annotations

import importlib.util
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_queries
from ordermill.functions.order_time import strict_order_date
from ordermill.operators import sketches
from ordermill.plans import activity, bronze, churn, clv, gold, location, loyalty, pricing, refresh, rfm, sales, silver, summary
from ordermill.session import configure, new_folder
from ordermill.sources import buckets, calendar, generations, jdbc, sample_orders, tables

Query = Callable[[SparkSession, str], DataFrame]

#: The operators on training text are an optional subpackage with queries of its own.
_found = importlib.util.find_spec("ordermill.llm")
HAS_LLM = _found is not None and _found.origin is not None
if HAS_LLM:
    import corpus_pipeline
    from ordermill.llm import registry


class _Inputs:
    """The lazily derived tables that the queries start from."""

    def __init__(self, spark: SparkSession, folder: str, restaurants: int | None = None) -> None:
        self.spark = configure(spark)
        self.raw_items = sample_orders.raw_order_items(spark, folder, restaurants)
        self.raw_options = sample_orders.raw_order_item_options(spark, folder)
        self.items = bronze.bronze_order_items(self.raw_items)
        self.options = bronze.bronze_order_item_options(self.raw_options)
        self.item_facts = silver.item_facts(self.items)
        self.option_facts = silver.option_facts(self.options)
        self.order_facts = silver.order_facts(self.items)
        self.date_dim = calendar.date_dim(spark, sample_orders.CALENDAR_FIRST, sample_orders.CALENDAR_LAST)

    def daily_clv(self) -> DataFrame:
        return gold.daily_clv(self.item_facts)

    def clv(self) -> DataFrame:
        return clv.clv_orders(self.item_facts, self.option_facts)

    def rfm(self, ordered: bool = False) -> DataFrame:
        return rfm.rfm(self.order_facts, ordered=ordered)

    def churn(self, ordered: bool = False) -> DataFrame:
        return churn.churn(gold.retention(self.order_facts), ordered=ordered)

    def loyalty(self, ordered: bool = False) -> DataFrame:
        return loyalty.loyalty(self.order_facts, ordered=ordered)

    def figures(self) -> DataFrame:
        return location.location_figures(self.order_facts)

    def pricing(self, line_join: bool = False) -> DataFrame:
        return pricing.pricing(self.item_facts, self.option_facts, line_join)

    def audit(self) -> DataFrame:
        return tables.audit_table(self.items, "order_items").unionByName(
            tables.audit_table(self.options, "order_item_options")
        )

    def spanning_calendar(self) -> DataFrame:
        return calendar.date_dim_spanning(self.items.select(strict_order_date(F.col("orderid")).alias("day")), "day")

    def summary(self) -> DataFrame:
        """Seven reports read these tables, so they are written once, not derived seven times."""
        facts = tables.stage(self.order_facts, "order_facts")
        option_facts = tables.stage(silver.order_option_facts(self.options), "order_option_facts")
        days = tables.stage(activity.restaurant_days(facts), "restaurant_days")
        daily = tables.stage(gold.daily_clv(facts), "daily_clv")
        return summary.kpi_summary(summary.kpi_cards(facts, option_facts, days, daily))

    def refreshed(self) -> tuple[str, dict[str, dict[str, int]]]:
        root = new_folder(self.spark, "refresh")
        return root, refresh.refresh(self.raw_items, self.raw_options, self.date_dim, root)

    def refresh_audit(self) -> DataFrame:
        """A full run; rows per written table, counted by the writes, next to the rows read back."""
        root, audits = self.refreshed()
        counts = None
        for table, df in refresh.open_tables(self.spark, root).items():
            row = df.agg(F.count(F.lit(1)).alias("rows_read")).select(
                F.lit(table).alias("table_name"),
                F.lit(audits[table]["rows"]).cast("bigint").alias("rows_written"),
                "rows_read",
            )
            counts = row if counts is None else counts.unionByName(row)
        return counts

    def _late(self, raw: DataFrame) -> DataFrame:
        """Lines that reach the source after the first load: the later lines of the orders of two months."""
        month, line = F.substring("order_id", 1, 7), F.col("lineitem_id")
        return raw.withColumn("_late", month.isin(*LATE_MONTHS) & (line >= 3) & strict_order_date(F.col("order_id")).isNotNull())

    def incremented(self, names: str | None = None) -> str:
        """A first load without the late lines, then these as an increment."""
        root = new_folder(self.spark, "increments")
        items, options = self._late(self.raw_items), self._late(self.raw_options)
        refresh.refresh(items.where("NOT coalesce(_late, false)").drop("_late"), options.where("NOT coalesce(_late, false)").drop("_late"), self.date_dim, root, names=names)
        refresh.refresh_increment(items.where("_late").drop("_late"), options.where("_late").drop("_late"), self.date_dim, root, "late", names=names)
        return root

    def refresh_incremental(self) -> DataFrame:
        """Orders and revenue per month after both runs, and which of them wrote the month."""
        root = self.incremented()
        months = refresh.open_tables(self.spark, root)["gold/daily_clv"].groupBy("order_month").agg(
            F.count(F.lit(1)).alias("orders"),
            F.count("orderid").alias("known_orders"),
            F.sum("order_revenue").cast("decimal(28,2)").alias("revenue"),
        )
        written = generations.history(self.spark, root).where("table_name = 'gold/daily_clv'").withColumnRenamed("order_month", "month")
        return months.join(written, F.col("order_month").eqNullSafe(F.col("month")), "left").select(
            *months.columns, F.col("generation").alias("written_by")
        )

    def bucketed(self) -> tuple[DataFrame, DataFrame]:
        """Order facts and option facts in buckets of the order id."""
        run, option_facts = uuid.uuid4().hex[:8], silver.order_option_facts(self.options)
        return (
            buckets.write_bucketed(self.order_facts, f"facts_{run}", "orderid", BUCKETS),
            buckets.write_bucketed(option_facts, f"options_{run}", "orderid", BUCKETS),
        )

    def monthly_sketches(self, values: DataFrame) -> DataFrame:
        return tables.stage(sketches.sketched(values.withColumn("order_month", refresh.month_of()), ["total_clv"], ["order_month"]), "sketches")

    def clv_from_sketches(self) -> DataFrame:
        """Segments with brackets from the stored sketches of the months instead of a pass over the orders."""
        facts = tables.stage(self.order_facts, "order_facts")
        option_facts = tables.stage(silver.order_option_facts(self.options), "order_option_facts")
        stored = self.monthly_sketches(clv.order_values(facts, option_facts))
        return clv.clv_orders(facts, option_facts, sketches=stored)

    def yearly_quantiles(self) -> DataFrame:
        """Per year whether quantiles from the months' merged sketches have a rank within one percent of theirs."""
        year = F.substring("order_month", 1, 4)
        values = tables.stage(clv.order_values(self.item_facts, self.option_facts), "values")
        merged = sketches.merged_sketches(self.monthly_sketches(values).withColumn("year", year), ["total_clv"], ["year"])
        found = merged.select("year", *[sketches.sketched_quantile("total_clv", p).alias(f"p{p[2:]}") for p in QUANTILES])
        rows = values.withColumn("order_month", refresh.month_of()).select(year.alias("of"), "total_clv")
        joined = rows.join(found, F.col("of").eqNullSafe(F.col("year"))).groupBy("year").agg(
            F.count("total_clv").alias("orders"),
            *[F.count_if(F.col("total_clv") < F.col(f"p{p[2:]}")).alias(f"below_{p[2:]}") for p in QUANTILES],
            *[F.count_if(F.col("total_clv") <= F.col(f"p{p[2:]}")).alias(f"to_{p[2:]}") for p in QUANTILES],
        )
        return joined.select(
            "year",
            "orders",
            *[
                ((F.col(f"below_{p[2:]}") <= F.col("orders") * (float(p) + 0.01)) & (F.col(f"to_{p[2:]}") >= F.col("orders") * (float(p) - 0.01))).alias(f"p{p[2:]}_close")
                for p in QUANTILES
            ],
        )

    def active_days(self) -> DataFrame:
        """From two loads of months, of which the second repeats part of the first."""
        months = tables.stage(activity.restaurant_months(activity.restaurant_days(self.order_facts)), "restaurant_months")
        return activity.active_days(months, months.where("month >= '1998-01'"))

    def december_weekends(self) -> DataFrame:
        folder = f"{new_folder(self.spark, 'daily')}/table"
        daily = self.daily_clv().withColumn("order_month", F.date_format("order_date", "yyyy-MM"))
        tables.write_parquet(daily.hint("rebalance", "order_month"), folder, ["order_month"])
        return sales.sales_on_days(tables.read_parquet(self.spark, folder), self.date_dim, "month_num = 12 AND is_weekend")

    def rescued(self) -> DataFrame:
        """Prices that the source has as `USD 12.50` on some lines, read again from the rescued texts; quantities `n/a` stay unread but kept."""
        price = F.when(F.col("lineitem_id") == 5, F.concat(F.lit("USD "), F.col("item_price").cast("string"))).otherwise(F.col("item_price").cast("string"))
        quantity = F.when(F.col("lineitem_id") == 6, "n/a").otherwise(F.col("item_quantity").cast("int").cast("string"))
        raw = self.raw_items.withColumns({"item_price": price, "item_quantity": quantity})
        stored = tables.stage(bronze.bronze_order_items(raw, trace=True, rescue=True), "rescued")
        items = bronze.repaired(stored, {"itemprice": lambda text: F.regexp_replace(text, "^USD ", "")})
        return items.select(
            "orderid", "lineitemid", "itemname", "itemprice", "itemquantity",
            F.try_variant_get(F.col(bronze.RESCUED), "$.itemquantity", "string").alias("source_quantity"),
            F.array_join(bronze.UNREADABLE, ",").alias("unreadable"),
        )

    def split_cover(self) -> DataFrame:
        """How many conditions of a balanced split each line meets, and whether no part is twice the mean or more."""
        keys = self.items.select("lineitemid", F.to_date("creationtimeutc").alias("day"))
        conditions = jdbc.balanced_predicates(keys, "day", SPLITS)
        met = [F.coalesce(F.expr(condition), F.lit(False)) for condition in conditions]
        counted = keys.agg(F.count(F.lit(1)).alias("lines"), F.sum(sum((m.cast("bigint") for m in met), F.lit(0))).alias("met"), F.array(*[F.count_if(m) for m in met]).alias("parts"))
        return counted.select("lines", "met", (F.array_max("parts") * SPLITS < 2 * F.col("lines")).alias("balanced"))

    def summary_by_name(self) -> DataFrame:
        """The summary as a dashboard reads it: by its name in the catalog, after two runs."""
        prefix = f"run{uuid.uuid4().hex[:8]}"
        self.incremented(prefix)
        return tables.read_view(self.spark, f"{prefix}_gold_kpi_summary")

    def location_from_tables(self) -> DataFrame:
        """The location report from its two written tables through SQL views, cohort month by join."""
        facts = tables.stage(self.order_facts, "order_facts")
        prefix = f"run{uuid.uuid4().hex[:8]}"
        tables.register_views(
            {"silver/order_facts": facts, "gold/cohort": tables.stage(gold.cohort(facts), "cohort")}, prefix
        )
        return location.location(
            tables.read_view(self.spark, f"{prefix}_silver_order_facts"),
            tables.read_view(self.spark, f"{prefix}_gold_cohort"),
        )

    def round_trip(self) -> DataFrame:
        return tables.stage(self.items, "order_items")


def _queries() -> dict[str, Callable[[_Inputs], DataFrame]]:
    return {
        # Bronze, calendar, audit, silver
        "bronze_order_items": lambda i: i.items,
        "bronze_order_item_options": lambda i: i.options,
        "date_dim": lambda i: i.spanning_calendar(),
        "source_audit": lambda i: i.audit(),
        "silver_order_items": lambda i: silver.silver_order_items(i.items),
        "silver_order_item_options": lambda i: silver.silver_order_item_options(
            bronze.bronze_order_item_options(i.raw_options, trace=True)
        ),
        # Gold
        "gold_order_metrics": lambda i: gold.order_metrics(i.item_facts),
        "gold_daily_clv": lambda i: i.daily_clv(),
        "gold_category_revenue": lambda i: gold.category_revenue(i.items),
        "gold_retention": lambda i: gold.retention(i.order_facts),
        "gold_cohort": lambda i: gold.cohort(silver.silver_order_items(i.items)),
        # Value per order
        "clv_orders": lambda i: i.clv(),
        "clv_kpis": lambda i: clv.clv_kpis(i.clv()),
        "clv_segments": lambda i: clv.clv_segments(i.clv()),
        "clv_top20": lambda i: clv.clv_top(i.clv()),
        # Recency, frequency, monetary
        "rfm": lambda i: i.rfm(ordered=True),
        "rfm_kpis": lambda i: rfm.rfm_kpis(i.rfm()),
        "rfm_segments": lambda i: rfm.rfm_segments(i.rfm()),
        "rfm_top20": lambda i: rfm.rfm_top(i.rfm()),
        "rfm_avg_monetary": lambda i: rfm.rfm_avg_monetary(i.rfm()),
        # Churn
        "churn": lambda i: i.churn(ordered=True),
        "churn_kpis": lambda i: churn.churn_kpis(i.churn()),
        "churn_status": lambda i: churn.churn_status(i.churn()),
        "churn_at_risk": lambda i: churn.churn_at_risk(i.churn(ordered=True)),
        "churn_histogram": lambda i: churn.churn_histogram(i.churn()),
        # Sales
        "sales_daily": lambda i: sales.sales_daily(i.daily_clv(), i.date_dim),
        "sales_monthly": lambda i: sales.sales_monthly(i.daily_clv(), i.date_dim),
        "sales_monthly_series": lambda i: sales.sales_monthly_series(sales.sales_monthly(i.daily_clv(), i.date_dim)),
        "sales_category": lambda i: sales.sales_category(gold.category_revenue(i.items)),
        "sales_weekend": lambda i: sales.sales_weekend(i.daily_clv(), i.date_dim),
        "sales_kpis": lambda i: sales.sales_kpis(i.daily_clv()),
        "sales_series": lambda i: sales.sales_series(i.daily_clv()),
        "sales_by_day": lambda i: sales.sales_by_day(i.daily_clv()),
        # Loyalty
        "loyalty": lambda i: i.loyalty(ordered=True),
        "loyalty_kpis": lambda i: loyalty.loyalty_kpis(i.loyalty()),
        "loyalty_segments": lambda i: loyalty.loyalty_segments(i.loyalty()),
        "loyalty_top20": lambda i: loyalty.loyalty_top(i.loyalty()),
        "loyalty_category_preference": lambda i: loyalty.loyalty_category_preference(i.items, i.loyalty()),
        # Location
        "location": lambda i: location.location(i.order_facts),
        "location_from_tables": lambda i: i.location_from_tables(),
        "location_kpis": lambda i: location.location_kpis(i.figures()),
        "location_top20": lambda i: location.location_top(i.figures()),
        "location_series": lambda i: location.location_series(i.figures()),
        # Pricing
        "pricing": lambda i: i.pricing(),
        "pricing_line_join": lambda i: i.pricing(line_join=True),
        "pricing_kpis": lambda i: pricing.pricing_kpis(i.pricing()),
        "pricing_by_type": lambda i: pricing.pricing_by_type(i.pricing()),
        "category_pricing": lambda i: pricing.category_pricing(i.items),
        "category_price_series": lambda i: pricing.category_price_series(pricing.category_pricing(i.items)),
        # Everything together
        "kpi_summary": lambda i: i.summary(),
        "refresh_audit": lambda i: i.refresh_audit(),
        "clv_orders_bucketed": lambda i: clv.clv_orders(*i.bucketed(), co_located=True),
        "pricing_bucketed": lambda i: pricing.pricing(*i.bucketed(), co_located=True),
        "clv_orders_sketched": lambda i: i.clv_from_sketches(),
        "value_quantiles_by_year": lambda i: i.yearly_quantiles(),
        "active_days": lambda i: i.active_days(),
        "sales_december_weekends": lambda i: i.december_weekends(),
        "bronze_rescued": lambda i: i.rescued(),
        "source_split_cover": lambda i: i.split_cover(),
        "refresh_incremental": lambda i: i.refresh_incremental(),
        "kpi_summary_by_name": lambda i: i.summary_by_name(),
        "parquet_roundtrip": lambda i: i.round_trip(),
    }


#: The same reports with all orders at twenty restaurants: many orders a day, and thousands for each of them.
_DENSE = {
    "loyalty_dense": lambda i: i.loyalty(ordered=True),
    "location_dense": lambda i: location.location(i.order_facts),
}
DENSE_RESTAURANTS = 20
LATE_MONTHS = ("1997-03", "1998-11")
BUCKETS = 8
SPLITS = 16
QUANTILES = ("0.20", "0.80")


def entry(spark: SparkSession) -> DataFrame:
    """Value and segment of every order."""
    return queries()["clv_orders"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    def bind(build: Callable[[_Inputs], DataFrame], restaurants: int | None = None) -> Query:
        return lambda spark, folder: build(_Inputs(spark, folder, restaurants))

    found = {name: bind(build) for name, build in _queries().items()}
    found |= {name: bind(build, DENSE_RESTAURANTS) for name, build in _DENSE.items()}
    return found | registry.queries() | {"pipeline": corpus_pipeline.run} if HAS_LLM else found


def oracle_sql() -> dict[str, str]:
    found = oracle_queries.all_queries()
    return found | registry.oracle_sql() if HAS_LLM else found
