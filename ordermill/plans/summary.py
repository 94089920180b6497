"""All headline figures in one row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.plans.activity import restaurant_days
from ordermill.plans.churn import churn, churn_kpis
from ordermill.plans.clv import clv_kpis, clv_orders
from ordermill.plans.gold import daily_clv, retention
from ordermill.plans.location import location_figures, location_kpis
from ordermill.plans.loyalty import loyalty, loyalty_kpis
from ordermill.plans.pricing import pricing, pricing_kpis
from ordermill.plans.rfm import rfm, rfm_kpis
from ordermill.plans.sales import sales_kpis


def kpi_cards(
    order_facts: DataFrame,
    order_option_facts: DataFrame,
    days: DataFrame | None = None,
    daily: DataFrame | None = None,
    method: str = "exact",
) -> dict[str, DataFrame]:
    """The one-row figures of every report.

    Order values and pricing read the two order-grain tables. The reports per restaurant read `days` (restaurant days), sales reads `daily` (gold
    daily_clv); without such a stored table it is derived from the order facts.
    """
    days = restaurant_days(order_facts) if days is None else days
    return {
        "clv": clv_kpis(clv_orders(order_facts, order_option_facts, method)),
        "rfm": rfm_kpis(rfm(days, method, ordered=False)),
        "churn": churn_kpis(churn(retention(days), ordered=False)),
        "sales": sales_kpis(daily_clv(order_facts) if daily is None else daily),
        "loyalty": loyalty_kpis(loyalty(days, method, ordered=False)),
        "location": location_kpis(location_figures(days)),
        "pricing": pricing_kpis(pricing(order_facts, order_option_facts)),
    }


def kpi_summary(cards: Mapping[str, DataFrame]) -> DataFrame:
    """One row with each figure as `<report>_<figure>`. Each card is one row and read as one value."""
    spark = next(iter(cards.values())).sparkSession
    row = spark.range(1)
    for name, card in cards.items():
        row = row.withColumn(name, card.select(F.struct("*").alias("card")).scalar())
    return row.select(*[F.col(name)[c].alias(f"{name}_{c}") for name, card in cards.items() for c in card.columns])
