"""Hand-written cases for the meanings that are easy to get wrong."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from orders import at, dec, items, options

from ordermill.plans import churn, clv, gold, location, loyalty, pricing, rfm, sales, silver, summary
from ordermill.sources.calendar import date_dim


def facts(df):
    return silver.order_facts(df)


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


# Silver and gold


def test_silver_flags_bad_rows_and_keeps_them(spark):
    df = items(spark, [("r", "garbage", "1.00", 1), ("r", "2001-01-02T10:00:00Z", None, 1), ("r", None, "1.00", 2)])
    got = rows(silver.silver_order_items(df), "orderid", "order_ts", "order_date", "line_revenue", "has_order_time", "has_amount")
    assert got == [
        ("2001-01-02T10:00:00Z", datetime(2001, 1, 2, 10), None, None, True, False),
        ("garbage", None, None, dec("1.00"), False, True),
        (None, None, None, dec("2.00"), False, True),
    ]


def test_gold_keeps_null_groups(spark):
    day = at("2001-01-02")
    df = items(
        spark,
        [("r", day, None, "1.10", 2), ("r", None, "", "2.00", 1), (None, None, "food", "3.00", 1), ("r", "bad", "food", None, 4)],
    )
    lines = silver.item_facts(df)
    assert rows(gold.order_metrics(lines)) == [("2001-01-02T12:00:00.000Z", dec("2.20"), 2), ("bad", None, 4), (None, dec("5.00"), 2)]
    assert rows(gold.daily_clv(lines)) == [(day, date(2001, 1, 2), dec("2.20")), ("bad", None, None), (None, None, dec("5.00"))]
    assert rows(gold.category_revenue(df)) == [("", dec("2.00"), 1), ("food", dec("3.00"), 5), (None, dec("2.20"), 2)]
    assert rows(gold.retention(facts(df))) == [("r", None, 1), ("r", date(2001, 1, 2), 1), (None, None, 0)]
    assert rows(gold.cohort(facts(df))) == [("r", "2001-01"), (None, None)]


def test_gold_is_the_same_from_lines_and_from_order_facts(spark):
    df = items(spark, [("r1", at("2001-01-02"), "1.10", 2), ("r2", at("2001-01-02"), "2.00", 1), ("r1", None, "3.00", 1)])
    assert rows(gold.order_metrics(silver.item_facts(df))) == rows(gold.order_metrics(facts(df)))
    assert rows(gold.cohort(silver.silver_order_items(df))) == rows(gold.cohort(facts(df)))


def test_a_price_that_overflows_a_long_in_cents(spark):
    df = items(spark, [("r", "o", "99999999.99", 2147483647)])
    assert gold.order_metrics(silver.item_facts(df)).first()["order_revenue"] == Decimal("99999999.99") * 2147483647


# Value per order


def values(spark, item_rows, option_rows=(), **settings):
    given = options(spark, list(option_rows)) if option_rows else options(spark, [("none", None, None)])
    return clv.clv_orders(silver.item_facts(items(spark, item_rows)), silver.option_facts(given), **settings)


def test_clv_adds_options_without_fanning_out(spark):
    got = values(
        spark,
        [("r", "a", "10.00", 1), ("r", "a", "5.00", 2), ("r", "b", "1.00", 1), ("r", None, "9.00", 1)],
        [("a", "-2.50", 1), ("a", "1.00", 3), ("a", None, 3), ("only-options", "7.00", 1), (None, "7.00", 1)],
    )
    assert rows(got, "orderid", "total_clv") == [("a", dec("20.50")), ("b", dec("1.00"))]


def test_clv_without_a_value_is_medium_and_has_no_date(spark):
    got = values(spark, [("r", "x", None, 1), ("r", at("2001-01-02"), "5.00", 1)], [("x", "3.00", 1)])
    assert rows(got) == [
        ("2001-01-02T12:00:00.000Z", "2001-01-02", dec("5.00"), "High"),
        ("x", None, None, "Medium"),
    ]


def test_equal_thresholds_take_the_first_branch(spark):
    got = values(spark, [("r", f"o{i}", "5.00", 1) for i in range(10)])
    assert rows(clv.clv_segments(got)) == [("High", 10), ("Low", None), ("Medium", None)]
    assert rows(clv.clv_kpis(got)) == [(10, dec("5.00"), dec("5.00"), 10)]


def test_clv_segments_and_order(spark):
    got = values(spark, [("r", f"o{i}", f"{i}.00", 1) for i in range(1, 11)], ordered=True)
    assert [(r["orderid"], r["clv_segment"]) for r in got.collect()] == (
        [(f"o{i}", "High") for i in (10, 9, 8)] + [(f"o{i}", "Medium") for i in (7, 6, 5, 4, 3)] + [(f"o{i}", "Low") for i in (2, 1)]
    )


def test_clv_of_no_orders(spark):
    got = values(spark, [("r", None, "1.00", 1)])
    assert got.count() == 0
    assert rows(clv.clv_kpis(got)) == [(0, None, None, 0)]


def test_top_orders_break_ties_by_id(spark):
    got = clv.clv_top(values(spark, [("r", f"o{i:02d}", "5.00", 1) for i in range(30)]))
    assert [r["orderid"] for r in got.collect()] == [f"o{i:02d}" for i in range(20)]


# Recency, frequency, monetary


def test_rfm_measures_elapsed_days_to_the_latest_order_of_all(spark):
    df = items(
        spark,
        [
            ("r1", at("2001-01-01", "23:00:00.000"), "1.00", 1),
            ("r1", "2000-12-31T00:00:00Z", "2.00", 1),
            ("r1", "garbage", "4.00", 1),
            (None, at("2001-01-03", "01:00:00.000"), "1.00", 1),
        ],
    )
    assert rows(rfm.rfm(facts(df)), "restaurantid", "recency_days", "frequency", "monetary") == [("r1", 1, 3, dec("7.00"))]


def test_same_millisecond_orders_of_two_restaurants_stay_apart_per_restaurant(spark):
    same = at("2001-01-02")
    df = items(spark, [("r1", same, "1.00", 1), ("r2", same, "2.00", 1)])
    assert rows(rfm.rfm(facts(df)), "restaurantid", "frequency", "monetary") == [("r1", 1, dec("1.00")), ("r2", 1, dec("2.00"))]
    assert rows(gold.order_metrics(facts(df))) == [(same, dec("3.00"), 2)]


def test_rfm_segments(spark):
    orders = []
    plan = {"vip": (1, 9, "9.00"), "new": (1, 1, "1.00"), "risk": (28, 1, "1.00"), "mid": (14, 5, "5.00"), "mid2": (15, 5, "5.00"), "mid3": (13, 4, "4.00")}
    for name, (days_ago, count, price) in plan.items():
        for i in range(count):
            orders.append((name, at(f"2001-01-{29 - days_ago:02d}", f"12:{ord(name[0]) % 60:02d}:{i:02d}.000"), price, 1))
    got = dict(rows(rfm.rfm(facts(items(spark, orders))), "restaurantid", "rfm_segment"))
    assert (got["vip"], got["new"], got["risk"], got["mid"]) == ("VIP", "New Customer", "Churn Risk", "Active")


def test_rfm_average_is_half_up(spark):
    df = items(spark, [("a", at("2001-01-01"), "1.00", 1), ("b", at("2001-01-01"), "1.01", 1)])
    assert rfm.rfm_kpis(rfm.rfm(facts(df))).first()["avg_monetary"] == dec("1.01")


# Churn


def test_churn(spark):
    df = items(
        spark,
        [("busy", at(f"2001-01-{d:02d}"), "1.00", 1) for d in (1, 2, 5)]
        + [("latest", at("2001-03-01"), "1.00", 1), ("undated", "2001-01-01T00:00:00Z", "1.00", 1)]
        + [("watch", at("2001-02-08"), "1.00", 1), ("edge20", at("2001-02-09"), "1.00", 1), ("edge45", at("2001-01-15"), "1.00", 1)]
        + [(None, at("2001-02-27"), "1.00", 1)],
    )
    report = churn.churn(gold.retention(facts(df)))
    assert rows(report) == sorted(
        [
            ("busy", "2001-01-05", 55, 3, Decimal("2.0"), "At Risk"),
            ("edge20", "2001-02-09", 20, 1, None, "Active"),
            ("edge45", "2001-01-15", 45, 1, None, "Watch"),
            ("latest", "2001-03-01", 0, 1, None, "Active"),
            ("undated", None, None, 1, None, "Active"),
            ("watch", "2001-02-08", 21, 1, None, "Watch"),
            (None, "2001-02-27", 2, 1, None, "Active"),
        ],
        key=repr,
    )
    assert report.first()["restaurantid"] == "busy"
    assert rows(churn.churn_status(report)) == [("Active", 4), ("At Risk", 1), ("Watch", 2)]
    assert rows(churn.churn_kpis(report)) == [(7, 1, 2, 24)]
    assert rows(churn.churn_at_risk(report)) == [("busy", "2001-01-05", 55, Decimal("2.0"))]
    assert [tuple(r) for r in churn.churn_histogram(report).collect()] == [(d, 1) for d in (0, 2, 20, 21, 45, 55)]


def test_churn_counts_calendar_days(spark):
    df = items(spark, [("a", at("2001-01-01", "23:00:00.000"), "1.00", 1), ("b", at("2001-01-03", "01:00:00.000"), "1.00", 1)])
    got = dict(rows(churn.churn(gold.retention(facts(df))), "restaurantid", "days_since_last_order"))
    assert got == {"a": 2, "b": 0}


def test_churn_gap_rounds_half_up(spark):
    days = ("2001-01-01", "2001-01-02", "2001-01-03", "2001-01-04", "2001-01-10")  # 9 days over 4 gaps
    report = churn.churn(gold.retention(facts(items(spark, [("a", at(d), "1.00", 1) for d in days]))))
    assert report.first()["avg_order_gap_days"] == Decimal("2.3")


# Sales


@pytest.fixture
def sold(spark):
    return gold.daily_clv(
        silver.item_facts(
            items(
                spark,
                [
                    ("r", at("2001-01-06", "10:00:00.000"), "1.00", 1),
                    ("r", at("2001-01-06", "11:00:00.000"), "2.00", 1),
                    ("r", at("2001-01-08"), "4.00", 1),
                    ("r", at("1999-12-31"), "8.00", 1),
                    ("r", "bad", "16.00", 1),
                ],
            )
        )
    )


def test_sales_by_calendar(spark, sold):
    days = date_dim(spark, date(2001, 1, 1), date(2001, 12, 31))
    daily = [tuple(r) for r in sales.sales_daily(sold, days, ordered=True).collect()]
    assert [(d[0], d[1], d[2], d[5]) for d in daily] == [
        (date(1999, 12, 31), dec("8.00"), None, None),
        (date(2001, 1, 6), dec("1.00"), "Saturday", True),
        (date(2001, 1, 6), dec("2.00"), "Saturday", True),
        (date(2001, 1, 8), dec("4.00"), "Monday", False),
        (None, dec("16.00"), None, None),
    ]
    monthly = sales.sales_monthly(sold, days)
    assert rows(monthly) == [("January", 1, 2001, dec("7.00"))]
    assert rows(sales.sales_monthly_series(monthly)) == [("January 2001", dec("7.00"))]
    assert rows(sales.sales_weekend(sold, days)) == [("Weekday", dec("4.00")), ("Weekend", dec("3.00"))]


def test_sales_figures_per_order_and_per_day(sold):
    assert rows(sales.sales_kpis(sold)) == [(dec("31.00"), dec("6.20"), dec("16.00"), dec("5.00"), dec("8.00"))]
    assert [tuple(r) for r in sales.sales_by_day(sold).collect()] == [
        (date(1999, 12, 31), dec("8.00"), 1), (date(2001, 1, 6), dec("3.00"), 2), (date(2001, 1, 8), dec("4.00"), 1), (None, dec("16.00"), 1),
    ]


def test_unnamed_categories_are_left_out(spark):
    df = items(spark, [("r", "o", None, "1.00", 1), ("r", "o", "", "2.00", 1), ("r", "o", "a", "3.00", 1), ("r", "p", "b", "4.00", 2)])
    assert [tuple(r) for r in sales.sales_category(gold.category_revenue(df)).collect()] == [("b", dec("8.00")), ("a", dec("3.00"))]
    assert rows(pricing.category_pricing(df)) == [("a", dec("3.00"), 1, dec("3.00"), 1), ("b", dec("8.00"), 2, dec("4.00"), 1)]


def test_category_price_counts_orders_once_and_skips_null_ids_and_prices(spark):
    df = items(
        spark,
        [("r", "o", "a", "1.00", 1), ("r", "o", "a", "1.01", 1), ("r", None, "a", None, 5), ("r", "p", "a", None, 1)],
    )
    assert rows(pricing.category_pricing(df)) == [("a", dec("2.01"), 8, dec("1.01"), 2)]


# Loyalty


def test_orders_per_month_drops_the_fraction(spark):
    ten = [("r", at("2001-01-01", f"12:00:0{i}.000"), "1.00", 1) for i in range(9)] + [("r", at("2001-01-04", "13:00:00.000"), "1.00", 1)]
    one_day = [("once", at("2001-01-01"), "1.00", 1), ("once", at("2001-01-02", "11:00:00.000"), "1.00", 1)]
    slow = [("slow", at("2001-01-01"), "1.00", 1), ("slow", at("2001-03-01"), "1.00", 1)]
    got = rows(loyalty.loyalty(facts(items(spark, ten + one_day + slow))), "restaurantid", "orders_per_month", "orders_per_month_exact")
    assert got == [("once", None, None), ("r", dec("90.00"), dec("100.00")), ("slow", dec("0.00"), dec("1.02"))]


def test_loyalty_averages_lines_not_orders(spark):
    df = items(spark, [("r", "o", "1.00", 1), ("r", "o", "1.01", 1), ("r", "p", None, 1), (None, "q", "5.00", 1), ("r", None, "5.00", 1)])
    assert rows(loyalty.loyalty(facts(df)), "restaurantid", "total_orders", "total_spend", "avg_item_spend") == [("r", 2, dec("2.01"), dec("1.01"))]


def test_loyalty_segments_and_preference(spark):
    df = items(
        spark,
        [("big", f"o{i}", "soup", "1.00", 1) for i in range(5)]
        + [("big", "o1", "cake", "5.00", 1), ("s1", "p1", "soup", "3.00", 2), ("s2", "p2", "", "9.00", 1), ("s3", "p3", "cake", None, 1)],
    )
    report = loyalty.loyalty(facts(df))
    assert rows(loyalty.loyalty_segments(report)) == [("High Frequency", 4)]  # p75 of 5, 1, 1, 1 is 1
    more = loyalty.loyalty(facts(items(spark, [(r, f"{r}{i}", "2.00", 1) for r, n in (("a", 4), ("b", 3), ("c", 2), ("d", 1)) for i in range(n)])))
    assert rows(loyalty.loyalty_kpis(more)) == [(2, dec("7.00"), 2, dec("3.00"))]
    assert loyalty.loyalty_top(more).columns == ["restaurantid", "total_orders", "total_spend", "orders_per_month", "frequency_segment"]
    assert rows(loyalty.loyalty_category_preference(df, report)) == [
        ("High Frequency", "cake", dec("5.00"), 2, Decimal("0.3125"), False),
        ("High Frequency", "soup", dec("11.00"), 7, Decimal("0.6875"), True),
    ]


# Location


def test_location_ranks_with_gaps_and_counts_tolerant_days(spark):
    df = items(
        spark,
        [
            ("a", at("2001-01-02"), "5.00", 1), ("a", "2001-02-03T00:00:00Z", "5.00", 1), ("a", "bad", "0.00", 1),
            ("b", "2001-02-03T00:00:00Z", "10.00", 1), ("c", at("2001-03-01"), "1.00", 1), ("d", "x", None, 1),
            (None, at("2001-01-01"), "99.00", 1),
        ],
    )
    expected = [
        ("a", "2001-01", dec("10.00"), 3, dec("3.33"), 2, 1),
        ("b", None, dec("10.00"), 1, dec("10.00"), 1, 1),
        ("c", "2001-03", dec("1.00"), 1, dec("1.00"), 1, 3),
        ("d", None, None, 1, None, 0, 4),
    ]
    assert [tuple(r) for r in location.location(facts(df)).collect()] == expected
    assert [tuple(r) for r in location.location(facts(df), gold.cohort(facts(df))).collect()] == expected
    best = location.location_top(location.location_figures(facts(df)), k=3)
    assert [(r["revenue_rank"], r["restaurantid"]) for r in best.collect()] == [(1, "a"), (1, "b"), (3, "c")]


# Pricing


ITEM_ROWS = [("r", "a", "10.00", 1), ("r", "a", "5.00", 2), ("r", "b", "7.00", 1), ("r", "c", None, 1), ("r", None, "9.00", 1)]
OPTION_ROWS = [("a", "-1.00", 2), ("a", "3.00", 1), ("a", None, 1), ("b", "2.00", None), ("none", "-5.00", 1), (None, "-5.00", 1)]


def brute_force_pairs(item_rows, option_rows):
    """Join every line with every option of its order and sum, as a plain loop."""
    orders: dict = {}
    for _, order, price, quantity in item_rows:
        if order is None:
            continue
        revenue = None if price is None else Decimal(price) * quantity
        for option in [o for o in option_rows if o[0] == order] or [(order, None, None)]:
            entry = orders.setdefault(order, {"gross": None, "discount": dec(0), "addon": dec(0), "off": False})
            if revenue is not None:
                entry["gross"] = (entry["gross"] or 0) + revenue
            if option[1] is not None and Decimal(option[1]) < 0:
                entry["off"] = True
            if option[1] is not None and option[2] is not None:
                amount = Decimal(option[1]) * option[2]
                entry["discount" if amount < 0 else "addon"] += amount
    out = []
    for label, off in (("Discounted", True), ("Full Price", False)):
        group = [o for o in orders.values() if o["off"] == off]
        gross = [o["gross"] for o in group if o["gross"] is not None]
        if group:
            out.append(
                (label, len(group), sum(gross), sum(o["discount"] for o in group),
                 sum(o["gross"] + o["discount"] + o["addon"] for o in group if o["gross"] is not None), sum(gross) / len(gross))
            )
    return out


def test_pricing_counts_everything_once(spark):
    lines, opts = silver.item_facts(items(spark, ITEM_ROWS)), silver.option_facts(options(spark, OPTION_ROWS))
    assert rows(pricing.pricing(lines, opts)) == [
        ("Discounted", 1, dec("20.00"), dec("-2.00"), dec("21.00"), dec("20.00")),
        ("Full Price", 2, dec("7.00"), dec("0.00"), dec("7.00"), dec("7.00")),
    ]


def test_pricing_by_line_join_equals_the_pairs(spark):
    lines, opts = silver.item_facts(items(spark, ITEM_ROWS)), silver.option_facts(options(spark, OPTION_ROWS))
    got = rows(pricing.pricing(lines, opts, line_join=True))
    assert got == brute_force_pairs(ITEM_ROWS, OPTION_ROWS)
    assert got[0][2] == dec("60.00")  # 20.00 for each of three options


def test_pricing_from_order_grain(spark):
    df, given = items(spark, ITEM_ROWS), options(spark, OPTION_ROWS)
    for line_join in (False, True):
        fine = pricing.pricing(silver.item_facts(df), silver.option_facts(given), line_join)
        coarse = pricing.pricing(facts(df), silver.order_option_facts(given), line_join)
        assert rows(fine) == rows(coarse)


def test_pricing_figures_of_no_orders_are_zero(spark):
    none = pricing.pricing(silver.item_facts(items(spark, [("r", None, "1.00", 1)])), silver.option_facts(options(spark, [(None, "1.00", 1)])))
    assert rows(pricing.pricing_kpis(none)) == [(0, 0, dec("0.00"), dec("0.00"))]


# Everything together


def test_totals_agree_across_tables(spark):
    df = items(spark, [(f"r{i % 3}", at(f"2001-01-{1 + i % 28:02d}") if i % 5 else None, f"c{i % 4}", f"{i}.25", i % 7) for i in range(200)])
    lines = silver.item_facts(df)
    totals = [
        gold.order_metrics(lines).groupBy().sum("order_revenue").first()[0],
        gold.daily_clv(lines).groupBy().sum("order_revenue").first()[0],
        gold.category_revenue(df).groupBy().sum("total_revenue").first()[0],
    ]
    assert len(set(totals)) == 1


def test_summary_is_one_row_with_every_figure(spark):
    cards = summary.kpi_cards(facts(items(spark, ITEM_ROWS)), silver.order_option_facts(options(spark, OPTION_ROWS)))
    df = summary.kpi_summary(cards)
    assert df.columns == [f"{name}_{c}" for name, card in cards.items() for c in card.columns]
    row = df.first()
    assert (row["clv_total_orders"], row["pricing_discounted_orders"], row["sales_total_revenue"]) == (3, 1, dec("36.00"))
    assert df.count() == 1
