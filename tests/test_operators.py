from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermill.operators.distribution import distribution_over, label_counts
from ordermill.operators.quantiles import quantiles
from ordermill.operators.ranking import global_rank, top

FRACTIONS = ("0.20", "0.33", "0.66", "0.75", "0.80")
quick = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def discrete(values: list, fraction: str):
    known = sorted(v for v in values if v is not None)
    return known[max(1, math.ceil(Fraction(fraction) * len(known))) - 1] if known else None


def found(spark, df, column: str, **options) -> list:
    wanted = {f"q{i}": (column, p) for i, p in enumerate(FRACTIONS)}
    row = spark.range(1).select(quantiles(df, wanted, **options).alias("q")).first()["q"]
    return [row[name] for name in wanted]


@quick
@given(st.lists(st.none() | st.integers(-50, 50), min_size=0, max_size=80))
def test_exact_quantiles_of_few_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    assert found(spark, df, "v") == [discrete(values, p) for p in FRACTIONS]


@pytest.mark.parametrize("accuracy", [20, 200, 100_000])
def test_exact_quantiles_with_a_coarse_sketch(spark, accuracy):
    """The sketch only narrows the search: however coarse, the answer is exact."""
    values = [Decimal((i * 7919) % 10007) / 100 for i in range(10007)] + [Decimal("5.00")] * 3000
    df = spark.createDataFrame([(v,) for v in values], "v decimal(20,2)").repartition(7)
    assert found(spark, df, "v", accuracy=accuracy) == [discrete(values, p) for p in FRACTIONS]


def test_one_value_holding_most_rows(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("v"))
    values = [7 if i % 3 else i for i in range(20_000)]
    assert found(spark, df, "v", accuracy=50) == [discrete(values, p) for p in FRACTIONS]


@pytest.mark.parametrize(
    "amount", ["90071992547409.93", "1234567890123.45", "999999999999999999.99", "-999999999999999999.99", "0.00"]
)
def test_large_amounts_are_exact(spark, amount):
    df = spark.range(100).select(F.lit(amount).cast("decimal(20,2)").alias("v"))
    assert found(spark, df, "v") == [Decimal(amount)] * len(FRACTIONS)


def test_neighbouring_large_amounts(spark):
    values = [Decimal("90071992547409.00") + Decimal(i) / 100 for i in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(20,2)")
    assert found(spark, df, "v", accuracy=50) == [discrete(values, p) for p in FRACTIONS]


def test_several_columns_at_once(spark):
    df = spark.range(1, 1001).select(F.col("id").alias("a"), (F.col("id") * 2).cast("decimal(20,2)").alias("b"))
    q = quantiles(df, {"a33": ("a", "0.33"), "b66": ("b", "0.66")})
    row = spark.range(1).select(q.alias("q")).first()["q"]
    assert (row["a33"], row["b66"]) == (330, Decimal("1320.00"))


def test_approximate_quantiles_are_close(spark):
    df = spark.range(1, 10_001).select(F.col("id").alias("v"))
    for value, p in zip(found(spark, df, "v", method="approx", accuracy=1000), FRACTIONS):
        assert abs(value - float(p) * 10_000) <= 20


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        quantiles(spark.range(3), {"p": ("id", "0.5")}, method="guess")


def ranks(values: list) -> list:
    def above(v):
        return sum(1 for x in values if x is not None and (v is None or x > v))

    return sorted(((v, 1 + above(v)) for v in values), key=repr)


@quick
@given(st.lists(st.none() | st.integers(-30, 30), min_size=0, max_size=60), st.sampled_from([1, 2, 5, None]))
def test_global_rank_equals_brute_force(spark, values, ranges):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = global_rank(df, "v", "r", ranges).collect()
    assert sorted(((r["v"], r["r"]) for r in got), key=repr) == ranks(values)


def test_global_rank_keeps_every_row_of_a_large_tie(spark):
    df = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, 5000).otherwise(F.col("id")).alias("v"), "id")
    got = global_rank(df, "v", "r", ranges=8)
    values = Counter(5000 if i % 3 == 0 else i for i in range(9_000))
    rank, expected = 1, {}
    for v in sorted(values, reverse=True):
        expected[v] = rank
        rank += values[v]
    rows = got.collect()
    assert len(rows) == 9_000
    assert all(r["r"] == expected[r["v"]] for r in rows)


def test_top_breaks_ties_by_id(spark):
    df = spark.createDataFrame([(f"{i:03d}", 1) for i in range(50)] + [("zzz", 2), ("nul", None)], "id string, v int")
    got = [r["id"] for r in top(df, "v", "id", 20).collect()]
    assert got == ["zzz"] + [f"{i:03d}" for i in range(19)]


def test_distribution_keeps_the_domain(spark):
    df = spark.createDataFrame([("High",), ("High",), ("Other",), (None,)], "s string")
    assert [tuple(r) for r in distribution_over(df, "s", ("High", "Low"), "n").collect()] == [("High", 2), ("Low", None)]
    assert [tuple(r) for r in label_counts(df, "s", "n").collect()] == [("High", 2), (None, 1), ("Other", 1)]
