from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermill.functions.amounts import half_up_ratio, mean_money


@pytest.mark.parametrize(
    "total, count, mean",
    [
        ("2.01", 2, "1.01"),
        ("-2.01", 2, "-1.01"),
        ("1.00", 3, "0.33"),
        ("0.00", 4, "0.00"),
        ("5.00", 0, None),
        (None, 3, None),
        ("99999999999999.99", 7, "14285714285714.28"),
    ],
)
def test_mean_is_half_up(spark, total, count, mean):
    df = spark.createDataFrame([(total and Decimal(total), count)], "t decimal(28,2), n bigint")
    assert df.select(mean_money(F.col("t"), F.col("n"))).first()[0] == (mean and Decimal(mean))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(1, 10**6)), min_size=20, max_size=60))
def test_ratio_equals_exact_rounding(spark, pairs):
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    for a, b, ratio in df.select("a", "b", half_up_ratio(F.col("a"), F.col("b"), 1)).collect():
        sign = -1 if a < 0 else 1
        exact = sign * ((20 * abs(a) + b) // (2 * b))
        assert ratio == Decimal(exact).scaleb(-1)
        assert abs(ratio - (Decimal(a) / b).quantize(Decimal("0.1"), ROUND_HALF_UP)) == 0
