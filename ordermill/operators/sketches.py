"""Quantile sketches that are stored and merged: one small row per month instead of a pass over its rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch. Its rank error is some 0.1 % of all rows, also after merging; `SKETCH_ACCURACY` bounds it with room to spare, see `quantiles`.
SKETCH_SIZE = 4096
SKETCH_ACCURACY = 800


def sketched(df: DataFrame, columns: Iterable[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., measure, rows, sketch): a KLL sketch of every column for every group. Columns are money (two places) or whole numbers; NULLs are left out.

    Amounts go in as whole cents, so nothing is rounded. Partial sketches are made where the rows are; a group of very many rows is a sketch per task.
    """
    parts = [
        df.groupBy(*by).agg(
            F.count(column).alias("rows"),
            F.kll_sketch_agg_bigint((F.col(column).cast("decimal(20,2)") * 100).cast("bigint"), SKETCH_SIZE).alias("sketch"),
        ).select(*by, F.lit(column).alias("measure"), "rows", "sketch")
        for column in columns
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def merged_sketches(sketches: DataFrame, columns: Iterable[str], by: Sequence[str] = ()) -> DataFrame:
    """The merged sketch of each column, under its name, for every group, without `by` one row; sketches of no rows add nothing."""
    columns = tuple(columns)
    return sketches.where("rows > 0").groupBy(*by).agg(
        *[F.kll_merge_agg_bigint(F.when(F.col("measure") == column, F.col("sketch")), SKETCH_SIZE).alias(column) for column in columns],
        *[F.sum(F.when(F.col("measure") == column, F.col("rows"))).alias(f"rows_{column}") for column in columns],
    )


def sketched_quantile(column: str, p: Fraction | str) -> Column:
    """The quantile of a merged sketch, as an amount; NULL without rows."""
    cents = F.kll_sketch_get_quantile_bigint(F.col(column), F.lit(float(Fraction(p))))
    return F.when(F.col(f"rows_{column}") > 0, (cents.cast("decimal(20,0)") / 100).cast("decimal(20,2)"))
