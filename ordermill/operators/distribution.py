"""Counts per label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distribution_over(df: DataFrame, label: str, domain: Sequence[str], name: str) -> DataFrame:
    """One row per label of the fixed `domain`, NULL where no row has it; other labels are left out.

    One global aggregate with a counter per label; nothing is joined.
    """
    counters = [F.nullif(F.count_if(F.col(label) == d), F.lit(0)).alias(f"c{i}") for i, d in enumerate(domain)]
    rows = [F.struct(F.lit(d).alias(label), F.col(f"c{i}").alias(name)) for i, d in enumerate(domain)]
    return df.agg(*counters).select(F.inline(F.array(*rows)))


def label_counts(df: DataFrame, label: str, name: str) -> DataFrame:
    """Rows per label, most frequent first."""
    return df.groupBy(label).agg(F.count("*").alias(name)).orderBy(F.desc(name), F.asc(label))
