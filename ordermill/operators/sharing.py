"""Letting several branches of one plan read the same shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame


def shared(df: DataFrame) -> DataFrame:
    """The same rows, with every column kept live.

    A report that compares rows with a threshold over the same rows reads them more than once.
    Spark reuses one shuffle for all readers only if they ask for the same columns; column
    pruning would give each reader a slimmer copy of its own, and a scan to go with it.
    Dropping the rows that are NULL throughout uses all columns and, as `df` must have a
    column that is never NULL, drops nothing.
    """
    return df.na.drop(how="all")
