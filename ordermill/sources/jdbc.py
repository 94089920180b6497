"""Relational sources through Spark's JDBC reader."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class SourceSchemaError(ValueError):
    """The source has no columns, or lacks one that the normalisation needs."""


@dataclass(frozen=True)
class JdbcSplit:
    """Range-split of a JDBC read on a numeric, date or timestamp column.

    The bounds only set the stride: rows outside them are still read, by the first and last task.
    """

    column: str
    lower: str
    upper: str
    partitions: int


def jdbc_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    split: JdbcSplit | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options. Address and credentials come from the caller, never from the library."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if split is not None:
        options.update(
            partitionColumn=split.column,
            lowerBound=split.lower,
            upperBound=split.upper,
            numPartitions=str(split.partitions),
        )
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    split: JdbcSplit | None = None,
    predicates: Sequence[str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A source table as a lazy DataFrame; filters and column choices are pushed to the database.

    Without `split` or `predicates` one task reads the whole table. `predicates` gives one task per
    condition, for tables whose values a range-split would spread unevenly; the conditions must
    cover every row exactly once, NULLs included.
    """
    if predicates is not None:
        if split is not None:
            raise ValueError("give either split or predicates, not both")
        settings = {"fetchsize": str(fetch_size), **(properties or {})}
        return require_columns(spark.read.jdbc(url, table, predicates=list(predicates), properties=settings))
    options = jdbc_options(url, table, properties, split, fetch_size)
    return require_columns(spark.read.format("jdbc").options(**options).load())


def balanced_predicates(keys: DataFrame, column: str, partitions: int, accuracy: int = 10_000) -> list[str]:
    """Conditions for `read_jdbc` that split a table by ranges of a key into parts of about equal numbers of rows.

    `keys` has the key column as an earlier load stored it; its quantiles, not its smallest and largest value, are where the ranges meet, so uneven keys do
    not give uneven parts. Every row, loaded or new, meets exactly one condition: the outer ranges are open, NULLs have one of their own. A range holds at most
    about rows / partitions rows, and beyond that only the rows of one key, which no range can split. Keys are numbers, dates or timestamps.
    """
    kind = dict(keys.dtypes)[column]
    places = [k / partitions for k in range(1, partitions)]
    cuts = keys.agg(F.percentile_approx(column, places, accuracy).alias("cuts")).select(F.array_distinct("cuts").cast("array<string>")).first()[0] if places else None
    marks = [f"{kind.split('_')[0].upper()} '{cut}'" if kind in ("date", "timestamp", "timestamp_ntz") else cut for cut in cuts or []]
    if not marks:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    between = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(marks, marks[1:], strict=False)]
    return [f"{column} < {marks[0]}", *between, f"{column} >= {marks[-1]}", f"{column} IS NULL"]


def require_columns(df: DataFrame, needed: Sequence[str] = ()) -> DataFrame:
    """The same DataFrame, or an error if it has no columns at all or lacks a needed one."""
    if not df.columns:
        raise SourceSchemaError("the source has no columns: check the table name and the connection")
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise SourceSchemaError(f"the source lacks {', '.join(missing)}")
    return df
