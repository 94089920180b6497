"""Parquet tables, catalog views and the audited write."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ordermill.session import new_folder
from ordermill.sources.expectations import Expectation, measures


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite", expect: Sequence[Expectation] = ()
) -> dict[str, int]:
    """Write a table and return its audit: rows written, NULLs per column, and rows that fail each expectation (`fails_<name>`).

    The counts are taken while the rows pass to the writer, so the write is the only job.
    With `partition_by`, an overwrite replaces only the partitions that `df` has rows for. Files are compressed by zstd, as ids and times are
    long texts.
    """
    audit = Observation(f"write-{uuid.uuid4().hex}")
    writer = df.observe(audit, F.count(F.lit(1)).alias("rows"), *_null_counts(df), *measures(expect)).write.mode(mode).option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return audit.get


def audit_table(df: DataFrame, name: str) -> DataFrame:
    """The same audit as a report: one row per column with its type, row count and NULL count."""
    rows = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.lit(t).alias("data_type"),
            F.col("rows").alias("row_count"),
            F.col(f"nulls_{c}").alias("null_count"),
        )
        for c, t in df.dtypes
    ]
    return df.agg(F.count(F.lit(1)).alias("rows"), *_null_counts(df)).select(F.inline(F.array(*rows)))


def _null_counts(df: DataFrame) -> list:
    return [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{c}") for c in df.columns]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several reports will read to the shared folder and read it back.

    The folder lasts as long as the session.
    """
    path = f"{new_folder(df.sparkSession, name)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def register_views(tables: Mapping[str, DataFrame], prefix: str) -> list[str]:
    """Make tables available to SQL as `<prefix>_<layer>_<name>`; keys are `<layer>/<name>`."""
    names = []
    for key, df in tables.items():
        view = f"{prefix}_{key.replace('/', '_')}"
        df.createOrReplaceTempView(view)
        names.append(view)
    return names


def register_external(spark: SparkSession, paths: Mapping[str, str], prefix: str) -> list[str]:
    """Catalog tables `<prefix>_<layer>_<name>` over written Parquet folders, which outlive the session with the catalog.

    They own no files: dropping or replacing one leaves the data alone. They stay at these folders: for names that follow
    the daily run use `refresh.point_names`.
    """
    names = []
    for key, path in paths.items():
        name = f"{prefix}_{key.replace('/', '_')}"
        schema = spark.read.parquet(path).schema.toDDL()
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet LOCATION '{path}'")
        names.append(name)
    return names


def read_view(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
