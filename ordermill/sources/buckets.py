"""Tables stored in buckets of one key, so that grouping and joining them by it needs no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordermill.session import new_folder


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """`df` as the catalog table `name`, in `buckets` buckets of `key`, each one file sorted by it; returns the table.

    Tables with the same key type and number of buckets are co-located. The rows are shuffled once, here, into exactly these buckets. A bucket is one
    task of every reader, so choose as many that one fits a task: some 200 MB each. The key should have many values; one with a large share of all rows stays
    in one bucket. NULL is a key of its own.

    The files are below `path`, or a folder that goes with the session; the name lasts as long as the catalog. An existing table of that name is replaced.
    """
    folder = path or f"{new_folder(df.sparkSession, name)}/table"
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", folder).saveAsTable(name)
    return df.sparkSession.table(name)


def buckets_of(spark: SparkSession, name: str) -> tuple[list[str], int] | None:
    """The bucket columns and the number of buckets of a table, None if it has none."""
    rows = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    if "Num Buckets" not in rows:
        return None
    return [column.strip("`[] ") for column in rows["Bucket Columns"].split(",")], int(rows["Num Buckets"])
