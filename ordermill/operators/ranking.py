"""Ranking and top lists over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def global_rank(df: DataFrame, value: str, name: str, ranges: int | None = None) -> DataFrame:
    """Add RANK() OVER (ORDER BY value DESC), NULLs last, without sorting the table in one task.

    The distinct values, with their counts, are dealt out by value ranges; the range number is a column of that one
    shuffle, so all its readers see the same ranges. A rank is the running count inside the value's range plus the total of
    the ranges above, one number per range. Rows with the same value, however many, are one counted value
    until the join back, where adaptive execution may split them. `df` is read twice: wrap an expensive one with `shared`.
    The number of ranges is that of the shuffle partitions unless given; it must not be merged at run time, hence explicit.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(F.col(value).alias("ranked_value")).agg(F.count("*").alias("n"))
    in_order = F.col("ranked_value").desc_nulls_last()
    dealt = counts.repartitionByRange(ranges, in_order).withColumn("range", F.spark_partition_id())
    totals = F.collect_list(F.struct("range", "n"))
    above = (
        dealt.groupBy("range")
        .agg(F.sum("n").alias("n"))
        .agg(totals.alias("totals"))
        .select(
            F.transform(
                F.sequence(F.lit(0), F.lit(ranges - 1)),
                lambda r: F.aggregate(
                    F.filter("totals", lambda t: t["range"] < r), F.lit(0).cast("bigint"), lambda total, t: total + t["n"]
                ),
            )
        )
        .scalar()
    )
    higher = Window.partitionBy("range").orderBy(in_order).rowsBetween(Window.unboundedPreceding, -1)
    ranks = dealt.select(
        "ranked_value", (F.get(above, F.col("range")) + F.coalesce(F.sum("n").over(higher), F.lit(0)) + 1).alias(name)
    )
    return df.join(ranks, F.col(value).eqNullSafe(F.col("ranked_value")), "left").drop("ranked_value")


def top(df: DataFrame, by: str, tie_break: str, k: int = 20) -> DataFrame:
    """The k rows with the highest `by`; equal values in order of `tie_break`."""
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(tie_break).asc_nulls_last()).limit(k)
