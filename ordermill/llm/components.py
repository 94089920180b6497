"""Connected components of a link table, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.shared import staged


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root): every node of a link, with the smallest node it can reach; roots themselves are left out.

    Alternates two steps until the links no longer change. The large step ties the larger neighbours of every node to
    its smallest neighbour, the small step ties the smaller ones; both keep what is connected connected, and the
    links end as stars around the roots after a number of rounds that grows with the logarithm of the nodes. Smallest neighbours are
    plain aggregates with partial sums, joined back, so a node with very many links is no single group. Each round
    is a written table, so lineage stays short and a lost executor costs one round.

    Links with a null end, loops and repeated links say nothing and are dropped. An empty table gives no rows.
    """
    known = links.where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right)))
    pairs = staged(
        known.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).distinct(), "links"
    )
    before = _state(pairs)
    while before[0]:
        pairs = staged(_small(_large(pairs)), "links")
        after = _state(pairs)
        if after == before:
            break
        before = after
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _large(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(pairs: DataFrame) -> DataFrame:
    smallest = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(smallest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()


def _state(pairs: DataFrame) -> tuple:
    """Number of links and two sums over their hashes, to see whether a round changed anything."""
    hashed = F.xxhash64("u", "v")
    row = pairs.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(hashed.bitwiseAND(F.lit((1 << 31) - 1))).alias("low"),
        F.sum(F.shiftrightunsigned(hashed, 33)).alias("high"),
    ).first()
    return tuple(row)
