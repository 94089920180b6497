"""Filter interaction audit: what each order of the same filters keeps, and which removals a filter adds to the others."""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.shared import staged, with_first
from ordermill.llm.term_matrix import row_sums, term_matrix

FILTERS = "ABCDE"
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SIGNS = b"#$%&*|"


def _capitals(text: bytes) -> int:
    return len(text) - len(text.translate(None, _CAPITALS))


def _characters(text: bytes) -> int:
    return len(text.decode())


def _signs(text: bytes) -> int:
    return len(text) - len(text.translate(None, _SIGNS))


def failures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source") -> DataFrame:
    """(row, id, part, n_words, n_terms, fails_a ... fails_e) for every row of `docs`.

    A: under 50 words. B: fewer than 65 different words per 100. C: over 5 capitals A-Z per 100 code points. D: holds one of `#$%&*|`.
    E: a row with a smaller id has the same text. Words are the entries of a document-term matrix: its row sums are the words, its entries the
    different ones.

    Null and empty texts have no words (A fails, B does not) and are equal to each other. A null part is the empty string. A null id is neither smaller nor larger than
    another. Repeated rows are rows of their own, without a smaller id among them. Other columns are not read.
    """
    bare = docs.select(
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        F.col(id_column).alias("id"),
        F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
        F.sha2(F.coalesce(F.col(text_column), F.lit("")).cast("binary"), 256).alias("digest"),
    )
    matrix = term_matrix(bare, "text", {"n_capitals": _capitals, "n_chars": _characters, "n_signs": _signs})
    rows = staged(row_sums(matrix), "filter-rows")
    return with_first(rows, "digest", "id", F.col("row"), "first").select(
        "row",
        "id",
        "part",
        "n_words",
        "n_terms",
        (F.col("n_words") < 50).alias("fails_a"),
        (100 * F.col("n_terms") < 65 * F.col("n_words")).alias("fails_b"),
        (100 * F.col("n_capitals") > 5 * F.col("n_chars")).alias("fails_c"),
        (F.col("n_signs") > 0).alias("fails_d"),
        F.coalesce(F.col("id") > F.col("first"), F.lit(False)).alias("fails_e"),
    )


def interactions(failed: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): one row per part, order and step.

    `failed` is what `failures` gives. Documents are first counted by part, set of failed filters and labels, at most 128 counts a part, inside the tasks
    that have them; what a set of filters leaves is a sum of these, for each of the 32 sets. An order's steps follow from the sets before and after, so
    the work per part is the same however many documents it has.

    An id is good (toxic) if any of its labels says quality 1 (toxic 1); ids without labels are neither. Parts without rows do not appear.
    """
    marks = labels.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    mask = sum((F.when(F.col(f"fails_{name.lower()}"), 1 << bit).otherwise(0) for bit, name in enumerate(FILTERS)), F.lit(0))
    counted = (
        failed.select("id", "part", mask.alias("mask"))
        .join(marks, "id", "left")
        .groupBy("part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sums = counted.groupBy("part").agg(
        _left("n").alias("left"), _left("n * good").alias("good"), _left("n * toxic").alias("toxic"), _only("n").alias("only")
    )
    shapley = F.expr(f"array({', '.join(_shapley(bit) for bit in range(len(FILTERS)))})")
    steps = sums.withColumn("shapley", shapley).select("*", F.explode(_steps()).alias("s"))
    at, before, after = F.col("s.at"), F.col("s.before"), F.col("s.after")

    def lost(name: str) -> Column:
        return F.col(name)[before] - F.col(name)[after]

    failing = F.col("left")[0] - F.col("left")[F.call_function("shiftleft", F.lit(1), at)]
    return steps.select(
        "part",
        F.col("s.filter_order").alias("filter_order"),
        F.col("s.step").alias("step"),
        F.col("s.filter").alias("filter"),
        F.col("left")[after].alias("kept"),
        lost("left").alias("removed"),
        (failing - lost("left")).alias("redundant"),
        F.col("only")[at].alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.col("shapley")[at].alias("shapley"),
    )


def _left(number: str) -> Column:
    """For every set of filters what the documents that fail none of it add up to."""
    return F.expr(f"array({', '.join(f'sum(if((mask & {s}) = 0, {number}, 0L))' for s in range(1 << len(FILTERS)))})")


def _only(number: str) -> Column:
    """For every filter what the documents that fail it alone add up to."""
    return F.expr(f"array({', '.join(f'sum(if(mask = {1 << bit}, {number}, 0L))' for bit in range(len(FILTERS)))})")


def _shapley(bit: int) -> str:
    """What a filter removes, added up over all orders: each set of others stands before it in so many orders."""
    others = [s for s in range(1 << len(FILTERS)) if not s >> bit & 1]
    weights = [factorial(s.bit_count()) * factorial(len(FILTERS) - 1 - s.bit_count()) for s in others]
    return " + ".join(f"{weight} * (left[{s}] - left[{s | 1 << bit}])" for s, weight in zip(others, weights, strict=True))


def _steps() -> Column:
    """All orders and their steps: the filter's place, and the sets of filters applied before and after it."""
    entries = []
    for order in permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[at] for at in order), 0
        for step, at in enumerate(order, 1):
            after = before | 1 << at
            entries.append(f"('{name}', {step}, '{FILTERS[at]}', {at}, {before}, {after})")
            before = after
    fields = "array<struct<filter_order: string, step: int, filter: string, at: int, before: int, after: int>>"
    return F.expr(f"array({', '.join(entries)})").cast(fields)


def filter_audit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source") -> DataFrame:
    """`interactions` of the `failures` of `docs`. An empty table gives no rows."""
    return interactions(failures(docs, id_column, text_column, part_column), labels, id_column)
