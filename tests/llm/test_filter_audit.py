from __future__ import annotations

from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import Row

from ordermill.llm.filter_audit import failures, filter_audit
from ordermill.llm.term_matrix import row_sums, term_matrix

TEXTS = [None, "", " \n", "a b a", "A b a", "x\x0by z w", "word " * 300, "Ü#ü B", "a b a", "CAPS and & more", "a  b\ta"]


def plain(rows, good, toxic):
    """The audit by applying each order to each row."""
    judged = []
    for key, text, part in rows:
        text = text or ""
        words = text.encode().split()
        bad = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            "D": any(c in text for c in "#$%&*|"),
            "E": key is not None and any(k is not None and k < key and (t or "") == text for k, t, _ in rows),
        }
        judged.append((key, part or "", {name for name in bad if bad[name]}))
    out, shapley = {}, Counter()
    for part in {part for _, part, _ in judged}:
        for order in permutations("ABCDE"):
            left = [(key, bad) for key, of, bad in judged if of == part]
            everything = left
            for step, name in enumerate(order, 1):
                gone = [key for key, bad in left if name in bad]
                failing = sum(name in bad for _, bad in everything)
                left = [(key, bad) for key, bad in left if name not in bad]
                only = sum(bad == {name} for _, bad in everything)
                lost = [sum(key in marked for key in gone) for marked in (good, toxic)]
                out[part, "".join(order), step, name] = (len(left), len(gone), failing - len(gone), only, *lost)
                shapley[part, name] += len(gone)
    return {key: (*value, shapley[key[0], key[3]]) for key, value in out.items()}


FIELDS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_audit_equals_the_plain_one_on_odd_rows(spark):
    rows = [(None if i == 5 else i % 14, text, [None, "", "web", "web"][i % 4]) for i, text in enumerate(TEXTS * 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    marks = [Row(3, 1, None), Row(3, 0, 1), Row(4, 0, 1), Row(99, 1, 1), Row(None, 1, 1), Row(8, 1, 0)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    got = {
        (row["part"], row["filter_order"], row["step"], row["filter"]): tuple(row[name] for name in FIELDS)
        for row in filter_audit(docs, labels).collect()
    }
    assert got == plain(rows, {3, 8}, {3, 4})


def test_clashing_columns_and_empty_tables(spark):
    inner = ["row", "id", "part", "digest", "n_words", "n_terms", "first", "mask", "good", "__first_salt", "text_", "rows"]
    schema = "doc_id bigint, text string, source string, " + ", ".join(f"{name} int" for name in inner)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int, good int")
    docs = spark.createDataFrame([(1, "a", "s", *[7] * len(inner))], schema)
    assert filter_audit(docs, labels).where("kept = 0").count() > 0
    assert filter_audit(docs.limit(0), labels).count() == 0
    with pytest.raises(ValueError, match="row"):
        term_matrix(docs, "text")


def test_matrix_holds_the_counts_of_the_words(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "k bigint, text string").repartition(2)
    matrix = term_matrix(docs, "text", {"size": len}, shard_bytes=8, span_terms=4, buckets=3)
    term = {row.code: bytes(row.term) for row in matrix.dictionary.collect()}
    assert len(set(term.values())) == len(term) == matrix.dictionary.count()
    found, shards = {}, matrix.shards.collect()
    for shard in shards:
        starts, terms, counts = (np.frombuffer(shard[name], kind) for name, kind in (("starts", "<i8"), ("terms", "<i8"), ("counts", "<u4")))
        for i, row in enumerate(shard.rows):
            own = range(starts[i], starts[i + 1])
            found[row.k] = {term[int(terms[at])]: int(counts[at]) for at in own}
            assert row.size == len((TEXTS[row.k] or "").encode())
    assert found == {k: Counter((text or "").encode().split()) for k, text in enumerate(TEXTS)}
    assert len(shards) > 3
    sums = {row.k: (row.n_words, row.n_terms) for row in row_sums(matrix).collect()}
    assert sums == {k: (sum(words.values()), len(words)) for k, words in found.items()}


def test_failures_of_a_text_of_very_many_copies(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'same text' AS text", "'s' AS source")
    rows = failures(docs).collect()
    assert sorted(row.id for row in rows if not row.fails_e) == [0] and len(rows) == 3000
