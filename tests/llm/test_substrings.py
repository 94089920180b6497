from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from ordermill.llm.fm_index import FMIndex
from ordermill.llm.registry import op6_substrings
from ordermill.llm.substrings import drop_repeats, earlier_windows, without_repeats


def plainly(rows, window=13):
    split = [(text or "").encode().split() for _, text in rows]
    first = {}
    for (doc, _), words in zip(rows, split, strict=True):
        if doc is not None:
            for i in range(len(words) - window + 1):
                gram = tuple(words[i : i + window])
                first[gram] = min(first.get(gram, doc), doc)
    out = []
    for (doc, _), words in zip(rows, split, strict=True):
        gone = set()
        for i in range(len(words) - window + 1):
            if doc is not None and first[tuple(words[i : i + window])] < doc:
                gone.update(range(i, i + window))
        kept = b" ".join(word for i, word in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("symbols", [2, 5, 300])
def test_backward_search_finds_all_occurrences(symbols):
    rng = np.random.default_rng(symbols)
    text = np.append(rng.integers(1, symbols, 700), 0)
    index = FMIndex(text, 5)
    for length in (1, 3, 5):
        patterns = np.stack([text[i : i + length] for i in range(690)] + [rng.integers(1, symbols, length) for _ in range(50)])
        low, high = index.search(patterns)
        for pattern, a, b in zip(patterns, low, high, strict=True):
            places = {i for i in range(len(text) - length + 1) if (text[i : i + length] == pattern).all()}
            assert set(index.suffixes[a:b].tolist()) == places


def test_earlier_windows_of_a_shard():
    hits = earlier_windows([b"a b c d e", b"x b c d y", b"b c d", b"a a a a"], np.array([5, 3, 9, 1]), 3)
    assert hits == [[(1, 4)], [], [(0, 3)], []]


def test_query_equals_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert sorted(map(tuple, op6_substrings(spark, small).collect()), key=str) == plainly(rows)


def odd_rows():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    passage = " ".join(rng.choice(words) for _ in range(30))
    rows = [(None, passage), (1, None), (2, ""), (3, " \n"), (4, "a " * 3000), (5, "a " * 20), (6, "few words"), (7, f"{passage} x"), (7, f"y {passage}"), (12, f"{passage} x"), (12, f"one two y {passage}")]
    for doc in range(10, 40):
        before, after = (" ".join(rng.choice(words) for _ in range(rng.randrange(30))) for _ in range(2))
        rows.append((doc, f"{before}\t{passage}\r\n{after}"))
    rows += [(50, "Ü é " * 30), (51, "Ü é " * 30), (51, "Ü é " * 30), (60, " ".join(f"long{i}" for i in range(20_000)))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("crowd", [4096, 2])
def test_odd_rows(spark, crowd):
    rows = odd_rows()
    docs = spark.createDataFrame([(*row, 1, "s") for row in rows], "doc_id bigint, text string, id int, spans string")
    got = without_repeats(docs, crowd=crowd)
    assert got.columns == [*docs.columns, "kept", "n_words", "n_removed"]
    found = [(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in got.collect()]
    assert sorted(found, key=str) == plainly(rows)
    assert without_repeats(docs.limit(0)).count() == 0


def test_columns_of_any_name_stay(spark):
    names = ["anchors", "crowds", "_id", "_row", "id", "row", "position", "start", "kept", "n_words", "n_removed"]
    text = " ".join(f"w{i}" for i in range(20))
    schema = "doc_id bigint, text string, " + ", ".join(f"{name} int" for name in names)
    docs = spark.createDataFrame([(1, text, *range(len(names))), (2, f"x {text}", *range(len(names)))], schema)
    rows = sorted(map(tuple, drop_repeats(docs).collect()))
    assert rows == [(1, text, *range(len(names))), (2, "x", *range(len(names)))]
    with pytest.raises(ValueError, match="kept"):
        without_repeats(docs)
    free = docs.drop("kept", "n_words", "n_removed")
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.anchors, r._row) for r in without_repeats(free).collect()) == [(1, 20, 0, 0, 3), (2, 21, 20, 0, 3)]
