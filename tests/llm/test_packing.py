from __future__ import annotations

import zlib
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from tokenizers import Tokenizer

from ordermill.llm.packing import best_fill, pack, plan
from ordermill.llm.registry import op1_packing, tokenizer
from ordermill.llm.tokens import WordEncoder


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 30), max_size=9), st.integers(1, 60))
def test_best_fill_is_the_best_subset(lengths, room):
    counts = {length: lengths.count(length) for length in lengths}
    taken = best_fill(counts, sorted(counts, reverse=True), room)
    assert all(0 < copies <= counts[length] for length, copies in taken)
    best = max(sum(c) for n in range(len(lengths) + 1) for c in combinations(lengths, n) if sum(c) <= room)
    assert sum(length * copies for length, copies in taken) == best


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 150), max_size=30))
def test_plan_keeps_every_id_once_and_pads_nothing(lengths):
    seen = {}
    for pieces in plan(lengths, 64):
        size = sum(length for _, _, length in pieces)
        assert size == 64 or size & (size - 1) == 0
        for document, start, length in pieces:
            seen.setdefault(document, []).append((start, length))
    assert sorted(seen) == list(range(len(lengths)))
    for document, parts in seen.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == lengths[document]


TEXTS = [None, "", " \n", "One two  THREE.", "Ünïcode x\x1cy <|endoftext|> İstanbul ΟΔΟΣ é", "don't 42 *** a<|b I'LL É'S x÷y×z ÀÖØöÿß99¼ <|ENDOFTEXT|> {|}~ Ā́", "word " * 5000, "One two  THREE."]


def test_words_one_by_one_give_the_ids_of_the_text():
    whole = Tokenizer.from_file(tokenizer())
    texts = [text or "" for text in TEXTS]
    for encoder in (WordEncoder(tokenizer()), WordEncoder(tokenizer(), limit=2)):
        for text, ids in zip(texts, encoder.encode([text.encode() for text in texts]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_the_given_documents_come_back_from_their_pieces(spark, small):
    whole = Tokenizer.from_file(tokenizer())
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    expected = {row.doc_id: [*whole.encode(row.text or "", add_special_tokens=False).ids, 1] for row in docs}
    rows = op1_packing(spark, small).collect()
    parts, sequences = {}, {}
    for row in rows:
        ids = np.array(expected[row.doc_id][row.start : row.start + row.length], dtype="<u4")
        assert zlib.crc32(ids.tobytes()) == row.ids_crc32 and len(ids) == row.length
        assert row.doc_tokens == len(expected[row.doc_id])
        parts.setdefault(row.doc_id, []).append((row.start, row.length))
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    assert parts.keys() == expected.keys()
    for places, total in [*((parts[k], len(expected[k])) for k in parts), *((v, None) for v in sequences.values())]:
        at = 0
        for start, length in sorted(places):
            assert start == at
            at += length
        assert at == total if total is not None else at == 2048 or at & (at - 1) == 0


def test_odd_rows(spark):
    rows = [Row(doc_id=None if i == 3 else i % 6, text=text, start="x", ids=1) for i, text in enumerate(TEXTS)]
    schema = "doc_id bigint, text string, start string, ids int"
    whole = Tokenizer.from_file(tokenizer())
    got = pack(spark.createDataFrame(rows, schema), tokenizer(), window=16, chunk_ids=100).collect()
    total = sum(len(whole.encode(text or "", add_special_tokens=False).ids) + 1 for text in TEXTS)
    assert sum(row.length for row in got) == total
    assert pack(spark.createDataFrame([], schema), tokenizer()).count() == 0


@pytest.mark.parametrize("window", [1, 2, 5])
def test_tiny_windows(window):
    assert sum(p[2] for w in plan([1, 2, 7, 7], window) for p in w) == 17
