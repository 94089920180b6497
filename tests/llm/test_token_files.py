from __future__ import annotations

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from ordermill.llm import token_files
from ordermill.llm.perfect_hash import PerfectHash
from ordermill.llm.registry import op8_token_files, tokenizer


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash_is_one_to_one(n):
    keys = np.random.default_rng(n).permutation(10 * n + 1)[:n].astype("<u8")
    index = PerfectHash(PerfectHash.build(keys))
    assert sorted(index.places(keys).tolist()) == list(range(n))
    others = index.places(np.arange(10**6, 10**6 + 100, dtype="<u8"))
    assert ((others >= -1) & (others < max(n, 1))).all()


def test_repeated_keys_cannot_be_hashed():
    with pytest.raises(ValueError, match="distinct"):
        PerfectHash.build(np.array([5, 5], dtype="<u8"))


class InMemory:
    def __init__(self, data):
        self.data = data

    def read_at(self, size, at):
        return self.data[at : at + size]


@pytest.mark.parametrize("width", [2, 4])
def test_a_file_gives_back_its_records(width):
    records = [np.arange(at, dtype="<u4").tobytes() for at in range(60)]
    keys = [None, None, *[key // 2 for key in range(-40, 18)]]
    shard = token_files.Shard(InMemory(token_files.encode_shard(keys, records, width)))
    first = shard.find(np.array([-20, 0, 8, 9, 12345], dtype=np.int64)).tolist()
    assert first == [2, 42, 58, -1, -1]
    assert shard.copies(np.array(first[:3])).tolist() == [2, 2, 2]
    for most in (1, 5, 10**6):
        whole = list(token_files._records(shard, 0, len(records), 0, most))
        assert [row[3] for row in whole] == records and [row[0] for row in whole] == keys
    assert all(shard.ids(at).tobytes() == record for at, record in enumerate(records))
    empty = token_files.Shard(InMemory(token_files.encode_shard([], [], width)))
    assert empty.find(np.array([1])).tolist() == [-1]


def expected(rows):
    whole = Tokenizer.from_file(tokenizer())
    out, start = [], 0
    for doc, text in rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_equals_whole_encoding(spark, small):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect())
    assert sorted(map(tuple, op8_token_files(spark, small).collect())) == expected(rows)


def test_odd_rows_and_access_by_key(spark):
    rows = [(None, "no key"), (3, "three"), (1, None), (2, ""), (5, "five " * 30_000), (3, "three"), (-7, "minus Seven")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, key int")
    files = token_files.write(docs, tokenizer(), shard_ids=5)
    got = token_files.read(files).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    found = sorted(((r.key, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in got), key=str)
    assert found == sorted(expected(order), key=str)
    keys = spark.createDataFrame([(3,), (5,), (5,), (4,), (None,), (-7,)], "doc_id bigint")
    asked = token_files.lookup(files, keys).collect()
    assert sorted((r.key, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in asked) == sorted(r for r in expected(order) if r[0] in (3, 5, -7))
    nothing = token_files.write(docs.limit(0), tokenizer())
    assert token_files.read(nothing).count() == 0 and token_files.lookup(nothing, keys).count() == 0


def test_files_are_read_by_as_many_tasks(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('word ', id) AS text")
    files = token_files.write(docs, tokenizer(), shard_ids=50)
    assert files.files > 8 and spark.conf.get("spark.sql.adaptive.enabled") == "true"
    for df in (token_files.read(files), token_files.lookup(files, docs.select("doc_id"))):
        tasks = {row.task for row in df.selectExpr("spark_partition_id() AS task").collect()}
        assert len(tasks) >= 8
    assert token_files.read(files).count() == 400


def test_other_files_are_refused():
    with pytest.raises(ValueError, match="token file"):
        token_files.Shard(InMemory(b"x" * 100))
