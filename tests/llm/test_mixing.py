from __future__ import annotations

from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermill.llm import mixing
from ordermill.llm.mixing import mix, mixed_blocks, permuted, taken, targets
from ordermill.llm.registry import op13_mixing

SCHEMA = "doc_id bigint, text string, source string"


def plain_targets(sizes):
    """The excess of stopped sources shared out again by weight until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {name: (5, 2, 1)[i % 3] for i, name in enumerate(names)}
    left, free, out = Fraction(3 * sum(sizes.values()), 2), set(names), {}
    while free:
        share = left / sum(weight[name] for name in free)
        above = {name for name in free if weight[name] * share >= 2 * sizes[name]}
        if not above:
            return out | {name: weight[name] * share for name in free}
        out |= {name: Fraction(2 * sizes[name]) for name in above}
        left -= sum(out[name] for name in above)
        free -= above
    return out


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 0, None: 1000, "é": 7, "z": 7}, {"": 5}, {"a": 0}, {}])
def test_targets_are_those_of_sharing_again(spark, sizes):
    rows = spark.createDataFrame([(name, size) for name, size in sizes.items()], "source string, size bigint")
    got = {row.source: row.target for row in targets(rows).collect()}
    assert got == {name: pytest.approx(float(target)) for name, target in plain_targets(sizes).items()}


@settings(deadline=None, max_examples=6)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=9))
def test_targets_of_any_sizes(spark, values):
    sizes = {f"s{i}": value for i, value in enumerate(values)}
    rows = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
    got = {row.source: row.target for row in targets(rows).collect()}
    assert got == {name: pytest.approx(float(target)) for name, target in plain_targets(sizes).items()}


@pytest.mark.parametrize("size", [1, 2, 3, 10, 1000])
def test_permutations(spark, size):
    found = spark.range(size).selectExpr("id", f"{size}L AS n", "5L AS k", "9L AS other")
    rows = found.select(permuted("id", "n", "k", 1).alias("a"), permuted("id", "n", "other", 1).alias("b")).collect()
    assert sorted(row.a for row in rows) == sorted(row.b for row in rows) == list(range(size))
    assert size < 10 or [row.a for row in rows] != [row.b for row in rows] != sorted(row.b for row in rows)


ROWS = [
    *[(i, " ".join(f"w{i}_{k}" for k in range(i % 37)), ["big", "big", "big", "x", None, ""][i % 6]) for i in range(300)],
    (7, None, "big"), (None, "a b\x0bc", "x"), (None, "a b\x0bc", "x"), (5000, "one " * 20_000, "big"), (5001, "", "only empty"), (7, "again", "big"),
]


def test_every_source_gives_its_target_and_no_document_too_much(spark):
    rows = taken(mix(spark.createDataFrame(ROWS, SCHEMA).repartition(4), block=16, shard_slots=50)).collect()
    assert Counter((row.doc_id, row.size) for row in rows) == Counter((key, len((text or "").split())) for key, text, _ in ROWS)
    sizes = Counter()
    for _, text, source in ROWS:
        sizes[source] += len((text or "").split())
    expected = plain_targets({source: sizes.get(source, 0) for _, _, source in ROWS})
    of = {(key, len((text or "").split())): source for key, text, source in ROWS}
    got = Counter()
    for row in rows:
        source = of[row.doc_id, row.size]
        assert 0 <= row.taken <= 2 * row.size and row.source_size == sizes[source]
        assert row.target == pytest.approx(float(expected[source]))
        got[source] += row.taken
    assert {source: got[source] for source in expected} == {source: pytest.approx(float(target), abs=0.5) for source, target in expected.items()}


def test_blocks_hold_the_words_taken_and_reruns_agree(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    mixed = mix(docs, block=16, shard_slots=50, texts=True)
    words = Counter()
    blocks = mixed_blocks(mixed).collect()
    assert len({(row.source, row.slot) for row in blocks}) == len(blocks)
    assert len({(row.source, row.epoch, row.block) for row in blocks}) == len(blocks)
    for row in blocks:
        own = row.text.split(" ")
        assert len(own) <= 16
        words += Counter(own)
    rows = [tuple(row) for row in taken(mixed).collect()]
    for key, size, *_, got in rows:
        if key is not None and key < 300 and size > 1:
            assert sum(words[f"w{key}_{k}"] for k in range(size)) == got
    assert sum(words.values()) == sum(row[-1] for row in rows)
    again = [tuple(row) for row in taken(mix(docs.repartition(5), block=16, shard_slots=50)).collect()]
    order = lambda row: (row[0] is None, row[0] or 0, row[1:])
    assert sorted(rows, key=order) == sorted(again, key=order)


def test_shards_draw_by_the_targets(spark):
    docs = spark.createDataFrame([(i, "w " * 2000, "abc"[i % 3]) for i in range(60)], SCHEMA)
    mixed = mix(docs, block=4, shard_slots=1000)
    share = {row.sid: row.quota for row in mixed.sources.collect()}
    total = sum(share.values())
    for row in mixed.slots.groupBy("shard", "sid").count().join(mixed.slots.groupBy("shard").agg(F.count("*").alias("n")), "shard").collect():
        p = share[row.sid] / total
        assert abs(row["count"] - row.n * p) < 6 * (row.n * p * (1 - p)) ** 0.5 + 3


def test_clashing_columns_and_an_empty_table(spark):
    names = ["sid", "size", "start", "_range", "target", "slot", "block", "source_size", "taken", "id", "none", "weight"]
    schema = SCHEMA + ", " + ", ".join(f"{name} int" for name in names)
    docs = spark.createDataFrame([(1, "a b", "s", *[4] * len(names))], schema)
    assert [tuple(row) for row in taken(mix(docs)).collect()] == [(1, 2, 2, 3.0, 3)]
    assert taken(mix(docs.limit(0))).count() == 0


def test_no_python_in_the_plans(spark, small, monkeypatch):
    plans = []
    plain = mixing.staged

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, name)

    monkeypatch.setattr(mixing, "staged", seen)
    plans.append(op13_mixing(spark, small)._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 5 and not any(word in plan for plan in plans for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
