from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from ordermill.llm import simhash
from ordermill.llm.bitslice import forest_within, pairs_within
from ordermill.llm.registry import op3_simhash


def roots(nodes, links):
    parent = {node: node for node in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {node: find(node) for node in nodes}


def plain_fingerprint(text, size=4):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(shingle.encode(), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize(("n", "groups", "radius"), [(500, 5, 4), (300, 1, 4), (700, 200, 22), (130, 1, 20), (1, 1, 4), (64, 1, 0)])
def test_bit_sliced_pairs_equal_plain_distances(n, groups, radius):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 1 << 63, max(1, n // 10), dtype=np.uint64)
    values = base[rng.integers(0, len(base), n)]
    for _ in range(3):
        values = values ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    group = np.sort(rng.integers(0, groups, n))
    found = {
        (int(a), int(b), int(c)) for i, j, d in pairs_within(group, values, radius) for a, b, c in zip(i, j, d, strict=True)
    }
    distance = {(a, b): int(values[a] ^ values[b]).bit_count() for a in range(n) for b in range(a + 1, n) if group[a] == group[b]}
    assert found == {(*pair, d) for pair, d in distance.items() if d <= radius}
    i, j, _ = forest_within(group, values, radius, most=50)
    assert roots(range(n), zip(i.tolist(), j.tolist(), strict=True)) == roots(range(n), [p for p, d in distance.items() if d <= radius])
    assert len(i) < n


def test_every_pair_within_the_radius_shares_a_block():
    rng = random.Random(1)
    for spare in (0, 1, 2):
        masks = simhash.block_masks(4, spare)
        for _ in range(300):
            flips = sum(1 << bit for bit in rng.sample(range(64), 4))
            assert any(not flips & mask for mask in masks)


def brute(rows):
    prints = [plain_fingerprint(text) for _, text in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4]
    root = roots(range(len(rows)), links)
    members = {}
    for at, (doc_id, _) in enumerate(rows):
        members.setdefault(root[at], []).append(doc_id)
    smallest = {k: min((d for d in v if d is not None), default=None) for k, v in members.items()}
    return sorted(((d, f"{prints[at]:016x}", smallest[root[at]]) for at, (d, _) in enumerate(rows)), key=str)


def test_query_equals_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert sorted(map(tuple, op3_simhash(spark, small).collect()), key=str) == brute(rows)


def odd_rows():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    base = [rng.choice(words) for _ in range(400)]
    rows = [(None, None), (1, ""), (2, " \t"), (3, "A b"), (4, "a B"), (4, "other text with same id"), (5, " ".join(base)), (5, " ".join(base))]
    for at in range(10, 60):
        copy = list(base)
        copy[rng.randrange(400)] = "changed"
        rows.append((at, " ".join(copy)))
    return [*rows, (100, "x" * 200_000), (None, "lone words")]


@pytest.mark.parametrize("chunk", [4096, 5])
def test_odd_rows(spark, chunk, monkeypatch):
    monkeypatch.setattr(simhash.near_links, "__defaults__", (chunk,))
    rows = odd_rows()
    docs = spark.createDataFrame([(*row, "f") for row in rows], "doc_id bigint, text string, fp string")
    got = simhash.simhash_components(docs).collect()
    got = [(r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in got]
    assert sorted(got, key=str) == brute(rows)
    assert simhash.simhash_components(docs.limit(0)).count() == 0


def shingles(text):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def kept_plainly(rows):
    sets = [shingles(text) for _, text in rows]
    links = []
    for a in range(len(rows)):
        for b in range(a):
            either = len(sets[a] | sets[b])
            if not either or len(sets[a] & sets[b]) >= 0.8 * either:
                links.append((a, b))
    root = roots(range(len(rows)), links)
    best = {}
    for at, (doc_id, _) in enumerate(rows):
        best[root[at]] = min(best.get(root[at], (True, 0)), (doc_id is None, doc_id or 0))
    return sorted(best.values())


def test_one_of_each_group_stays(spark):
    rows = odd_rows()
    docs = spark.createDataFrame([(d, t, "f") for d, t in rows], "doc_id bigint, text string, fp string")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == kept_plainly(rows)
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0


def test_near_copies_of_the_given_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((False, r.doc_id) for r in simhash.drop_near_duplicates(docs).collect()) == kept_plainly(rows)


@pytest.mark.parametrize(("chunk", "size"), [(4096, 1 << 23), (40, 1 << 23), (4096, 20_000)])
def test_a_template_with_different_texts_loses_no_similar_pair(spark, chunk, size, monkeypatch):
    monkeypatch.setattr(simhash._missed_links, "__defaults__", (chunk, size))
    rng = random.Random(3)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]

    def edited(words, n):
        words = list(words)
        for at in rng.sample(range(len(words)), n):
            words[at] = f"x{rng.randrange(10**6)}"
        return words

    texts = [edited(base, 4) for _ in range(120)]
    texts += [edited(text, 3) for text in texts[::10]]
    rows = [(at, " ".join(text)) for at, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted((False, r.doc_id) for r in simhash.drop_near_duplicates(docs).collect()) == kept_plainly(rows)


def test_repeats_of_a_line_do_not_part_near_copies(spark):
    rows = []
    for seed in range(6):
        rng = random.Random(seed)
        base = " ".join(f"w{rng.randrange(5000)}" for _ in range(500))
        line = " ".join(f"l{k}{seed}" for k in range(10))
        rows += [(len(rows) + at, base + f" {line}" * times) for at, times in enumerate((1, 60))]
    assert len(kept_plainly(rows)) == 6
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted((False, r.doc_id) for r in simhash.drop_near_duplicates(docs).collect()) == kept_plainly(rows)


def test_cells_without_pairs_apart_give_no_links():
    sets = [np.arange(at, at + 9, dtype="<u4") for at in (0, 0, 50)]
    prints = np.array([1, 1, (1 << 40) - 1], dtype="<u8")
    cell = np.array([5, 5, 5])
    assert simhash._joined(cell, prints, np.array([0, 0, 1]), sets, 22, 0.8) == []
    assert simhash._joined(cell, prints, np.array([0, 1, 2]), sets, 22, 0.8) == [(0, 1)]


def test_near_simhashes_meet_in_block_tables_where_no_band_agrees(spark):
    rng = random.Random(11)
    base = [f"w{rng.randrange(5000)}" for _ in range(1500)]
    rows = [(0, " ".join(base))]
    for at in range(1, 7):
        copy = list(base)
        copy[rng.randrange(1500)] = f"x{at}"
        rows.append((at, " ".join(copy)))
    prints = [simhash.fingerprint(np.unique(simhash.shingle_hashes(text.encode(), 5))) for _, text in rows]
    assert all((prints[0] ^ other).bit_count() <= 4 for other in prints)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert [r.doc_id for r in simhash.drop_near_duplicates(docs, bands=1, rows=2000).collect()] == [0]


def distinct_print(text):
    return simhash.fingerprint(np.unique(simhash.shingle_hashes(text.encode(), 5)))


def test_block_tables_lose_no_similar_pair_where_no_band_agrees(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]

    def edited(words, n):
        words = list(words)
        for at in rng.sample(range(len(words)), n):
            words[at] = f"x{rng.randrange(10**6)}"
        return words

    texts = [edited(base, 4) for _ in range(120)]
    texts = [" ".join(text) for text in texts + [edited(text, 3) for text in texts[::10]]]
    prints, sets = [distinct_print(text) for text in texts], [shingles(text) for text in texts]
    links = [
        (a, b)
        for a in range(len(texts))
        for b in range(a)
        if (prints[a] ^ prints[b]).bit_count() <= 12 and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    kept = sorted(set(roots(range(len(texts)), links).values()))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert sorted(r.doc_id for r in simhash.drop_near_duplicates(docs, bands=1, rows=2000, near=12).collect()) == kept


def test_short_similar_texts_may_have_distant_simhashes(spark):
    rng = random.Random(8)
    rows = []
    while len(rows) < 4:
        words = [f"w{rng.randrange(10**6)}" for _ in range(9)]
        pair = [" ".join(words[:8]), " ".join(words)]
        if (distinct_print(pair[0]) ^ distinct_print(pair[1])).bit_count() > 22:
            rows += [(len(rows) + at, text) for at, text in enumerate(pair)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted((False, r.doc_id) for r in simhash.drop_near_duplicates(docs).collect()) == kept_plainly(rows) == [(False, 0), (False, 2)]


def test_pairs_come_in_bounded_parts():
    group, values = np.zeros(3000, dtype=np.int64), np.zeros(3000, dtype="<u8")
    parts = [len(i) for i, _, _ in pairs_within(group, values, 22, most=100)]
    assert sum(parts) == 3000 * 2999 // 2 and max(parts) <= 64 * (100 + 47)
