from __future__ import annotations

import hashlib
import random
import re

from ordermill.llm.decontamination import contamination, without_contaminated
from ordermill.llm.registry import op7_decontamination


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def plainly(rows, items):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if w and item is not None else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add(str(item))
    out = []
    for doc, text in rows:
        w, hit, names = words(text), set(), set()
        for k in {len(window) for window in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit.update(range(i, i + k))
                    names |= windows[tuple(w[i : i + k])]
        out.append((doc, len(w), len(hit), len(names), ",".join(sorted(names)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark, small):
    rows, items = (
        [(r[0], r.text) for r in spark.read.parquet(f"{small}/{name}.parquet").select(key, "text").collect()]
        for name, key in (("documents", "doc_id"), ("benchmark", "item_id"))
    )
    expected = [(*r[:4], hashlib.sha256(r[4].encode()).hexdigest(), r[5]) for r in plainly(rows, items)]
    got = op7_decontamination(spark, small)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    assert "Python" not in got._jdf.queryExecution().toString() and "Arrow" not in got._jdf.queryExecution().toString()


def test_odd_rows(spark):
    rng = random.Random(2)
    vocabulary = ["the", "of", "é", "Zug", "x1", "and"]
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    items = [(1, passage), (1, passage), (2, "Short item"), (3, ""), (4, None), (None, "and of"), (10, passage + " end"), (7, "the")]
    filler = " ".join(f"w{i}" for i in range(2000))
    rows = [(None, passage), (1, None), (2, ""), (3, "?!"), (4, passage.upper().replace("É", "é")), (4, "SHORT, item!"), (5, filler + " the"), (6, "the " * 500)]
    rows += [(7, f"{filler} {passage} {filler}"), (8, f"x {passage[:60]} y"), (9, "É Short-Item"), (9, "É Short-Item"), (11, "w " * 60_000)]
    docs = spark.createDataFrame([(*r, 1, "t") for r in rows], "doc_id bigint, text string, item_id int, window string")
    table = spark.createDataFrame([(*r, 1) for r in items], "item_id bigint, text string, doc_id int")
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in contamination(docs, table).collect()]
    assert sorted(got, key=str) == plainly(rows, items)
    kept = without_contaminated(docs, table)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in plainly(rows, items) if not r[5])
    assert contamination(docs.limit(0), table).count() == 0
    assert {r.n_hit for r in contamination(docs, table.limit(0)).collect()} == {0}
