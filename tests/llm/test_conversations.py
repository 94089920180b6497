from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ordermill.llm import conversations
from ordermill.llm.conversations import damaged, repair, repaired_rows, structure
from ordermill.llm.edit_costs import EditCosts, row_code
from ordermill.llm.registry import op12_conversations

LEGAL = re.compile("(s?(ua)+)?")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def cheapest(rows):
    """(cost, audit) by trying every edit of every row and up to two inserts in every gap; rows are (initial, truncated, gone)."""
    per_row = []
    for initial, truncated, gone in rows:
        kept = [] if gone else [("K", 5 * truncated, initial), ("R", 1 + 5 * truncated, "u"), ("R", 1 + 5 * truncated, "a")]
        per_row.append([("D", 2, ""), *kept])
    gaps = [("I" * len(put), 5 * len(put), put) for put in ("", "u", "a", "ua", "au")]
    slots = [gaps]
    for choices in per_row:
        slots += [choices, gaps]
    found = []
    for choice in product(*slots):
        if LEGAL.fullmatch("".join(part[2] for part in choice)):
            found.append((sum(part[1] for part in choice), "".join(part[0] for part in choice)))
    return min(found)


@settings(deadline=None, max_examples=40)
@given(st.lists(st.tuples(st.sampled_from("suax"), st.booleans(), st.booleans()), max_size=3))
def test_edits_are_the_least_of_all(rows):
    assert EditCosts().edits(bytes(row_code(*row) for row in rows)) == cheapest(rows)


def forward(rows):
    """(cost, audit) by a plain forward program that carries whole strings."""
    goes = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    put = "uuau"

    def inserted(best):
        for _ in range(4):
            for state in list(best):
                to = goes[state, put[state]]
                new = (best[state][0] + 5, best[state][1] + "I")
                best[to] = min(best.get(to, new), new)
        return best

    best = inserted({0: (0, "")})
    for initial, truncated, gone in rows:
        after = {}
        for state, (cost, audit) in best.items():
            moves = [("D", 2, state)]
            if not gone:
                moves += [("K", 5 * truncated, goes[state, initial])] if (state, initial) in goes else []
                moves += [("R", 1 + 5 * truncated, goes[state, put[state]])]
            for letter, extra, to in moves:
                new = (cost + extra, audit + letter)
                after[to] = min(after.get(to, new), new)
        best = inserted(after)
    return min(best[state] for state in (0, 3) if state in best)


@settings(deadline=None, max_examples=100)
@given(st.lists(st.tuples(st.sampled_from("suax"), st.booleans(), st.booleans()), max_size=60))
def test_long_edits_equal_the_forward_program(rows):
    assert EditCosts().edits(bytes(row_code(*row) for row in rows)) == forward(rows)


def faulty(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def plain(rows):
    result, after = {}, faulty(rows)
    for conv in {row[0] for row in rows}:
        own = [row for row in after if row[0] == conv]
        name = "" if conv is None else f"={conv}"
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(f"{len(name)}:{name}{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()))
        seen, faults, counts = set(), [], [0, 0, 0]
        for _, _, role, text in own:
            end = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 0 if not end else 1 if (role, text) in seen else 2 if end[-1] not in ".!?" else None
            seen.add((role, text))
            faults.append(fault)
            if fault is not None:
                counts[fault] += 1
        turns = {turn for _, turn, _, _ in own if turn is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, audit = forward([(r[2][:1], f == 2, f in (0, 1)) for r, f in zip(own, faults, strict=True)])
        lines, at, previous = [], 0, None
        for letter in audit:
            put = "assistant" if previous == "u" else "user"
            if letter == "I":
                lines.append(f"{put}:")
            if letter in "KR":
                lines.append(f"{own[at][2] if letter == 'K' else put}:{own[at][3]}")
            at += letter != "I"
            previous = lines[-1][0] if lines else None
        result[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return result


def figures(df):
    return {row["conv_id"]: tuple(row[1:]) for row in df.collect()}


ODD = [
    *[(1, t, "user" if t % 2 else "assistant", f"Text {t}.") for t in range(40)],
    *[(2, t, ["system", "user", "tool", None, ""][t % 5], ["Yes!", None, "", "no", " \t\x0b"][t % 4]) for t in range(30)],
    *[(3, None, "user", "Same."), (3, None, "user", "Same."), (3, 0, "user", "Same."), (3, -4, "assistant", "é…")],
    *[(None, t, "user", "Hello?") for t in (5, 5, 9)],
    *[(4, 7, "assistant", "x" * 50_000 + ". "), (4, 7, "assistant", "end. Not")],
    *[(k, 0, "user", "alone.") for k in range(100, 160)],
]


def test_odd_conversations_equal_the_plain_version(spark, monkeypatch):
    df = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    assert figures(repair(damaged(df), copies="copies")) == plain(ODD)


def test_blocks_of_a_conversation_over_many_tasks(spark):
    rows = [(1, t // 2, ["user", "assistant", "system"][t % 3], f"Text {t % 500}" + "." * (t % 7 > 0)) for t in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert figures(repair(damaged(df), copies="copies")) == plain(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_given_conversations(spark, small):
    rows = [tuple(row) for row in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert figures(op12_conversations(spark, small)) == plain(rows)


def test_repaired_rows_are_what_the_digest_is_of(spark):
    df = damaged(spark.createDataFrame(ODD, SCHEMA))
    lines: dict = {}
    for row in sorted(repaired_rows(df, copies="copies").collect(), key=lambda r: r.place):
        lines.setdefault(row.conv_id, []).append(f"{row.role}:{row.text}")
    expected = plain(ODD)
    got = {conv: hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() for conv in expected}
    assert got == {conv: value[-1] for conv, value in expected.items()}


def test_clashing_columns_and_empty_tables(spark):
    names = ["conv", "kind", "digest", "timed", "copy", "n", "first", "seen", "audit", "place", "copies_", "blank"]
    schema = "conv_id string, turn int, role string, text string, " + ", ".join(f"{name} int" for name in names)
    df = spark.createDataFrame([("x", 1, "user", "Hi.", *[3] * len(names))], schema)
    assert structure(df).collect()[0].audit == "D"
    assert [tuple(row) for row in repaired_rows(df).collect()] == []
    assert repair(df.limit(0)).count() == structure(df.limit(0)).count() == repaired_rows(df.limit(0)).count() == 0


@pytest.mark.parametrize("most", [1, 7])
def test_small_blocks(spark, most, monkeypatch):
    plain_blocks = conversations._blocks
    monkeypatch.setattr(conversations, "_blocks", lambda batches: plain_blocks(batches, most))
    assert figures(repair(damaged(spark.createDataFrame(ODD, SCHEMA)), copies="copies")) == plain(ODD)
