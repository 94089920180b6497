from __future__ import annotations

import random

import pytest

from ordermill.llm import warc
from ordermill.llm.registry import op2_warc


def plainly(records):
    """Rows (record_id, url key, time, status, headers, payload) with unique ids and keys already canonical."""
    out = []
    for rid, key, at, status, headers, _ in records:
        if status != 304:
            continue
        place = (-(1 << 62) if at is None else at, rid)
        earlier = [
            ((-(1 << 62) if t is None else t, i), h, p)
            for i, k, t, s, h, p in records
            if s == 200 and p is not None and k == key and k is not None and (-(1 << 62) if t is None else t, i) < place
        ]
        if not earlier:
            out.append((rid, None, "missing", None, None))
            continue
        (_, response), theirs, payload = max(earlier, key=lambda r: r[0])
        theirs, own = ({k.lower(): v for k, v in (h or {}).items()} for h in (theirs, headers))

        def bare(tag):
            return tag.strip().removeprefix("W/") if tag is not None else None

        if own.get("etag") is not None:
            same = bare(own["etag"]) == bare(theirs.get("etag"))
        else:
            same = own.get("last-modified") is not None and own["last-modified"] == theirs.get("last-modified")
        merged = theirs | {k: v for k, v in own.items() if k in warc.PERMITTED}
        out.append((rid, response, "resolved", merged, payload) if same else (rid, response, "changed", None, None))
    return sorted(out, key=lambda r: r[0])


def found(df):
    return sorted(((r.record_id, r.response_id, r.outcome, r.headers, r.payload) for r in df.collect()), key=lambda r: r[0])


SCHEMA = "record_id bigint, url string, captured_at bigint, status int, headers map<string,string>, payload string, key string"


@pytest.mark.parametrize("span", [1, 7, 86_400])
def test_equals_brute_force(spark, span):
    rng = random.Random(span)
    rows = []
    for rid in range(400):
        key = rng.choice(["hot.org/"] * 5 + [f"a.org/{i}" for i in range(20)]).rstrip("/")
        status = rng.choice([200, 200, 304, 304, 404])
        headers = {name: rng.choice(['"1"', 'W/"1"', '"2"']) for name in ("ETag", "Last-Modified", "Date", "X") if rng.random() < 0.6}
        rows.append((rid, key, rng.choice([None, *range(60)]), status, headers or None, rng.choice([None, "body", ""])))
    df = spark.createDataFrame([(i, f"HTTP://{k}/#x" if i % 2 else f"https://{k}?utm_a=1", *r, "k") for i, k, *r in rows], SCHEMA)
    assert found(warc.resolve(df, span_seconds=span)) == plainly(rows)


def test_query_equals_brute_force(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    records = warc.archive_of(pages).withColumn("url", warc.canonical_url(warc.F.col("url")))
    expected = plainly([tuple(r) for r in records.collect()])
    got = {r.record_id: r for r in op2_warc(spark, small).collect()}
    assert [(rid, got[rid].response_id, got[rid].outcome) for rid, *_ in expected] == [r[:3] for r in expected] and len(got) == len(expected)
    assert {r[2] for r in expected} == {"missing", "resolved", "changed"}
    for rid, _, outcome, headers, _ in expected:
        lines = "\n".join(f"{k}: {v}" for k, v in sorted(headers.items())) if outcome == "resolved" else None
        assert got[rid].headers == lines


def test_canonical_urls(spark):
    urls = ["http://A.org:80/x/?utm_s=1&b=2&utm_t=3#f", "https://a.org/x?b=2", None, "none", "http://a.org/?utm_a=b"]
    df = spark.createDataFrame([(u,) for u in urls], "url string").select(warc.canonical_url(warc.F.col("url")).alias("k"))
    assert [r.k for r in df.collect()] == ["a.org/x?b=2", "a.org/x?b=2", None, None, "a.org"]


def test_odd_rows(spark):
    body = "x" * 300_000
    rows = [(1, "http://a.org", 5, 200, {"etag": "2", "ETag": "1"}, body, ""), (2, "http://a.org", 5, 304, {"ETAG": " 2"}, None, "")] * 2
    rows += [(3, None, 9, 304, None, None, None), (4, "http://a.org", None, 304, None, None, None), (5, "http://a.org", 9, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [(r[0], r[1], r[2], r[4]) for r in found(warc.resolve(df))] == [(2, 1, "resolved", body), (3, None, "missing", None), (4, None, "missing", None)]
    assert warc.resolve(df.limit(0)).count() == 0


def test_a_key_of_very_many_captures_in_a_day(spark, monkeypatch):
    records = spark.range(20_000).selectExpr("id AS record_id", "'net,a)/x' AS key", "CAST(id DIV 50 AS bigint) AS at", "id % 100 = 0 AS full")
    found = warc.latest_responses(records)
    assert found.count() == 19_800
    assert found.where("response <> revisit - revisit % 100 OR response IS NULL").count() == 0
    staged_rows = []
    plain = warc.staged

    def seen(df, name):
        staged_rows.append(plain(df, name))
        return staged_rows[-1]

    monkeypatch.setattr(warc, "staged", seen)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # few rows here would be one range
    try:
        again = warc.latest_responses(records)
        assert again.where("response = revisit - revisit % 100").count() == 19_800
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [row["count"] for row in staged_rows[0].groupBy("span").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 20_000 * 0.6
