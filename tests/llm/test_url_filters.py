from __future__ import annotations

import random

import pytest

from ordermill.llm.components import connected_components
from ordermill.llm.registry import RULES, op5_url_filters
from ordermill.llm.url_filters import judge, page_links


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def rule_for(url, rules):
    host, path = parts(url)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: (len(r[0] + r[1]), r[2] == "allow"), default=None)


def plainly(pages, links, rules):
    """Rows (id, url) and links between urls that are already written alike."""
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a and b:
            parent[find(a)] = find(b)
    groups = {}
    for node in list(parent):
        rule = rule_for(node, rules)
        if rule:
            groups.setdefault(find(node), set()).add(rule[2])
    out = []
    for key, url in pages:
        rule = rule_for(url, rules)
        by_alias = groups.get(find(url), set()) if url in parent else set()
        verdict = rule[2] if rule else "allow" if "allow" in by_alias else "block" if by_alias else "allow"
        out.append((key, *parts(url), rule and rule[0] + rule[1], verdict))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark, small):
    pages = [(r.page_id, r.url) for r in spark.read.parquet(f"{small}/pages.parquet").collect()]
    got = op5_url_filters(spark, small)
    assert sorted(map(tuple, got.collect()), key=str) == plainly(pages, [], RULES)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_aliases_share_decisions(spark):
    rng = random.Random(8)
    hosts = ["a.example.org", "b.example.org", "x.net", "example.com", "sub.example.com", "WWW.Free.org", "other.io"]
    urls = sorted({f"http://{rng.choice(hosts)}/{rng.choice(['de', 'fr', 'en'])}/{rng.randrange(12)}" for _ in range(150)})
    links = [(rng.choice(urls), rng.choice(urls)) for _ in range(60)] + [(f"http://chain.io/{i}", f"http://chain.io/{i + 1}") for i in range(40)]
    links += [("http://chain.io/40", "http://x.net/"), (None, urls[0]), (urls[1], urls[1])]
    pages = [(i, url) for i, url in enumerate([*urls, "http://chain.io/0", None, "", "no scheme", "http://", "http://x.net?q", "a://b://c", urls[0]])]
    table = spark.createDataFrame([(*p, "h") for p in pages], "page_id int, url string, host string")
    edges = spark.createDataFrame(links, "source string, target string")
    got = judge(table, edges, RULES)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    found = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()}
    # a last slash does not tell addresses apart
    plain = plainly([(k, u) for k, u in pages], [(a, b) for a, b in links], RULES)
    assert found == set(plain) and ("block" in {v for *_, v in plain})
    assert {r.verdict for r in judge(table.where("url like '%chain%'"), edges, RULES).collect()} == {"block"}
    assert judge(table.limit(0), edges, RULES).count() == 0
    assert judge(table, edges.limit(0), RULES, default="block").where("rule is null").select("verdict").distinct().collect()[0][0] == "block"


def test_links_in_pages(spark):
    rows = [
        ("http://a.org/x/y?z", '<LINK href="https://b.org/1?a=1&amp;b=2" rel="canonical">'),
        ("https://a.org/x/y", "<link rel=canonical href=/root><meta content='0; url=next' http-equiv='refresh'>"),
        ("https://a.org", "<meta http-equiv=refresh content='3;URL=//c.org/'>"),
        ("no scheme", "<link rel=canonical href=/root>"),
        (None, "<link rel=canonical href=/root>"),
        ("http://d.org/", None),
        ("http://e.org/", "<link rel='stylesheet' href='/css'>"),
    ]
    got = page_links(spark.createDataFrame(rows, "url string, html string")).collect()
    assert sorted((r.source, r.target) for r in got) == [
        ("http://a.org/x/y?z", "https://b.org/1?a=1&b=2"),
        ("https://a.org", "https://c.org/"),
        ("https://a.org/x/y", "https://a.org/root"),
        ("https://a.org/x/y", "https://a.org/x/next"),
    ]


@pytest.mark.parametrize("shape", ["path", "star", "random", "empty"])
def test_components(spark, shape):
    rng = random.Random(6)
    links = {
        "path": [(i, i + 1) for i in range(100)],
        "star": [(50, i) for i in range(100)],
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(150)],
        "empty": [],
    }[shape]
    parent = list(range(201))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = connected_components(spark.createDataFrame(links, "a int, b int"), "a", "b").collect()
    assert {r.node: r.root for r in got} == {x: find(x) for x in range(201) if find(x) != x} and len(got) == len({r.node for r in got})


def test_columns_of_any_name_stay(spark):
    names = ["alias_verdict", "_node", "_url", "_own_node", "node", "root", "verdict", "host"]
    pages = spark.createDataFrame([("https://a.net/x", *range(len(names)))], "url string, " + ", ".join(f"{name} int" for name in names))
    links = spark.createDataFrame([("https://a.net/x", "https://b.com/y")], "source string, target string")
    row = judge(pages, links, [("b.com", "/", "block")]).collect()[0]
    assert (row.verdict, row.host, row.alias_verdict, row._node, row.root) == ("block", "a.net", 0, 1, 5)
