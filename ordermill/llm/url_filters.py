"""URL filters: rules by host and path, carried over to aliases by redirects and canonical links. DataFrame operations only."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.components import connected_components
from ordermill.llm.shared import staged

Rule = tuple[str, str, str]  # host, path, verdict (allow or block)


def host_of(url: Column) -> Column:
    """What stands after the first :// up to / ? # or the end, A-Z lower-cased; empty for null and without ://."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(name, verdict) of the longest rule that fits the host or a subdomain and starts the path, else null; allow wins a tie.

    Rules are settings, a list of some hundreds at most, and become part of the expression.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[2] != "allow", r))
    fits = [
        F.when(
            ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path),
            F.struct(F.lit(rule_host + rule_path).alias("name"), F.lit(verdict).alias("verdict")),
        )
        for rule_host, rule_path, verdict in ordered
    ]
    return F.coalesce(*fits, F.lit(None).cast("struct<name:string,verdict:string>"))


def node_of(url: Column) -> Column:
    """One name for spellings of one address: scheme, default port, fragment and a last slash do not count; null without a host."""
    rest = F.regexp_replace(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^#]*)", 1), r"/(?=\?|\z)", "")
    host = F.regexp_replace(host_of(url), r":(80|443)?\z", "")
    return F.when(host != "", F.concat(host, rest))


def page_links(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(source, target): addresses that pages name as their canonical one or as where they redirect to."""
    url, html = F.col(url_column), F.col(html_column)
    canonical = F.regexp_extract(html, r"""(?is)<link\b[^>]*?\brel\s*=\s*["']?canonical\b[^>]*>""", 0)
    refresh = F.regexp_extract(html, r"""(?is)<meta\b[^>]*?\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>""", 0)
    targets = F.array(
        F.regexp_extract(canonical, r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)""", 1),
        F.regexp_extract(refresh, r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)""", 1),
    )
    target = F.replace(F.col("target"), F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract(F.col("source"), r"(?s)\A(.*?)://", 1)
    origin = F.concat(scheme, F.lit("://"), host_of(F.col("source")))
    folder = F.regexp_replace(path_of(F.col("source")), r"[^/]*\z", "")
    resolved = (
        F.when(target.contains("://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(origin, target))
        .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), target))
    )
    return (
        pages.where(url.contains("://"))
        .select(url.alias("source"), F.explode(targets).alias("target"))
        .where("target <> ''")
        .select("source", resolved.alias("target"))
    )


#: Names that no column of pages has.
_ALIAS, _NODE, _URL, _OWN = (f"__judge_{name}" for name in ("alias", "node", "url", "own"))


def judge(
    pages: DataFrame, links: DataFrame, rules: Sequence[Rule], url_column: str = "url", default: str = "allow"
) -> DataFrame:
    """`pages` with four columns more: host, path, rule, verdict.

    A page has the verdict of its longest fitting rule. Without one it has that of its aliases, the addresses connected with
    its own by `links` (source, target), whether pages or not: allow if a rule allows one of them, else block if a rule blocks one,
    else the default. Components are found by distributed rounds of joins; nothing is gathered.

    A null url and one without :// have empty host and path, no rule and no aliases. Null ends and loops of links say nothing.
    Repeated rows each get their verdict; the new columns replace such of the same names. Other columns stay, whatever their names, but
    for `__judge_...`.
    """
    url = F.col(url_column)
    ends = links.select(F.explode(F.array("source", "target")).alias("url")).select(
        node_of(F.col("url")).alias("node"), rule_of(host_of(F.col("url")), path_of(F.col("url")), rules)["verdict"].alias("verdict")
    )
    decided = staged(ends.where(F.col("verdict").isNotNull() & F.col("node").isNotNull()).distinct(), "decided")
    edges = links.select(node_of(F.col("source")).alias("source"), node_of(F.col("target")).alias("target"))
    roots = connected_components(edges, "source", "target")
    members = roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()
    verdicts = (
        members.join(decided, "node")
        .groupBy("root")
        .agg(F.min("verdict").alias(_ALIAS))  # allow comes before block
        .join(members, "root")
        .select(F.col("node").alias(_NODE), _ALIAS)
    )
    kept = [name for name in pages.columns if name not in ("host", "path", "rule", "verdict")]
    own = F.struct(host_of(url).alias("host"), path_of(url).alias("path")).alias(_URL)
    rows = pages.select(*kept, own, node_of(url).alias(_OWN))
    rule = rule_of(F.col(_URL)["host"], F.col(_URL)["path"], rules)
    return rows.join(verdicts, F.col(_OWN) == F.col(_NODE), "left").select(
        *kept,
        F.col(_URL)["host"].alias("host"),
        F.col(_URL)["path"].alias("path"),
        rule["name"].alias("rule"),
        F.coalesce(rule["verdict"], _ALIAS, F.lit(default)).alias("verdict"),
    )
