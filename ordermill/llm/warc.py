"""Web archive records: not-modified revisits resolved to the full response they stand for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.shared import staged

from ordermill.llm.url_filters import node_of

#: Headers that a 304 answer may carry for the stored response (HTTP semantics, status code 304).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: The time of one group in a url's row of captures.
SPAN_SECONDS = 86_400


def canonical_url(url: Column) -> Column:
    """One name per address: no scheme, default port, fragment or last slash, no utm_ parameters, host in lower case; null without a host."""
    node = node_of(url)
    bare = F.regexp_replace(node, r"(?<=[?&])utm_[^&]*&?", "")
    return F.regexp_replace(bare, r"[?&]\z", "")


def normal_headers(headers: Column) -> Column:
    """Header names in lower case; of names that differ in case only, the one in most lower case stays (the last in byte order). Null counts as none."""
    entries = F.transform(
        F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
    )
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(last)


def _weak(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), r"\AW/", "")


def validators_agree(response: Column, revisit: Column) -> Column:
    """Entity tags decide (compared weakly) if the revisit has one, else last-modified dates; without either nothing is proven."""
    tag, date = _weak(revisit["etag"]), F.trim(revisit["last-modified"])
    same_tag = F.coalesce(tag == _weak(response["etag"]), F.lit(False))
    same_date = F.coalesce(date == F.trim(response["last-modified"]), F.lit(False))
    return F.when(tag.isNotNull(), same_tag).otherwise(same_date)


def latest_responses(records: DataFrame, span_seconds: int = SPAN_SECONDS) -> DataFrame:
    """(revisit, response): for each revisit among rows (record_id, key, at, full) the latest earlier full response of its key.

    Earlier means an earlier time, or the same time and a smaller record id. The captures are dealt out by ranges of key, time and id, and a key's
    are cut into spans where a range ends or a span of time does: inside a span a window looks back, across spans the last response of each span is handed
    on. So a key of very many captures is many groups, also where all of them are of one day or without a time.
    """
    dealt = records.repartitionByRange("key", "at", "record_id")
    rows = staged(dealt.withColumn("span", F.struct(F.floor(F.col("at") / span_seconds).alias("time"), F.spark_partition_id().alias("range"))), "spans")
    found = F.when(F.col("full"), F.struct("at", "record_id"))
    back = Window.partitionBy("key", "span").orderBy("at", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("near", F.last(found, ignorenulls=True).over(back)).where(~F.col("full"))
    spans = rows.groupBy("key", "span").agg(F.max(found).alias("last"))
    before = Window.partitionBy("key").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    handed = spans.select("key", "span", F.last("last", ignorenulls=True).over(before).alias("far"))
    return inside.join(handed, ["key", "span"]).select(
        F.col("record_id").alias("revisit"), F.coalesce("near.record_id", "far.record_id").alias("response")
    )


def resolve(records: DataFrame, permitted: Sequence[str] = PERMITTED, span_seconds: int = SPAN_SECONDS) -> DataFrame:
    """The revisits among `records` with what they stand for.

    Records have record_id, url, captured_at (seconds), status, headers (map), payload. Status 200 with a payload is a full
    response, 304 a revisit; others take no part. Result: record_id, url, captured_at, response_id (null if there is none),
    outcome (`resolved`, `changed` if the validators disagree or prove nothing, `missing`), and, of resolved ones, headers (those of the
    response, with the permitted ones of the revisit over them) and payload.

    Urls are compared in canonical form. Only ids, keys and times go through the as-of join; headers and payloads join
    once, by record id, where Spark may split a response of very many revisits. Null urls, and such without a host, have no response. Null times
    count as the earliest. Record ids tell the records apart: of rows that repeat one, null included, one counts. Other columns are not read; an empty table gives no
    rows.
    """
    full = (F.col("status") == 200) & F.col("payload").isNotNull()
    rows = records.where(full | (F.col("status") == 304)).select(
        "record_id",
        canonical_url(F.col("url")).alias("key"),
        F.coalesce(F.col("captured_at").cast("bigint"), F.lit(-(1 << 62))).alias("at"),
        F.coalesce(full, F.lit(False)).alias("full"),
    )
    links = latest_responses(rows.where(F.col("key").isNotNull()).distinct(), span_seconds)
    revisits = records.where(F.col("status") == 304).dropDuplicates(["record_id"]).select(
        "record_id", "url", "captured_at", normal_headers(F.col("headers")).alias("own")
    )
    responses = records.where(full).dropDuplicates(["record_id"]).select(
        F.col("record_id").alias("response_id"), normal_headers(F.col("headers")).alias("theirs"), F.col("payload").alias("body")
    )
    linked = revisits.join(links, F.col("record_id") == F.col("revisit"), "left").withColumnRenamed("response", "response_id")
    # Revisits without a response, however many, are spread: they find nothing anyway.
    spread = F.when(F.col("response_id").isNull(), F.pmod(F.xxhash64("record_id"), F.lit(4096))).otherwise(0).cast("bigint")
    joined = linked.withColumn("part", spread).join(responses.withColumn("part", F.lit(0).cast("bigint")), ["response_id", "part"], "left")
    resolved = F.col("theirs").isNotNull() & validators_agree(F.col("theirs"), F.col("own"))
    over = F.map_filter("own", lambda name, _: name.isin(*permitted))
    merged = F.map_concat(F.map_filter("theirs", lambda name, _: ~F.map_contains_key(over, name)), over)
    return joined.select(
        "record_id",
        "url",
        "captured_at",
        "response_id",
        F.when(F.col("response_id").isNull(), "missing").when(resolved, "resolved").otherwise("changed").alias("outcome"),
        F.when(resolved, merged).alias("headers"),
        F.when(resolved, F.col("body")).alias("payload"),
    )


def archive_of(pages: DataFrame) -> DataFrame:
    """Records as a crawl of `pages` would have left them: each page a full response, an hour after the page before, and revisits.

    Every page is asked again after one to five days: a third with a weak entity tag, a fifth by date alone, a seventh has changed, an eleventh
    proves nothing. Every thirteenth also has a revisit from long before.
    """
    page, digest = F.col("page_id"), F.md5(F.coalesce("html", F.lit("")).cast("binary"))
    tag = F.concat(F.lit('"'), digest, F.lit('"'))
    date = F.concat(F.lit("day "), page.cast("string"))
    asked = page * 3600 + (1 + page % 5) * 86400
    stored = F.create_map(
        F.lit("ETag"), tag, F.lit("Last-Modified"), date, F.lit("Content-Type"), F.lit("text/html"), F.lit("Date"), date,
        F.lit("Content-Length"), F.octet_length(F.coalesce("html", F.lit(""))).cast("string"),
    )
    sent = F.when(page % 7 == 0, F.lit('"changed"')).when(page % 3 == 0, F.concat(F.lit("W/"), tag)).otherwise(tag)
    proof = (
        F.when(page % 11 == 0, F.create_map(F.lit("Server"), F.lit("s")))
        .when(page % 5 == 0, F.create_map(F.lit("Last-Modified"), date))
        .otherwise(F.create_map(F.lit("ETag"), sent))
    )
    answer = F.map_concat(
        proof,
        F.create_map(
            F.lit("date"), F.concat(F.lit("asked "), asked.cast("string")), F.lit("Expires"), F.lit("soon"), F.lit("content-length"), F.lit("0"),
        ),
    )
    none = F.lit(None).cast("string")

    def record(number: int, at: Column, status: int, headers: Column, payload: Column) -> Column:
        return F.struct(
            (page * 3 + number).alias("record_id"), "url", at.alias("captured_at"), F.lit(status).alias("status"),
            headers.alias("headers"), payload.alias("payload"),
        )

    early = F.when(page % 13 == 0, record(2, page - 10**7, 304, answer, none))
    made = F.array(record(0, page * 3600, 200, stored, F.col("html")), record(1, asked, 304, answer, none), early)
    return pages.select(F.explode(F.array_compact(made)).alias("record")).select("record.*")
