"""The queries of this subpackage, by name, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import chunking, conversations, decontamination, filter_audit, main_text, mixing, oracles, packing, quality, simhash, substrings, token_files, url_filters, warc

Query = Callable[[SparkSession, str], DataFrame]


#: The rules of op5_url_filters: host, path, verdict.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table. Python workers on the driver's machine then find this package where the driver found it."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), tokenizer())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.resolve(warc.archive_of(table(spark, folder, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.select(
        "record_id",
        "response_id",
        "outcome",
        F.array_join(lines, "\n").alias("headers"),
        F.md5(F.col("payload").cast("binary")).alias("payload_md5"),
    )


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = main_text.extract(table(spark, folder, "pages").select("page_id", "url", F.col("html").alias("text")), "text")
    return pages.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op5_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    judged = url_filters.judge(pages.select("page_id", "url"), url_filters.page_links(pages), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_substrings(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.without_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = token_files.write(table(spark, folder, "documents"), tokenizer())
    found = token_files.read(files)
    return found.select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    found = chunking.fingerprints_with_next(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, folder, "labels"))
    return quality.scored(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair(conversations.damaged(table(spark, folder, "conversations")), copies="copies")


def op13_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(mixing.mix(table(spark, folder, "documents")))


def queries() -> dict[str, Query]:
    return {
        "op1_packing": op1_packing,
        "op2_warc": op2_warc,
        "op3_simhash": op3_simhash,
        "op4_main_text": op4_main_text,
        "op5_url_filters": op5_url_filters,
        "op6_substrings": op6_substrings,
        "op7_decontamination": op7_decontamination,
        "op8_token_files": op8_token_files,
        "op9_fingerprints": op9_fingerprints,
        "op10_quality": op10_quality,
        "op11_filter_audit": op11_filter_audit,
        "op12_conversations": op12_conversations,
        "op13_mixing": op13_mixing,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_warc": oracles.WARC,
        "op5_url_filters": oracles.URL_FILTERS,
        "op6_substrings": oracles.SUBSTRINGS,
        "op7_decontamination": oracles.DECONTAMINATION,
        "op11_filter_audit": oracles.FILTER_AUDIT,
        "op13_mixing": oracles.mixing(),
    }
