"""Benchmark decontamination: a prefix-filtered join of item windows with documents, in DataFrame operations only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.shared import staged

_ID, _KEY = "__item_id", "__item_key"


def words_of(text: str) -> Column:
    """The runs of digits, letters a-z (A-Z lower-cased) and characters outside ASCII."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    plain = F.length(whole) == F.octet_length(whole)
    lowered = F.when(plain, F.lower(whole)).otherwise(F.translate(whole, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), "")


def keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """`docs` with two columns that tell its rows apart: the id without nulls, and a hash of id and text."""
    bare = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return docs.withColumns({_ID: bare, _KEY: F.xxhash64(bare, F.col(id_column).isNull(), text_column)})


def item_windows(items: DataFrame, window: int, item_column: str, text_column: str) -> DataFrame:
    """(item, size, window): the distinct runs of `window` words of each item, as text; a shorter item is one run."""
    words = items.where(F.col(item_column).isNotNull()).select(
        F.col(item_column).alias("item"), words_of(text_column).alias("words")
    )
    size = F.least(F.lit(window), F.size("words"))
    cut = words.where(F.size("words") > 0).select(
        "item", "words", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("start")
    )
    text = F.array_join(F.slice("words", F.col("start") + 1, F.col("size")), " ")
    return cut.select("item", "size", text.alias("window")).distinct()


def prefix_tokens(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """(token, offset, size, window): the rarest word of each window over all documents (id, key, words), and its place.

    All words of a window must occur in a row, so its prefix in order of rarity need only have one word. Windows with a
    word that no document has cannot occur and are left out.
    """
    places = windows.select("size", "window").distinct().select(
        "size", "window", F.posexplode(F.split("window", " ", -1)).alias("offset", "word")
    )
    vocabulary = staged(places.select("word").distinct(), "vocabulary")  # of known size, so a small one is broadcast
    counts = (
        docs.select(F.explode("words").alias("word"))
        .join(vocabulary, "word", "left_semi")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rarest = (
        places.join(counts, "word", "left")
        .groupBy("window", "size")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "offset")).alias("rarest"))
    )
    return rarest.where("rarest.n > 0").select(
        F.col("rarest.word").alias("token"), F.col("rarest.offset").alias("offset"), "size", "window"
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 13,
    share: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Per row of `docs`: the id, row keys, n_words, n_hit, n_items, items (their ids as sorted strings), contaminated.

    A word is hit if it lies in an occurrence of a run of `window` words of an item (of the whole item if that is shorter). A
    document is contaminated if at least one in `share` of its words is hit. Documents meet windows on the rarest word of each
    window alone; the place of the word bounds where the window must start and end, and the words there are compared exactly.
    Benchmark tables are joined by size: Spark broadcasts small ones and shuffles others.

    Null and empty texts have no words and are never hit. Repeated rows each get their result, rows that share an id but not the text
    are judged apart. Items without id or words, and repeated items, add nothing. Other columns are not read. No items: no hits.
    """
    texts = keyed(docs.select(id_column, text_column), id_column, text_column)
    words = words_of(text_column).alias("words")
    rows = texts.select(_ID, _KEY, words)
    windows = staged(item_windows(items, window, item_column, item_text), "windows")
    tokens = staged(prefix_tokens(windows, rows), "tokens")
    start = F.col("place") - F.col("offset")
    candidates = (
        rows.select(_ID, _KEY, F.size("words").alias("n"), F.posexplode("words").alias("place", "token"))
        .join(tokens, "token")
        .where((start >= 0) & (start + F.col("size") <= F.col("n")))
        .groupBy(_ID, _KEY)
        .agg(F.collect_set(F.struct(start.alias("start"), "size", "window")).alias("candidates"))
    )
    found = F.filter(
        F.coalesce("candidates", F.array()),
        lambda c: F.array_join(F.slice("words", c["start"] + 1, c["size"]), " ") == c["window"],
    )
    judged = staged(
        texts.join(candidates, [_ID, _KEY], "left")  # the text is shuffled, not its words one by one
        .select(id_column, _ID, _KEY, words, "candidates")
        .select(id_column, _ID, _KEY, F.size("words").cast("bigint").alias("n_words"), F.array_sort(found).alias("found")),
        "judged",
    )
    covered = F.aggregate(
        "found",
        F.struct(F.lit(0).cast("bigint").alias("hit"), F.lit(0).alias("end")),
        lambda acc, c: F.struct(
            (acc["hit"] + F.greatest(F.lit(0), c["start"] + c["size"] - F.greatest(c["start"], acc["end"]))).alias("hit"),
            F.greatest(acc["end"], c["start"] + c["size"]).alias("end"),
        ),
        lambda acc: acc["hit"],
    )
    named = (
        judged.select(_ID, _KEY, F.explode(F.array_distinct(F.transform("found", lambda c: c["window"]))).alias("window"))
        .join(windows.select("window", "item"), "window")
        .groupBy(_ID, _KEY)
        .agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    )
    n_hit = covered.alias("n_hit")
    return (
        judged.select(id_column, _ID, _KEY, "n_words", n_hit)
        .join(named, [_ID, _KEY], "left")
        .select(
            id_column,
            _ID,
            _KEY,
            "n_words",
            "n_hit",
            F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"),
        )
    )


def without_contaminated(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of `docs` that are not contaminated, with all their columns."""
    judged = contamination(docs, items, id_column=id_column, text_column=text_column, **options)
    bad = judged.where("contaminated").select(_ID, _KEY).distinct()
    return keyed(docs, id_column, text_column).join(bad, [_ID, _KEY], "left_anti").select(docs.columns)
