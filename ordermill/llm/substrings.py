"""Substring deduplication: word windows that an earlier document has, found with one FM-index per shard."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ordermill.llm.fm_index import FMIndex
from ordermill.llm.shared import as_bytes, lean

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(31))


def window_anchors(words: list[bytes], window: int, gram: int) -> np.ndarray:
    """One number per window of the words: the smallest hash among its runs of `gram` words.

    Equal windows have equal anchors wherever they stand, and neighbouring windows mostly share theirs.
    """
    count = len(words) - window + 1
    if count < 1:
        return np.array([], dtype="<u8")
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype="<u8", count=len(words))
    grams = np.zeros(len(words) - gram + 1, dtype="<u8")
    for at in range(gram):
        grams = (grams ^ hashes[at : at + len(grams)]) * _MIX[0]
        grams ^= grams >> _MIX[2]
    grams = grams * _MIX[1]
    grams ^= grams >> _MIX[2]
    width, reach = window - gram + 1, 1
    while reach < width:
        step = min(reach, width - reach)
        grams = np.minimum(grams[:-step], grams[step:])
        reach += step
    return grams


def _asked_anchors(docs: DataFrame, window: int, gram: int, crowd: int) -> DataFrame:
    """(anchor, ids, docs, crowded): the anchors of documents, rows (id, text), for a task's documents together.

    `ids` are the task's documents with the anchor. If there are over `crowd` the row says so and has the smallest id alone;
    the others then come one by one in rows without an anchor to ask for (docs = 0).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            anchor, doc = np.concatenate(anchors), np.concatenate(ids)
            order = np.lexsort((doc, anchor))
            anchor, doc = anchor[order], doc[order]
            new = np.append(True, anchor[1:] != anchor[:-1])
            other = np.append(True, doc[1:] != doc[:-1]) | new
            anchor, doc, new = anchor[other], doc[other], new[other]
            starts = np.flatnonzero(new)
            counts = np.diff(np.append(starts, len(anchor)))
            crowded = counts > crowd
            alone = np.repeat(crowded, counts) & ~new  # told without asking
            offsets = np.append(0, np.cumsum(np.where(crowded, 1, counts)))
            asked = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(doc[~alone]))
            told = pa.ListArray.from_arrays(pa.array(np.arange(alone.sum() + 1), pa.int32()), pa.array(doc[alone]))
            columns = [
                np.concatenate([anchor[starts], anchor[alone]]).view("<i8"),
                pa.concat_arrays([asked, told]),
                np.concatenate([counts, np.zeros(alone.sum(), dtype=np.int64)]),
                np.concatenate([crowded, np.ones(alone.sum(), dtype=bool)]),
            ]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "ids", "docs", "crowded"])

        for batch in batches:
            for doc, none, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), as_bytes(batch.column(1)), strict=True):
                if none:
                    continue
                found = np.unique(window_anchors(text.split(), window, gram))
                anchors.append(found)
                ids.append(np.full(len(found), doc, dtype=np.int64))
                held += len(found)
                if held > 1_000_000:
                    yield flush()
                    anchors, ids, held = [], [], 0
        if held:
            yield flush()

    return docs.mapInArrow(lean(run), "anchor bigint, ids array<bigint>, docs bigint, crowded boolean")


def _shared_anchors(asked: DataFrame, crowd: int) -> DataFrame:
    """(id, anchors, crowds): the anchors of a document that another document has too, and those of over `crowd` documents."""
    part = F.when(F.col("docs") > 0, 0).otherwise(1 + F.pmod(F.xxhash64("ids"), F.lit(1 << 20)))
    every = W.partitionBy("anchor", part)
    crowded = F.max("crowded").over(every) | (F.sum("docs").over(every) > crowd)
    return (
        asked.select("anchor", "ids", "docs", F.sum("docs").over(every).alias("total"), crowded.alias("crowded"))
        .where((F.col("docs") == 0) | (F.col("total") > 1))
        .select(F.explode("ids").alias("id"), "anchor", "crowded")
        .groupBy("id")
        .agg(F.collect_set("anchor").alias("anchors"), F.collect_set(F.when(F.col("crowded"), F.col("anchor"))).alias("crowds"))
    )


def _passages(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, content, id, row, position, n_words, words): runs of windows with one shared anchor, of rows (id, text, none, row, anchors, crowds, ...).

    The windows of crowded anchors come one by one, with their own text as the anchor. A task sends the words of equal
    passages once, for the smallest id; it knows that the larger ids have them later and sends these places without words.
    """
    names = ["anchor", "content", "id", "row", "position", "n_words", "words"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            first: dict[tuple, int] = {}
            for row in rows:
                first[row[:2]] = min(first.get(row[:2], row[2]), row[2])
            later = [first[row[:2]] != row[2] for row in rows]
            columns = list(zip(*rows, strict=True))
            columns[6] = [None if late else words for late, words in zip(later, columns[6], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            ids, nones, keys = (batch.column(k).to_pylist() for k in (0, 2, 3))
            shared, crowds = batch.column(4), batch.column(5)
            for at, text in enumerate(as_bytes(batch.column(1))):
                if nones[at]:
                    continue
                words = text.split()
                anchors = window_anchors(words, window, gram).view("<i8")
                known = np.isin(anchors, shared[at].values.to_numpy())
                single = np.isin(anchors, crowds[at].values.to_numpy())
                new = np.append(True, anchors[1:] != anchors[:-1])
                starts = np.flatnonzero(new | single) if len(anchors) else np.array([], dtype=np.int64)
                ends = np.append(starts[1:], len(anchors))
                use = known[starts]
                for start, end in zip(starts[use].tolist(), ends[use].tolist(), strict=True):
                    passage = b" ".join(words[start : end + window - 1])
                    digest = xxhash.xxh3_128_digest(passage)
                    anchor = int.from_bytes(digest[:8], signed=True) if single[start] else int(anchors[start])
                    rows.append((anchor, digest, ids[at], keys[at], start, end - start + window - 1, passage))
                    held += len(passage)
                if len(rows) > 50_000 or held > 8_000_000:
                    yield flush()
                    rows, held = [], 0
        if rows:
            yield flush()

    return docs.mapInArrow(lean(run), "anchor bigint, content binary, id bigint, row bigint, position int, n_words int, words binary")


def earlier_windows(passages: list[bytes], firsts: np.ndarray, window: int) -> list[list[tuple[int, int]]]:
    """For each passage the word spans (start, end) of windows that also stand in a passage with a smaller first document.

    The passages are one shard: they are indexed together and streamed against the index. A search goes backwards through a
    window; it ends early when only the window itself is left, else its suffix range gives the earliest document.
    """
    codes: dict[bytes, int] = {b"": 0}
    split = [passage.split(b" ") for passage in passages]
    sequences = [np.array([codes.setdefault(word, len(codes)) for word in words]) for words in split]
    lengths = np.array([len(words) + 1 for words in split])
    text = np.concatenate([part for sequence in sequences for part in (sequence, [0])])
    index = FMIndex(text, window)
    owner = np.repeat(np.arange(len(passages)), lengths)
    begins = np.cumsum(lengths) - lengths
    inside = np.arange(len(text)) - begins[owner]
    places = np.flatnonzero(inside + window < lengths[owner])
    earliest = np.append(firsts[owner[index.suffixes]], firsts.max())
    hits: list[list[tuple[int, int]]] = [[] for _ in passages]
    for at in range(0, len(places), 50_000):
        part = places[at : at + 50_000]
        low, high = index.search(text[part[:, None] + np.arange(window)], least=2)
        found = high > low
        part, low, high = part[found], low[found], high[found]
        if len(part):
            ranges, back = np.unique(np.stack([low, high], axis=1), axis=0, return_inverse=True)
            first = np.minimum.reduceat(earliest, ranges.ravel())[::2][back.ravel()]
            part = part[first < firsts[owner[part]]]
            for passage, start in zip(owner[part].tolist(), inside[part].tolist(), strict=True):
                spans = hits[passage]
                if spans and spans[-1][1] >= start:
                    spans[-1] = (spans[-1][0], start + window)
                else:
                    spans.append((start, start + window))
    return hits


def _searched(passages: DataFrame, window: int) -> DataFrame:
    """(id, row, start, end): the spans of passages that an earlier document has; the passages of an anchor meet in one shard."""

    def shard(rows: pa.Table) -> pa.RecordBatch:
        anchor, doc, key, position, n_words = (
            rows.column(name).to_numpy() for name in ("anchor", "id", "row", "position", "n_words")
        )
        content = np.frombuffer(b"".join(rows.column("content").to_pylist()), dtype="<u8").reshape(-1, 2)
        words = rows.column("words").combine_chunks()
        known = words.is_valid().to_numpy(zero_copy_only=False)
        new_anchor = np.append(True, anchor[1:] != anchor[:-1])
        entry = np.cumsum(new_anchor | np.append(True, (content[1:] != content[:-1]).any(axis=1))) - 1
        firsts = np.full(entry[-1] + 1, np.iinfo(np.int64).max)
        np.minimum.at(firsts, entry, doc)
        later = ~known | (doc > firsts[entry])
        group = np.cumsum(new_anchor) - 1
        holder = np.full(len(firsts), -1)
        own = np.flatnonzero(known & ~later)
        holder[entry[own]] = own
        holder = holder[holder >= 0]
        several = np.bincount(group[holder], minlength=group[-1] + 1)[group[holder]] > 1
        asked = holder[several]  # a lone passage shares no window with another
        at_hits, starts, ends = [np.flatnonzero(later)], [position[later]], [(position + n_words)[later]]
        if len(asked):
            found = earlier_windows(words.take(pa.array(asked)).to_pylist(), doc[asked], window)
            spans = {int(entry[at]): part for at, part in zip(asked.tolist(), found, strict=True) if part}
            for at in own.tolist():
                for start, end in spans.get(int(entry[at]), ()):
                    at_hits.append([at])
                    starts.append([position[at] + start])
                    ends.append([position[at] + end])
        hit = np.concatenate(at_hits)
        columns = [pa.array(doc[hit]), pa.array(key[hit])]
        columns += [pa.array(np.concatenate(parts), pa.int32()) for parts in (starts, ends)]
        return pa.RecordBatch.from_arrays(columns, ["id", "row", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = size = 0
        for whole in batches:
            for batch in (whole.slice(at, 2000) for at in range(0, whole.num_rows, 2000)):
                held.append(batch)
                rows += batch.num_rows
                size += pc.sum(pc.binary_length(batch.column(6))).as_py() or 0
                if size < 4_000_000 and rows < 40_000:
                    continue
                table = pa.Table.from_batches(held).combine_chunks()
                anchor = table.column(0).to_numpy()
                cut = int(np.searchsorted(anchor, anchor[-1]))
                if cut:
                    yield shard(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                rows = table.num_rows - cut
                size = sum(pc.sum(pc.binary_length(batch.column(6))).as_py() or 0 for batch in held)
        if rows:
            yield shard(pa.Table.from_batches(held))

    place = F.when(F.col("words").isNull(), F.xxhash64("id", "position")).otherwise(F.col("anchor"))
    dealt = passages.withColumn("place", place).repartition("place").drop("place").sortWithinPartitions("anchor", "content")
    return dealt.mapInArrow(lean(run), "id bigint, row bigint, start int, end int")


def without_repeats(
    docs: DataFrame,
    window: int = 13,
    gram: int = 6,
    crowd: int = 4096,
    id_column: str = "doc_id",
    text_column: str = "text",
    names: tuple[str, str, str] = ("kept", "n_words", "n_removed"),
) -> DataFrame:
    """`docs` with three columns more, by default kept (the words left, joined by one space; binary), n_words, n_removed.

    A word goes if a window of `window` consecutive words covers it that also starts in a document with a smaller id; words
    are split by ASCII white space and windows are judged on the input. Copies of a whole text need no search. Of the rest, windows meet by their anchors: only
    passages whose anchor two documents share are sent on, and a shard indexes and searches all passages of its anchors.
    An anchor of over `crowd` documents (a text that very many quote) has its windows meet one by one by their own text,
    and equal passages of one task are one entry, so no shard grows with such a group.

    The texts are shuffled once, by id, and read from there three times.

    Every row stays. Null and empty texts have no windows. A null id is neither smaller nor larger than another: its text
    stays whole and removes nothing. Rows that share an id are one document to each other. Ids are whole numbers. An empty table stays empty.
    Other columns stay, whatever their names, but for `__repeat_...`; a column with one of the new names is a ValueError.
    """
    if clash := set(names) & set(docs.columns):
        raise ValueError(f"the input already has {sorted(clash)}")
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.withColumns(
        {
            _ID: F.coalesce(F.col(id_column).cast("bigint"), F.xxhash64(text)),
            _NONE: F.col(id_column).isNull(),
            _ROW: F.xxhash64(text),
            _DIGEST: F.md5(text.cast("binary")),
        }
    )

    def found(table: DataFrame) -> DataFrame:
        """Joined by id, the row key only compared: so each join shuffles the texts alike, and Spark does it once."""
        other = table.withColumnsRenamed({"id": _OTHER_ID, "row": _OTHER_ROW, "anchors": _ANCHORS, "crowds": _CROWDS})
        same = F.col(_ID) == F.col(_OTHER_ID)
        if _OTHER_ROW in other.columns:
            same &= F.col(_ROW).bitwiseXOR(F.col(_OTHER_ROW)) == 0
        return rows.join(other, same, "left").drop(_OTHER_ID, _OTHER_ROW)

    digests = rows.where(~F.col(_NONE)).select(F.col(_ID).alias("id"), F.col(_ROW).alias("row"), _DIGEST)
    salted = digests.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))  # so a text of very many copies is no single key
    parts = salted.groupBy(_DIGEST, "salt").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = (
        parts.groupBy(_DIGEST)
        .agg(F.min("first").alias("first"), F.sum("n").alias("n"), F.collect_list("salt").alias("salts"))
        .where("n > 1")
        .select(_DIGEST, "first", F.explode("salts").alias("salt"))
    )
    copies = (
        salted.join(firsts, [_DIGEST, "salt"]).where("id > first").groupBy("id", "row").agg(F.lit(True).alias(_COPY))
    )
    fresh = found(copies).where(F.col(_COPY).isNull())
    shared = _shared_anchors(_asked_anchors(_ordered(fresh, text_column), window, gram, crowd), crowd)
    met = found(shared).where(F.col(_ANCHORS).isNotNull())
    spans = (
        _searched(_passages(_ordered(met, text_column, _ANCHORS, _CROWDS), window, gram), window)
        .groupBy("id", "row")
        .agg(F.collect_set(F.struct("start", "end")).alias(_SPANS))
    )
    flags = copies.unionByName(spans, allowMissingColumns=True).groupBy("id", "row").agg(F.max(_COPY).alias(_COPY), F.first(_SPANS, True).alias(_SPANS))
    return _cut(found(flags).select(*docs.columns, _NONE, _COPY, _SPANS, _ID, _ROW, _DIGEST), docs, text_column, window, names)


def _ordered(rows: DataFrame, text_column: str, *more: str) -> DataFrame:
    """(id, text, none, row, ...) first, then all other columns, so that all readers of the shuffled texts read the same columns."""
    first = [_ID, text_column, _NONE, _ROW, *more]
    return rows.select(*first, *[name for name in rows.columns if name not in first])


def _cut(joined: DataFrame, docs: DataFrame, text_column: str, window: int, new: tuple[str, str, str]) -> DataFrame:
    text_at, end = docs.columns.index(text_column), len(docs.columns)
    names = [*docs.columns, *new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, totals, removed = [], [], []
            nones, copies, spans = batch.column(end).to_pylist(), batch.column(end + 1).to_pylist(), batch.column(end + 2)
            for at, text in enumerate(as_bytes(batch.column(text_at))):
                words = text.split()
                left = words
                if nones[at]:
                    pass
                elif copies[at]:
                    left = words if len(words) < window else []
                elif spans[at].is_valid:
                    found = spans[at].values
                    stay = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(stay, found.field("start").to_numpy(), 1)
                    np.add.at(stay, found.field("end").to_numpy(), -1)
                    left = [words[i] for i in np.flatnonzero(np.cumsum(stay)[:-1] == 0).tolist()]
                kept.append(b" ".join(left))
                totals.append(len(words))
                removed.append(len(words) - len(left))
            columns = [pa.array(kept, pa.binary()), pa.array(totals, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:end], *columns], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return joined.mapInArrow(lean(run), f"{fields}, `{new[0]}` binary, `{new[1]}` bigint, `{new[2]}` bigint")


_ID, _NONE, _ROW, _DIGEST, _COPY, _SPANS, _ANCHORS, _CROWDS, _OTHER_ID, _OTHER_ROW = (
    f"__repeat_{name}" for name in ("id", "none", "row", "digest", "copy", "spans", "anchors", "crowds", "other_id", "other_row")
)


def drop_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length_column: str = "n_chars", **options: int) -> DataFrame:
    """`docs` without the repeated words; every row and column stays.

    A text that loses words becomes the words left, joined by one space, and its length column, if there is one, follows; other
    texts keep their white space.
    """
    kept, words, removed = (f"__left_{name}" for name in ("kept", "words", "removed"))
    found = without_repeats(docs, id_column=id_column, text_column=text_column, names=(kept, words, removed), **options)
    cut = F.col(removed) > 0
    text = F.when(cut, F.decode(kept, "UTF-8")).otherwise(F.col(text_column))
    changed = {text_column: text}
    if length_column in docs.columns:
        kind = docs.schema[length_column].dataType
        left = F.length(F.decode(kept, "UTF-8")).cast(kind)
        changed[length_column] = F.when(cut, left).otherwise(F.col(length_column))
    return found.withColumns(changed).select(docs.columns)
