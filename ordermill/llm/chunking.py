"""Document fingerprints from content-defined chunks, and their likeness across neighbouring documents."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.shared import as_bytes

#: The gear table: 256 random numbers from a fixed seed.
GEAR = np.random.default_rng(64206).integers(0, 1 << 32, 256, dtype=np.uint32)
#: Chunk sizes in bytes; before NORMAL a boundary must pass the strict mask, from there on the loose one.
LEAST, NORMAL, MOST = 16, 48, 256
STRICT, LOOSE = np.uint32(0b1111111 << 25), np.uint32(0b11111 << 27)
DIGITS = 8, 3  # hexadecimal digits of a chunk's digest and of its length in a fingerprint


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte the gear hash of the last 32 bytes: every byte's number, doubled once per byte that followed."""
    h = GEAR[data]
    reach = 1
    while reach < 32:
        moved = h.copy()
        moved[reach:] += h[:-reach] << np.uint32(reach)
        h, reach = moved, reach * 2
    return h


def boundaries(text: bytes) -> list[int]:
    """Ends of the chunks of a text."""
    size = len(text)
    if size <= LEAST:
        return [size] if size else []
    h = gear_hashes(np.frombuffer(text, dtype=np.uint8))
    loose_at = np.flatnonzero((h & LOOSE) == 0)
    strict = (loose_at[(h[loose_at] & STRICT) == 0] + 1).tolist()
    loose = (loose_at + 1).tolist()
    ends, start = [], 0
    while size - start > LEAST:
        middle, last = start + NORMAL, start + MOST
        at = bisect_left(strict, start + LEAST)
        if at < len(strict) and strict[at] < middle:
            end = strict[at]
        else:
            at = bisect_left(loose, middle)
            end = loose[at] if at < len(loose) and loose[at] <= last else min(last, size)
        ends.append(min(end, size))
        start = ends[-1]
    if start < size:
        ends.append(size)
    return ends


def chunk_weights(text: bytes) -> dict[int, int]:
    """The length of each distinct chunk, by its digest."""
    weights, start = {}, 0
    digest = xxhash.xxh32_intdigest
    for end in boundaries(text):
        weights[digest(text[start:end])] = end - start
        start = end
    return weights


def written(weights: dict[int, int]) -> str:
    """The fingerprint as text: digest and length of every chunk, in order of the digests."""
    return "".join([f"{digest:08x}{weights[digest]:03x}" for digest in sorted(weights)])


def parsed(fingerprint: str) -> dict[int, int]:
    """The chunks of a written fingerprint."""
    step = sum(DIGITS)
    parts = (fingerprint[at : at + step] for at in range(0, len(fingerprint), step))
    return {int(part[: DIGITS[0]], 16): int(part[DIGITS[0] :], 16) for part in parts}


def likeness(a: dict[int, int], b: dict[int, int]) -> float:
    """The smaller of both containments: shared bytes over all bytes of the distinct chunks. Two empty texts are alike."""
    if len(a) > len(b):
        a, b = b, a
    shared = sum([weight for digest, weight in a.items() if digest in b])
    most = max(sum(a.values()), sum(b.values()))
    return shared / most if most else 1.0


def _following(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows (part, guest, key, tie, id, text): a part has a run of ids in descending order and, as its guest, the row after.

    The ends of the parts come from sorted ids alone; they are two numbers per part and go to the tasks. Then
    texts are shuffled once, the first row of each part to its own part and to the one before.
    """
    spark = docs.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(-(1 << 63))).alias("key"),
        F.xxhash64(whole).alias("tie"),
        F.col(id_column).alias("id"),
        whole.alias("text"),
    )

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            keys, ties = (batch.column(k).to_numpy() for k in (0, 1))
            at = np.lexsort((ties, keys))[-1]
            best = max(best or (keys[at], ties[at]), (keys[at], ties[at]))
        if best:
            yield pa.RecordBatch.from_arrays([pa.array([value]) for value in best], ["key", "tie"])

    order = (F.col("key").desc(), F.col("tie").desc())
    ranged = rows.select("key", "tie").repartitionByRange(count, *order)
    heads = sorted((tuple(row) for row in ranged.mapInArrow(largest, "key bigint, tie bigint").collect()), reverse=True)
    head_keys, head_ties = (np.array(column, dtype=np.int64) for column in zip(*heads, strict=True)) if heads else ((), ())

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ties = (batch.column(k).to_numpy() for k in (0, 1))
            part = len(heads) - 1 - np.searchsorted(head_keys[::-1], keys, side="right")
            for at in np.flatnonzero(np.isin(keys, head_keys)).tolist():
                pair = (keys[at], ties[at])
                part[at] = sum(head >= pair for head in heads) - 1
            first = (keys == head_keys[part]) & (ties == head_ties[part])
            guests = np.flatnonzero(first)
            take = np.concatenate([np.arange(len(keys)), guests])
            parts = np.concatenate([part, (part[guests] - 1) % len(heads)])
            guest = np.concatenate([np.zeros(len(keys), dtype=bool), np.ones(len(guests), dtype=bool)])
            dealt = batch.take(pa.array(take))
            columns = [pa.array(parts.astype(np.int32)), pa.array(guest), *dealt.columns]
            yield pa.RecordBatch.from_arrays(columns, ["part", "guest", "key", "tie", "id", "text"])

    id_type = docs.schema[id_column].dataType.simpleString()
    schema = f"part int, guest boolean, key bigint, tie bigint, id {id_type}, text string"
    if not heads:
        return spark.createDataFrame([], schema)
    return rows.mapInArrow(deal, schema).repartitionById(len(heads), F.col("part")).sortWithinPartitions("part", "guest", *order)


def fingerprints_with_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The next document is the one with the largest smaller id; after the last comes the first. `edited` is the text with its last
    half (rounded down, in code points) replaced by as many first ones of the next text, or all it has. Fingerprints are the
    sets of content-defined chunks with their lengths, so equal texts have equal ones and a change touches few chunks.

    Null and empty texts have the empty fingerprint; it is like another empty one (1) and unlike any other (0). Null ids come last in the order. Of
    rows with one id, those with the larger text hash come first; equal rows follow each other. A lone row is its own next.
    Ids are whole numbers; other columns are not read; an empty table gives no rows.
    """
    rows = _following(docs, id_column, text_column)
    id_type = rows.schema["id"].dataType.simpleString()
    names = [id_column, "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            id_kind = batch.schema.field("id").type
            found = []
            guests, ids, texts = batch.column(1).to_pylist(), batch.column(4).to_pylist(), as_bytes(batch.column(5))
            for guest, doc, text in zip(guests, ids, texts, strict=True):
                weights = chunk_weights(text)
                if waiting:
                    own, own_text, own_weights = waiting
                    chars, following = own_text.decode(), text.decode()
                    half = len(chars) // 2
                    edited = chars[: len(chars) - half] + following[:half]
                    edited_weights = chunk_weights(edited.encode())
                    found.append(
                        (
                            own,
                            len(chars),
                            edited,
                            written(own_weights),
                            written(edited_weights),
                            likeness(own_weights, edited_weights),
                            likeness(own_weights, weights),
                        )
                    )
                waiting = None if guest else (doc, text, weights)
                if len(found) == 1000:
                    yield made(found, id_kind)
                    found = []
            if found:
                yield made(found, id_kind)

    def made(found: list[tuple], id_kind: pa.DataType) -> pa.RecordBatch:
        kinds = [id_kind, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
        columns = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)

    schema = f"`{id_column}` {id_type}, n_chars bigint, edited string, fingerprint string, edited_fingerprint string"
    return rows.mapInArrow(run, f"{schema}, near_edited double, near_next double")
