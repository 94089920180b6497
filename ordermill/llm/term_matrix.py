"""A sparse document-term matrix: words coded by one dictionary of the whole table, rows in compressed shards."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ordermill.llm.shared import as_bytes, lean, staged

Measure = Callable[[bytes], int]


class _Places(dict):
    """Numbers words in the order in which they are first seen."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


@dataclass(frozen=True)
class TermMatrix:
    """The matrix in shards, and its dictionary (term, code).

    A shard is one row: shard, rows (what is known of each document), and the compressed rows: starts (64-bit, one more than rows), terms
    (64-bit codes) and counts (unsigned 32-bit), little-endian. The terms of row i stand from starts[i] to starts[i + 1].
    A code is a bucket (by the word's checksum) and a number in it; a word has the same code in all shards and no two words share one.
    """

    shards: DataFrame
    dictionary: DataFrame


#: Bits of a code below its bucket.
_NUMBER = 40


def term_matrix(
    docs: DataFrame,
    text_column: str = "text",
    measures: Mapping[str, Measure] | None = None,
    shard_bytes: int = 4_000_000,
    span_terms: int = 300_000,
    buckets: int = 1024,
) -> TermMatrix:
    """The counts of the words (split by ASCII white space, case kept) of whole texts.

    `rows` has the other columns of `docs`, a number `row` that tells repeated rows apart, and what `measures` give for the text.

    A task turns its texts into shards of some `shard_bytes` of text. The shards of a span, up to `span_terms` different words, share word numbers of
    their own. All is written once. The words of a span go, as one list per bucket, to the task of their bucket, which numbers the bucket's distinct words, span by
    span, and sends the numbers back to the span's shards. So only lists of a span's different words are shuffled, never the words of the texts: a word that every document has is
    one entry per span. A task holds the distinct words of one bucket at a time: more `buckets` suit more words.

    Null and empty texts are rows without terms. A very long text is a shard of its own. Repeated rows are rows of their own. `docs` must not have
    a column `row` or one named as a measure (ValueError). An empty table gives no shards
    and no terms.
    """
    measures = dict(measures or {})
    carried = [name for name in docs.columns if name != text_column]
    if clash := {"row", *measures} & set(carried):
        raise ValueError(f"columns {sorted(clash)} are names of the matrix's rows")
    carried_fields = ", ".join(f"`{name}`: {docs.schema[name].dataType.simpleString()}" for name in carried)
    inner = ", ".join([*([carried_fields] if carried_fields else []), *(f"`{name}`: bigint" for name in measures), "row: bigint"])
    names = [*carried, *measures, "row"]

    columns = ["span", "kind", "bucket", "shard", "rows", "starts", "terms", "counts", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = span = seen = TaskContext.get().partitionId() << 33
        places, held, size = _Places(), [], 0
        known: list[pa.StructArray] = []

        def flush() -> pa.RecordBatch:
            nonlocal number, held, size, known
            lengths = np.array([len(own) for own, _ in held], dtype=np.int64)
            starts = np.append(0, np.cumsum(lengths)).astype("<i8").tobytes()
            terms, counts = (_planes(np.concatenate([part[k] for part in held])) for k in (0, 1))
            entries = pa.concat_arrays(known)
            listed = pa.ListArray.from_arrays(pa.array([0, len(entries)], pa.int32()), entries)
            cells = [[span], [2], [0], [number], listed, [starts], [terms], [counts], [None]]
            held, size, known, number = [], 0, [], number + 1
            return _batch(cells, listed.type, columns)

        def close(kind: pa.DataType) -> pa.RecordBatch:
            """Where the numbers of the span are in its lists, and the lists: the words of a bucket, in the order of their numbers."""
            nonlocal span, places
            words = list(places)
            bucket = np.fromiter(map(crc32, words), dtype="<u4", count=len(words)) % buckets
            order = np.argsort(bucket, kind="stable")
            slots = np.empty(len(words), dtype="<u4")
            slots[order] = np.arange(len(words), dtype="<u4")
            own, starts = np.unique(bucket[order], return_index=True)
            ends = [*starts[1:].tolist(), len(words)]
            lists = [b" ".join([words[i] for i in order[start:end].tolist()]) for start, end in zip(starts.tolist(), ends, strict=True)]
            n = len(own) + 1
            none = [None] * n
            cells = [[span] * n, [0, *[1] * len(own)], [0, *own.tolist()], none, none, none, [_planes(slots), *none[1:]], none, [None, *lists]]
            places, span = _Places(), span + 1
            return _batch(cells, kind, columns)

        for whole in batches:
            for batch in (whole.slice(at, 500) for at in range(0, whole.num_rows, 500)):
                texts = as_bytes(batch.column(0))
                begin = 0
                for at, text in enumerate(texts):
                    found = Counter(text.split())
                    own = np.fromiter(map(places.__getitem__, found), dtype="<u4", count=len(found))
                    held.append((own, np.fromiter(found.values(), dtype="<u4", count=len(found))))
                    size += len(text)
                    full = len(places) >= span_terms
                    if size >= shard_bytes or full or at + 1 == len(texts):
                        part = batch.slice(begin, at + 1 - begin)
                        measured = [pa.array([f(t) for t in texts[begin : at + 1]], pa.int64()) for f in measures.values()]
                        order = pa.array(range(seen, seen + part.num_rows), pa.int64())
                        seen += part.num_rows
                        known.append(pa.StructArray.from_arrays([*part.columns[1:], *measured, order], names))
                        kind = pa.list_(known[-1].type)
                        begin = at + 1
                        if size >= shard_bytes or full:
                            yield flush()
                        if full:
                            yield close(kind)
        if held:
            yield flush()
        if places:
            yield close(kind)

    fields = f"shard bigint, rows array<struct<{inner}>>, starts binary, terms binary, counts binary"
    local = staged(docs.select(text_column, *carried).mapInArrow(lean(run), f"span bigint, kind int, bucket int, {fields}, words binary"), "term-shards", "zstd")
    lists = local.where("kind = 1").select("bucket", "span", "words").repartition("bucket").sortWithinPartitions("bucket", "span")
    numbers = lists.mapInArrow(lean(_numbers), "span bigint, kind int, bucket int, terms binary")
    dictionary = lists.mapInArrow(lean(_terms), "term binary, code bigint")
    parts = local.where("kind <> 1").drop("words").unionByName(numbers, allowMissingColumns=True)

    def globally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, codes, complete = np.array([], dtype="<u4"), [], None
        for whole in batches:
            for batch in (whole.slice(at, 1) for at in range(whole.num_rows)):
                kind, bucket = batch.column(1)[0].as_py(), batch.column(2)[0].as_py()
                own = _whole(batch.column(6)[0].as_py())
                if kind == 0:
                    slots, codes, complete = own, [], None
                elif kind == 1:
                    codes.append(own.astype("<i8") + (bucket << _NUMBER))
                else:
                    if complete is None:
                        complete = np.concatenate([np.array([], dtype="<i8"), *codes])[slots]
                    coded = pa.array([complete[own].tobytes()], pa.binary())
                    counts = pa.array([_whole(batch.column(7)[0].as_py()).tobytes()], pa.binary())
                    yield pa.RecordBatch.from_arrays([*batch.columns[3:6], coded, counts], ["shard", "rows", "starts", "terms", "counts"])

    order = ["span", "kind", "bucket", "shard"]
    dealt = parts.select("span", "kind", "bucket", "shard", "rows", "starts", "terms", "counts").repartition("span").sortWithinPartitions(*order)
    return TermMatrix(dealt.mapInArrow(lean(globally), fields), dictionary)


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers byte by byte, all first bytes first: small numbers then pack well in files and shuffles."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _whole(planes: bytes) -> np.ndarray:
    """The numbers of `_planes`."""
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _batch(cells: list, rows: pa.DataType, columns: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), rows, *[pa.binary()] * 4]
    arrays = [cell if isinstance(cell, pa.Array) else pa.array(cell, kind) for cell, kind in zip(cells, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, columns)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, _Places, int, list[bytes]]]:
    """Rows (bucket, span, words) in order, with the bucket's numbers so far and how many it had before."""
    bucket, places = None, _Places()
    for whole in batches:
        for batch in (whole.slice(at, 200) for at in range(0, whole.num_rows, 200)):
            for own, span, words in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if own != bucket:
                    bucket, places = own, _Places()
                yield own, span, places, len(places), words.split(b" ")


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The numbers of each list of words."""
    names, kinds = ["span", "kind", "bucket", "terms"], [pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    rows, held = [], 0
    for bucket, span, places, _, words in _numbered(batches):
        found = _planes(np.fromiter(map(places.__getitem__, words), dtype="<u4", count=len(words)))
        rows.append((span, 1, bucket, found))
        held += len(found)
        if len(rows) == 2000 or held > 4_000_000:
            yield batch_of(rows)
            rows, held = [], 0
    if rows:
        yield batch_of(rows)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct word once, with its code."""
    for bucket, _, places, before, words in _numbered(batches):
        for word in words:
            places[word]
        new = [word for word in words if places[word] >= before]
        codes = [(bucket << _NUMBER) + places[word] for word in new]
        yield pa.RecordBatch.from_arrays([pa.array(new, pa.binary()), pa.array(codes, pa.int64())], ["term", "code"])


def row_sums(matrix: TermMatrix, sums: str = "n_words", terms: str = "n_terms") -> DataFrame:
    """What `rows` has of each document, with the sum of its row and the number of its terms."""
    kind = matrix.shards.schema["rows"].dataType.elementType
    names = kind.fieldNames()
    if clash := {sums, terms} & set(names):
        raise ValueError(f"columns {sorted(clash)} are names of the row sums")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(at, 1) for at in range(whole.num_rows)):
                starts = np.frombuffer(batch.column(1)[0].as_py(), dtype="<i8")
                counts = np.frombuffer(batch.column(2)[0].as_py(), dtype="<u4").astype(np.int64)
                running = np.append(0, np.cumsum(counts))
                found = [running[starts[1:]] - running[starts[:-1]], np.diff(starts)]
                columns = [*batch.column(0).flatten().flatten(), *map(pa.array, found)]
                yield pa.RecordBatch.from_arrays(columns, [*names, sums, terms])

    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in kind.fields)
    return matrix.shards.select("rows", "starts", "counts").mapInArrow(lean(run), f"{fields}, `{sums}` bigint, `{terms}` bigint")
