"""Token ids in binary files with a minimal perfect hash index for access by document key."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm.perfect_hash import PerfectHash, mixed
from ordermill.llm.shared import as_bytes, lean, staged
from ordermill.llm.tokens import shared_encoder
from ordermill.session import new_folder

#: Fixed values of the format. A file is the magic bytes, seven unsigned 64-bit numbers (bytes per id, ids, records, records
#: without key, keys, levels, words in all levels), then without gaps: the ids of all records; where each record starts,
#: and the end (64-bit); the keys of the records (signed 64-bit); per place of the hash the record (64-bit), then the key's fingerprint
#: (32-bit); words per level, and the levels (64-bit). All numbers are little-endian.
MAGIC = b"IDFILE01"
FINGERPRINT_SEED = 1000


def encode_shard(keys: list[int | None], records: list[bytes], width: int) -> bytes:
    """The bytes of a file; records are 32-bit ids in the order of their keys, those without key first."""
    lengths = np.array([len(record) // 4 for record in records], dtype="<u8")
    ids = np.frombuffer(b"".join(records), dtype="<u4").astype(f"<u{width}")
    missing = sum(key is None for key in keys)
    own = np.array([key or 0 for key in keys], dtype="<i8")
    distinct, first = np.unique(own[missing:], return_index=True)
    levels = PerfectHash.build(distinct.view("<u8"))
    place = PerfectHash(levels).places(distinct.view("<u8"))
    slots, prints = np.zeros(len(distinct), dtype="<u8"), np.zeros(len(distinct), dtype="<u4")
    slots[place] = first + missing
    prints[place] = mixed(distinct.view("<u8"), FINGERPRINT_SEED).astype("<u4")
    words = sum(map(len, levels))
    head = np.array([width, len(ids), len(records), missing, len(distinct), len(levels), words], dtype="<u8")
    sizes = np.array([len(level) for level in levels], dtype="<u8")
    starts = np.append(np.uint64(0), np.cumsum(lengths)).astype("<u8")
    parts = [head, ids, starts, own, slots, prints, sizes, *levels]
    return MAGIC + b"".join(part.tobytes() for part in parts)


class Shard:
    """Reads one file; the index is loaded, the ids are read where they lie."""

    def __init__(self, file) -> None:
        self.file = file
        head = file.read_at(len(MAGIC) + 56, 0)
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        self.width, ids, records, self.missing, keys, levels, words = np.frombuffer(head[len(MAGIC) :], dtype="<u8").tolist()
        at = len(head) + self.width * ids
        sizes = [8 * (records + 1), 8 * records, 8 * keys, 4 * keys, 8 * levels, 8 * words]
        data = file.read_at(sum(sizes), at)
        bounds = np.cumsum([0, *sizes]).tolist()
        kinds = ("<u8", "<i8", "<u8", "<u4", "<u8", "<u8")
        self.starts, self.keys, self.slots, self.prints, level_sizes, bits = (
            np.frombuffer(data[a:b], dtype=kind) for a, b, kind in zip(bounds, bounds[1:], kinds, strict=False)
        )
        self.hash = PerfectHash(np.split(bits, np.cumsum(level_sizes.astype(np.int64))[:-1]) if levels else [])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The first record of each key, -1 for keys whose fingerprint is not here."""
        place = self.hash.places(keys.view("<u8"))
        known = place >= 0
        known[known] = self.prints[place[known]] == mixed(keys[known].view("<u8"), FINGERPRINT_SEED).astype("<u4")
        record = np.full(len(keys), -1, dtype=np.int64)
        record[known] = self.slots[place[known]]
        return record

    def copies(self, records: np.ndarray) -> np.ndarray:
        """How many records in a row have the key of each of these, the first of their keys."""
        return np.searchsorted(self.keys[self.missing :], self.keys[records], side="right") + self.missing - records

    def ids(self, record: int, count: int = 1) -> np.ndarray:
        start, end = int(self.starts[record]), int(self.starts[record + count])
        raw = self.file.read_at(self.width * (end - start), len(MAGIC) + 56 + self.width * start)
        return np.frombuffer(raw, dtype=f"<u{self.width}").astype("<u4")


@dataclass(frozen=True)
class TokenFiles:
    """Written files, one row each, in the order of the keys: path, first and last key, records, ids, ids of all files before; and their number."""

    manifest: DataFrame
    files: int


def write(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    shard_ids: int = 16_000_000,
    folder: str | None = None,
) -> TokenFiles:
    """Writes the ids of all texts, each with the end id, in ascending order of the keys, to files of about `shard_ids` ids.

    Texts are dealt out by ranges of the key and sorted there; ties go by a hash of the text, so a key of very many rows spreads over
    several tasks. A task writes files under names of its own and returns them; only what a finished task returned counts, so
    a lost executor leaves at most an unread file. The rows about files (one for many megabytes) are summed on the driver.

    Null and empty texts are one end id. Null keys come first and are not indexed. Records of one key stand together, the index
    names the first in each file. Keys are whole numbers. Other columns are not read. An empty table gives no files.
    """
    spark = docs.sparkSession
    target = folder or new_folder(spark, "tokens")
    rows = (
        docs.select(F.col(id_column).cast("bigint").alias("key"), F.col(text_column).alias("text"))
        .withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
        .repartitionByRange("key", "tie", "row")
        .sortWithinPartitions("key", "tie", "row")
        .select("key", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer_path)
        width = 2 if max(encoder.full.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], dtype="<u4").tobytes()
        store, path = fs.FileSystem.from_uri(target)
        task = TaskContext.get().partitionId()
        keys: list[int | None] = []
        records: list[bytes] = []
        held = number = 0

        def flush() -> pa.RecordBatch:
            name = f"{task:07d}-{number:05d}-{uuid.uuid4().hex}.ids"
            with store.open_output_stream(f"{path}/{name}") as out:
                out.write(encode_shard(keys, records, width))
            known = [key for key in keys if key is not None]
            row = [task, number, f"{target}/{name}", min(known, default=None), max(known, default=None), len(records), held]
            kinds = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(row, kinds, strict=True)], names)

        names = ["task", "number", "path", "first_key", "last_key", "records", "ids"]
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                for key, ids in zip(part.column(0).to_pylist(), encoder.encode(as_bytes(part.column(1))), strict=True):
                    keys.append(key)
                    records.append(ids + end)
                    held += len(ids) // 4 + 1
                    if held >= shard_ids:
                        yield flush()
                        keys, records, held, number = [], [], 0, number + 1
        if keys:
            yield flush()

    schema = "task bigint, number bigint, path string, first_key bigint, last_key bigint, records bigint, ids bigint"
    written = staged(rows.mapInArrow(lean(run, encodes=True), schema), "token-files").orderBy("task", "number").collect()
    before, listed = 0, []
    for row in written:
        listed.append((row.path, row.first_key, row.last_key, row.records, row.ids, before))
        before += row.ids
    kinds = "path string, first_key bigint, last_key bigint, records bigint, ids bigint, before bigint"
    return TokenFiles(spark.createDataFrame(listed, kinds), len(listed))


def _opened(path: str) -> Shard:
    store, name = fs.FileSystem.from_uri(path)
    return Shard(store.open_input_file(name))


_READ = "key bigint, start bigint, n_tokens bigint, ids binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    columns = zip(*rows, strict=True) if rows else ([], [], [], [])
    names = ["key", "start", "n_tokens", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _records(shard: Shard, begin: int, end: int, before: int, most: int) -> Iterator[tuple]:
    """Rows for the records from `begin` to `end`, read in runs of up to `most` ids (or one record)."""
    while begin < end:
        stop = int(np.searchsorted(shard.starts, shard.starts[begin] + np.uint64(most), side="right")) - 1
        stop = min(max(stop, begin + 1), end)
        ids, starts = shard.ids(begin, stop - begin), shard.starts[begin : stop + 1].astype(np.int64).tolist()
        keys = shard.keys[begin:stop].tolist()
        for at, record in enumerate(range(begin, stop)):
            part = ids[starts[at] - starts[0] : starts[at + 1] - starts[0]]
            yield None if record < shard.missing else keys[at], before + starts[at], len(part), part.tobytes()
        begin = stop


def _read(shard: Shard, keys: np.ndarray, before: int, most: int = 1_000_000) -> Iterator[tuple]:
    """Rows for these keys, found through the index; records that stand together are read together."""
    first = shard.find(keys)
    first = np.sort(first[first >= 0])
    ends = first + shard.copies(first)
    apart = np.flatnonzero(first[1:] != ends[:-1]) + 1
    for run in np.split(np.arange(len(first)), apart):
        if len(run):
            yield from _records(shard, int(first[run[0]]), int(ends[run[-1]]), before, most)


def read(files: TokenFiles) -> DataFrame:
    """(key, start, n_tokens, ids) of every record of every file; each key is looked up in its file's index. A task reads one file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = _opened(path)
                rows, held = [], 0
                missing = _records(shard, 0, shard.missing, before, 1_000_000)
                for row in chain(missing, _read(shard, np.unique(shard.keys[shard.missing :]), before)):
                    rows.append(row)
                    held += row[2]
                    if held > 1_000_000:
                        yield _batch(rows)
                        rows, held = [], 0
                yield _batch(rows)

    listed = files.manifest.select("path", "before").repartition(max(1, files.files))  # explicit: not merged for their few bytes
    return listed.mapInArrow(lean(run), _READ)


def lookup(files: TokenFiles, keys: DataFrame, key_column: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids) for the distinct keys of `keys` that the files have.

    Only the first and last keys of the files are held by the tasks, to send each key to its file (or files, where one key spans several).
    """
    spark: SparkSession = files.manifest.sparkSession
    listed = files.manifest.where("first_key IS NOT NULL").select("path", "before", "first_key", "last_key").collect()
    paths = [(row.path, row.before) for row in listed]
    first = np.array([row.first_key for row in listed], dtype=np.int64)
    last = np.array([row.last_key for row in listed], dtype=np.int64)
    wanted = keys.select(F.col(key_column).cast("bigint").alias("key")).where("key IS NOT NULL").distinct()
    if not paths:
        return spark.createDataFrame([], _READ)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy()
            low, high = np.searchsorted(last, key, side="left"), np.searchsorted(first, key, side="right")
            count = np.maximum(high - low, 0)
            number = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(np.repeat(key, count))], ["number", "key"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (-1, None)
        for batch in batches:
            number, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for one in np.unique(number):
                if held[0] != one:
                    held = (one, _opened(paths[one][0]))
                yield _batch(list(_read(held[1], key[number == one], paths[one][1])))

    sent = wanted.mapInArrow(lean(send), "number bigint, key bigint").repartition(files.files, "number").sortWithinPartitions("number", "key")
    return sent.mapInArrow(lean(fetch), _READ)
