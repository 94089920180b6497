"""Packing documents into token windows of one size (minimum bin slack)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ordermill.llm.shared import as_bytes, lean
from ordermill.llm.tokens import shared_encoder

Piece = tuple[int, int, int]  # document, start, length


def best_fill(counts: dict[int, int], lengths: list[int], room: int) -> list[tuple[int, int]]:
    """The multiset of the lengths at hand whose sum comes closest to `room` without passing it.

    Bit s of a set tells whether a sum of s can be made. Copies of a length are added in doubling steps, so a length
    costs the logarithm of its copies. The sets before each length are kept; walking back through them gives the counts.
    """
    wanted, mask = 1 << room, (1 << (room + 1)) - 1
    sums, steps = 1, []
    for length in lengths:
        if length > room:
            continue
        steps.append((length, sums))
        left, copies = min(counts[length], room // length), 1
        while left:
            copies = min(copies, left)
            sums |= (sums << copies * length) & mask
            left -= copies
            copies *= 2
        if sums & wanted:
            break
    total = sums.bit_length() - 1
    taken = []
    for length, before in reversed(steps):
        copies = 0
        while not before >> total & 1:
            total -= length
            copies += 1
        if copies:
            taken.append((length, copies))
    return taken


def plan(lengths: Iterable[int], window: int) -> list[list[Piece]]:
    """Windows for documents of these lengths; every id is in one piece.

    A document longer than the window gives whole windows first. The rests are packed: the longest rest opens a
    window, the subset sum fills it, and the same multiset is used as often as its lengths last. If no subset fills the window,
    the head of the longest rest left is cut off to fill it. What remains for the last window is cut into powers of two.
    """
    windows: list[list[Piece]] = []
    rests: dict[int, list[tuple[int, int]]] = {}
    for document, length in enumerate(lengths):
        whole = length - length % window
        windows += [[(document, start, window)] for start in range(0, whole, window)]
        if length > whole:
            rests.setdefault(length - whole, []).append((document, whole))
    order = sorted(rests, reverse=True)
    while order:
        seed = order[0]
        counts = {length: len(items) for length, items in rests.items()}
        counts[seed] -= 1
        filled = [(seed, 1), *best_fill(counts, order, window - seed)]
        pattern: dict[int, int] = {}
        for length, copies in filled:
            pattern[length] = pattern.get(length, 0) + copies
        slack = window - sum(length * copies for length, copies in pattern.items())
        times = 1 if slack else min(len(rests[length]) // copies for length, copies in pattern.items())
        for _ in range(times):
            windows.append([(*rests[length].pop(), length) for length, copies in pattern.items() for _ in range(copies)])
        for length in pattern:
            if not rests[length]:
                del rests[length]
        if slack and rests:
            longest = max(rests)
            document, start = rests[longest].pop()
            windows[-1].append((document, start, slack))
            rests.setdefault(longest - slack, []).append((document, start + slack))
            if not rests[longest]:
                del rests[longest]
        elif slack:
            windows += powers_of_two(windows.pop())
        order = sorted(rests, reverse=True)
    return windows


def powers_of_two(pieces: list[Piece]) -> list[list[Piece]]:
    """The pieces in windows whose sizes are the powers of two in their sum, largest first."""
    windows, left, pieces = [], sum(piece[2] for piece in pieces), list(pieces)
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        windows.append([])
        while room:
            document, start, length = pieces.pop(0)
            taken = min(room, length)
            windows[-1].append((document, start, taken))
            room -= taken
            if length > taken:
                pieces.insert(0, (document, start + taken, length - taken))
    return windows


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = 2048,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk_ids: int = 4_000_000,
) -> DataFrame:
    """Pieces of documents and their places in windows of `window` ids.

    Columns: the id column, start (ids of the document before the piece), length, ids (little-endian unsigned 32-bit), doc_tokens
    (with the end id), sequence_id, offset. A window is filled to the last id, but for one rest per chunk that is cut into powers of two.

    A task packs its own rows in chunks of about `chunk_ids` ids, so there is no shuffle, memory is bounded and a hot source is just
    more chunks. Sequence ids carry the partition, so they are unique, and a task that runs again gives the same rows.

    Null and empty texts are a document of one end id. Repeated rows and null ids are documents of their own. A very long text
    spans many windows. Other columns are not read; an empty table gives no rows.
    """
    id_type = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer_path)
        end = np.array([end_id], dtype="<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 33
        keys: list = []
        texts: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal keys, texts, size, sequence
            rows = []
            for pieces in plan([len(ids) // 4 for ids in texts], window):
                offset = 0
                for document, start, length in pieces:
                    ids = texts[document]
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append((keys[document], start, length, part, len(ids) // 4, sequence, offset))
                    offset += length
                sequence += 1
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            keys, texts, size = [], [], 0
            return pa.RecordBatch.from_arrays(columns, names)

        names = [id_column, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        for batch in batches:
            kinds = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3]
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                for key, ids in zip(part.column(0).to_pylist(), encoder.encode(as_bytes(part.column(1))), strict=True):
                    keys.append(key)
                    texts.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= chunk_ids:
                        yield flush()
        if keys:
            yield flush()

    schema = (
        f"`{id_column}` {id_type}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    )
    return docs.select(id_column, text_column).mapInArrow(lean(run, encodes=True), schema)
