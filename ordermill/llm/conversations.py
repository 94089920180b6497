"""Conversation structure repair: faults of rows, and the cheapest edits that make the roles alternate."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.edit_costs import GOES, NEXT, PUT, START, EditCosts, row_code
from ordermill.llm.shared import lean, with_first

_BLANKS = " \t\n\x0b\x0c\r"
_LEGAL = frozenset(("su", "ua", "au"))
_ORDER = ["conv", "timed", "turn", "role", "digest"]
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_NAMES = {"u": "user", "a": "assistant"}


def damaged(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conversation, turn, role, text, copies): a fixed twentieth of the rows each is dropped (copies 0), emptied, stripped of `.!?`,
    repeated (copies 2) or given the role user, by the checksum of `conversation:turn`. A null counts as one space."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(name).cast("string"), space) for name in (conversation, turn)])
    kind = F.crc32(key.cast("binary")) % 20
    whole = F.coalesce(F.col(text), space)
    return rows.select(
        F.col(conversation),
        F.col(turn),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role), space)).alias(role),
        F.when(kind == 1, "").when(kind == 2, F.translate(whole, ".!?", "")).otherwise(whole).alias(text),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _plain(rows: DataFrame, conversation: str, turn: str, role: str, text: str, copies: str | None) -> DataFrame:
    """(conv, timed, turn, role, digest, text, copies), nulls as one space; `digest` is of conversation, role and text."""
    bare = rows.select(
        F.col(conversation).alias("conv"),
        F.col(turn).isNotNull().alias("timed"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        (F.col(copies).cast("bigint") if copies else F.lit(1).cast("bigint")).alias("copies"),
    )
    name = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit(""))
    told = F.concat(F.length(name), F.lit(":"), name, F.length("role"), F.lit(":"), F.col("role"), F.col("text"))
    return bare.withColumn("digest", F.md5(told.cast("binary")))


def structure(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None
) -> DataFrame:
    """(conversation, gaps, blank, duplicate, truncated, illegal, cost, audit): one row per conversation.

    A conversation's rows stand by turn (nulls first), then role, then a digest of the text. The first fault of a row counts: blank, duplicate (role
    and text seen earlier in the conversation), truncated (does not end in `.!?`). `audit` is the cheapest sequence of Keep, Rerole (1), Delete (2) and Insert (5)
    that gives initials `(s?(ua)+)?`, of several the ASCII-least; blank and duplicate rows must be deleted, truncated ones cost 5 unless they are. Rows
    with 0 copies only name their conversation.

    Texts are not sent: equal rows of a turn are counted together, a row's earlier copies are found by its digest in salted parts, and the rows are sorted
    by ranges, so a very long conversation spreads over tasks. Each range sends one byte per row. The task that writes an audit holds
    these bytes of its conversation, as it must hold the audit, and runs the checkpointed program over them.

    Null conversations are one conversation. A null role or text is one space, other roles than those with initials s, u, a can only be rerolled or deleted.
    Other columns are not read. An empty table gives no rows.
    """
    plain = _plain(rows, conversation, turn, role, text, copies)
    body = F.rtrim(F.col("text"), F.lit(_BLANKS))
    grouped = (
        plain.select(
            *_ORDER,
            (body == "").alias("blank"),
            (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("truncated"),
            "copies",
        )
        .groupBy(*_ORDER, "blank", "truncated")
        .agg(F.sum("copies").alias("n"))
        .withColumn("seen", F.when(F.col("n") > 0, F.struct("timed", "turn")))
    )
    later = F.coalesce(F.col("seen") > F.col("first"), F.lit(False))
    keyed = with_first(grouped, "digest", "seen", F.col("turn"), "first").select(
        *_ORDER, "blank", later.alias("later"), "truncated", "n"
    )
    kind = plain.schema["conv"].dataType.simpleString()
    blocks = (
        keyed.repartitionByRange(*_ORDER)
        .sortWithinPartitions(*_ORDER)
        .select("conv", "turn", F.substring("role", 1, 1).alias("initial"), "blank", "later", "truncated", "n")
        .mapInArrow(
            lean(_blocks),
            f"conv {kind}, part bigint, number bigint, codes binary, blank bigint, duplicate bigint, truncated bigint, illegal bigint,"
            " first string, last string, first_turn bigint, last_turn bigint, turns bigint",
        )
    )
    found = blocks.repartition("conv").sortWithinPartitions("conv", "part", "number").mapInArrow(lean(_audits), _audit_schema("conv", kind))
    return found.withColumnRenamed("conv", conversation)


def _audit_schema(name: str, kind: str) -> str:
    return f"`{name}` {kind}, " + ", ".join(f"{count} bigint" for count in _COUNTS) + ", audit string"


def _blocks(batches: Iterator[pa.RecordBatch], most: int = 65_536) -> Iterator[pa.RecordBatch]:
    """One row per conversation of the task and `most` of its rows: a byte per row, and counts that can be added up."""
    part = TaskContext.get().partitionId()
    out: list[tuple] = []
    names = ["conv", "part", "number", "codes", "blank", "duplicate", "truncated", "illegal", "first", "last", "first_turn", "last_turn", "turns"]
    kinds = [None, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4, pa.string(), pa.string(), *[pa.int64()] * 3]
    number, conv, held = 0, object(), None

    def close() -> None:
        nonlocal number
        if held is not None:
            out.append((conv, part, number, bytes(held["codes"]), held["blank"], held["duplicate"], held["truncated"], held["illegal"],
                        held["first"], held["last"], held["first_turn"], held["last_turn"], held["turns"]))
            number += 1

    def opened() -> dict:
        return {"codes": bytearray(), "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "first": None, "last": None,
                "first_turn": None, "last_turn": None, "turns": 0}

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for batch in batches:
        kinds[0] = batch.schema.field(0).type
        for key, turn, initial, blank, later, truncated, n in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if held is None or key != conv:
                close()
                conv, held = key, opened()
                if len(out) > 5000:
                    yield batch_of(out)
                    out = []
            for copy in range(n):
                if len(held["codes"]) >= most:
                    close()
                    held = opened()
                duplicate = not blank and (later or copy > 0)
                ends = truncated and not blank and not duplicate
                held["codes"].append(row_code(initial, ends, blank or duplicate))
                held["blank"] += blank
                held["duplicate"] += duplicate
                held["truncated"] += ends
                if held["first"] is None:
                    held["first"] = initial
                else:
                    held["illegal"] += held["last"] + initial not in _LEGAL
                held["last"] = initial
                if turn is not None and turn != held["last_turn"]:
                    held["turns"] += 1
                    held["last_turn"] = turn
                    if held["first_turn"] is None:
                        held["first_turn"] = turn
    close()
    if out:
        yield batch_of(out)


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its blocks in order."""
    costs = EditCosts()
    out: list[tuple] = []
    kinds = [None, *[pa.int64()] * len(_COUNTS), pa.string()]
    names = ["conv", *_COUNTS, "audit"]
    conv, held = object(), []

    def close() -> None:
        if not held:
            return
        sums = [sum(block[k] for block in held) for k in (4, 5, 6, 7)]
        filled = [block for block in held if block[3]]
        sums[3] += sum(a[9] + b[8] not in _LEGAL for a, b in zip(filled, filled[1:], strict=False))
        timed = [block for block in held if block[10] is not None]
        gaps = 0
        if timed:
            distinct = sum(block[12] for block in timed) - sum(a[11] == b[10] for a, b in zip(timed, timed[1:], strict=False))
            gaps = timed[-1][11] - timed[0][10] + 1 - distinct
        cost, audit = costs.edits(b"".join(block[3] for block in held))
        out.append((conv, gaps, *sums, cost, audit))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for batch in batches:
        kinds[0] = batch.schema.field(0).type
        for at in range(0, batch.num_rows, 500):
            for block in zip(*(column.to_pylist() for column in batch.slice(at, 500).columns), strict=True):
                if not held or block[0] != conv:
                    close()
                    conv, held = block[0], []
                    if len(out) > 2000:
                        yield batch_of(out)
                        out = []
                held.append(block)
    close()
    if out:
        yield batch_of(out)


def _edited(rows: DataFrame, audits: DataFrame, columns: tuple[str, str, str, str], copies: str | None, finish: Callable, schema: str) -> DataFrame:
    """Streams each conversation's rows after its audit, in one task and in order, through an editor made by `finish`."""
    plain = _plain(rows, *columns, copies)
    texts = plain.where("copies > 0").select(
        "conv", F.lit(1).alias("kind"), "timed", "turn", "role", "digest", "text", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy")
    )
    heads = audits.select(F.col(columns[0]).alias("conv"), F.lit(0).alias("kind"), *_COUNTS, "audit")
    both = heads.unionByName(texts, allowMissingColumns=True).repartition("conv").sortWithinPartitions("conv", "kind", *_ORDER[1:])
    return both.select("conv", "kind", "role", "text", *_COUNTS, "audit").mapInArrow(lean(finish), schema)


class _Editor:
    """Follows an audit over the rows of a conversation."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def _put(self) -> str:
        put = _NAMES[PUT[self.state]]
        self.state = NEXT[self.state]
        return put

    def inserts(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._put(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = GOES[self.state, role[0]]
            yield role, text
        elif letter == "R":
            yield self._put(), text


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's figures and the digest of its repaired text, which is never held as a whole."""
    head, editor, digest, any_row = None, None, None, False
    kinds = [None, *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()]
    names = ["conv", *_COUNTS, "audit", "repaired_sha256"]
    out: list[tuple] = []

    def add(rows: Iterator[tuple[str, str]]) -> None:
        nonlocal any_row
        for role, text in rows:
            digest.update((("\n" if any_row else "") + f"{role}:{text}").encode())
            any_row = True

    def close() -> None:
        if editor is not None:
            add(editor.inserts())
            out.append((*head, digest.hexdigest()))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for whole in batches:
        kinds[0] = whole.schema.field(0).type
        for batch in (whole.slice(at, 1000) for at in range(0, whole.num_rows, 1000)):
            for conv, kind, role, text, *figures, audit in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if kind:
                    add(editor.row(role, text))
                    continue
                close()
                head, editor, digest, any_row = (conv, *figures, audit), _Editor(audit), hashlib.sha256(), False
                if len(out) > 2000:
                    yield batch_of(out)
                    out = []
    close()
    if out:
        yield batch_of(out)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that the edits leave, numbered within their conversation."""
    conv, editor, place = None, None, 0
    kinds = [None, pa.int64(), pa.string(), pa.string()]
    out: list[tuple] = []

    def add(rows: Iterator[tuple[str, str]]) -> None:
        nonlocal place
        for role, text in rows:
            out.append((conv, place, role, text))
            place += 1

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv", "place", "role", "text"])

    for whole in batches:
        kinds[0] = whole.schema.field(0).type
        for batch in (whole.slice(at, 1000) for at in range(0, whole.num_rows, 1000)):
            for key, kind, role, text, *_, audit in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if kind:
                    add(editor.row(role, text))
                    continue
                if editor is not None:
                    add(editor.inserts())
                conv, editor, place = key, _Editor(audit), 0
            yield batch_of(out)
            out.clear()
    if editor is not None:
        add(editor.inserts())
        yield batch_of(out)


def repaired_rows(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None
) -> DataFrame:
    """(conversation, place, role, text): the repaired conversations, row by row; odd input as in `structure`."""
    columns = (conversation, turn, role, text)
    kind = rows.schema[conversation].dataType.simpleString()
    found = _edited(rows, structure(rows, *columns, copies), columns, copies, _rows, f"conv {kind}, place bigint, role string, text string")
    return found.withColumnRenamed("conv", conversation)


def repair(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None
) -> DataFrame:
    """`structure` with repaired_sha256, the digest of the repaired `role:text` lines joined by line feeds.

    The digest of a conversation reads its text in order, so one task streams the conversation, a batch at a time; it holds the audit but not the texts.
    """
    columns = (conversation, turn, role, text)
    kind = rows.schema[conversation].dataType.simpleString()
    schema = _audit_schema("conv", kind) + ", repaired_sha256 string"
    found = _edited(rows, structure(rows, *columns, copies), columns, copies, _digests, schema)
    return found.withColumnRenamed("conv", conversation)
