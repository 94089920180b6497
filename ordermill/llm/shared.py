"""Small helpers of the operators: staged tables, Arrow columns, first rows of groups, memory of tasks."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.session import new_folder


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """`df` written as Parquet in the shared folder and read back: its lineage ends there."""
    folder = f"{new_folder(df.sparkSession, name)}/table"
    df.write.parquet(folder, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null counts as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def with_first(rows: DataFrame, key: str, value: str, salt: Column, name: str, salts: int = 256) -> DataFrame:
    """`rows` with one column more: the smallest `value` of the rows with the same key, null where a row is alone with its key.

    Rows meet by the key and a part of `salt`, which should differ between the rows of a large group, so that no task has all of them; what is joined
    back is one row per key and part, and only for keys of several rows. Null keys meet no others. The rows are read twice.
    """
    salted = rows.withColumn(_SALT, F.pmod(F.xxhash64(salt), F.lit(salts)))
    parts = salted.groupBy(key, _SALT).agg(F.min(value).alias(name), F.count(F.lit(1)).alias(_ROWS))
    firsts = (
        parts.groupBy(key)
        .agg(F.min(name).alias(name), F.sum(_ROWS).alias(_ROWS), F.collect_list(_SALT).alias(_SALT))
        .where(F.col(_ROWS) > 1)
        .select(key, name, F.explode(_SALT).alias(_SALT))
    )
    return salted.join(firsts, [key, _SALT], "left").select(*rows.columns, name)


_SALT, _ROWS = "__first_salt", "__first_rows"


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], encodes: bool = False) -> Callable:
    """A task's function that gives its memory back to the machine when it ends.

    Python workers outlive their tasks, and allocators keep what was freed; several workers stand beside each executor's heap. The token ids that a
    worker remembers (`tokens.shared_encoder`) stay only until its next task that does not encode.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = sys.modules.get("ordermill.llm.tokens")
        if tokens and not encodes:
            tokens.shared_encoder.cache_clear()
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return wrapped
