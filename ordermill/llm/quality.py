"""Quality classifier: boosted trees over statistics of whole documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.boosting import BoostedTrees, fit
from ordermill.llm.shared import as_bytes, lean

#: Bytes counted one by one; the other features follow in `statistics`.
SIGNS = b"|!?.,;:*&%$#@()[]{}<>/\\\"'-_=+~^`0123456789"
N_FEATURES = len(SIGNS) + 22


def _class_of_byte() -> np.ndarray:
    kinds = np.full(256, 4, dtype=np.uint8)  # 4: other ASCII signs
    kinds[[9, 10, 11, 12, 13, 32]] = 0
    kinds[ord("a") : ord("z") + 1] = 1
    kinds[ord("A") : ord("Z") + 1] = 2
    kinds[ord("0") : ord("9") + 1] = 3
    kinds[128:192] = 5
    kinds[192:] = 6
    return kinds


_KIND = _class_of_byte()
_SIGNS = np.frombuffer(SIGNS, dtype=np.uint8)


def statistics(text: bytes) -> np.ndarray:
    """Shares of bytes, words and lines of a text, and how much of it repeats."""
    size = max(1, len(text))
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    kinds = np.bincount(_KIND, counts, 7)
    words, lines = text.split(), [line for line in text.split(b"\n") if line]
    n, m = max(1, len(words)), max(1, len(lines))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) if words else np.zeros(1, dtype=np.int64)
    forms: dict[bytes, int] = {}
    for word in words:
        forms[word] = forms.get(word, 0) + 1
    pairs = len(set(zip(words, words[1:], strict=False)))
    distinct_lines = set(lines)
    rest = [
        np.log1p(len(text)),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        *(kinds / size),
        kinds[2] / max(1, kinds[1] + kinds[2]),
        lengths.mean(),
        lengths.std(),
        lengths.max(),
        (lengths <= 3).mean(),
        (lengths > 12).mean(),
        len(forms) / n,
        max(forms.values(), default=0) / n,
        pairs / max(1, n - 1),
        len(distinct_lines) / m,
        1 - sum(map(len, distinct_lines)) / max(1, sum(map(len, lines))),
        len(words) / m,
    ]
    return np.concatenate([counts[_SIGNS] / size, rest])


def held_out(id_column: str = "doc_id") -> F.Column:
    """The third of the ids that no model learns from; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(
    docs: DataFrame, labels: DataFrame, sample: int = 20_000, id_column: str = "doc_id", text_column: str = "text", label: str = "quality"
) -> BoostedTrees:
    """Trees fitted on at most `sample` labelled ids outside the held-out third, those with the smallest hashes of their ids.

    Their features, at most `sample` rows for distinct ids, come to the driver, which fits the trees. An id that is labelled
    more than once has the rounded mean; null labels and labels of other ids count for nothing. Without labels the probability is 0.5.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull() & ~held_out(id_column))
        .groupBy(F.col(id_column).alias("_id"))
        .agg(F.round(F.avg(label)).cast("double").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample)
    )
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    chosen = rows.join(F.broadcast(known), "_id").select("_id", "_label", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(text).tobytes() for text in as_bytes(batch.column(2))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.binary())], ["_id", "label", "features"])

    id_type = docs.schema[id_column].dataType.simpleString()
    found = chosen.mapInArrow(lean(run), f"_id {id_type}, label double, features binary")
    got = found.orderBy("_id", "features").limit(sample).toArrow()
    values = np.frombuffer(b"".join(got.column("features").to_pylist()), dtype=np.float64).reshape(-1, N_FEATURES)
    return fit(values, got.column("label").to_numpy())


def scored(docs: DataFrame, model: BoostedTrees, text_column: str = "text", score: str = "score") -> DataFrame:
    """`docs` with the model's probability of label 1 as one more column; null and empty texts are scored by their (empty) statistics.

    A column of the input with that name is a ValueError.
    """
    if score in docs.columns:
        raise ValueError(f"the input already has {score}")
    at, names = docs.columns.index(text_column), [*docs.columns, score]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                values = np.array([statistics(text) for text in as_bytes(part.column(at))]).reshape(-1, N_FEATURES)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.probability(values))], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(lean(run), f"{fields}, `{score}` double")
