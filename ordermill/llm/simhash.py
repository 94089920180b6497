"""Near-duplicates by SimHash, compared bit-sliced in blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.bitslice import forest_within, pairs_within
from ordermill.llm.components import connected_components
from ordermill.llm.shared import as_bytes, lean, staged

_ID, _KEY = "__near_id", "__near_key"


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of `size` words of the text with A-Z in lower case; repeats stay.

    Words are split by ASCII white space. A text of fewer words gives one hash of all its words, one without words none.
    """
    words = text.lower().split()
    if not words:
        return np.array([], dtype="<u8")
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(joined, 42)], dtype="<u8")
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: 1 - size or None].tolist()
    return np.array(
        [digest(joined[s:e], 42) for s, e in zip(starts, ends[size - 1 :].tolist(), strict=True)], dtype="<u8"
    )


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes."""
    if not len(hashes):
        return 0
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fp): the 64-bit SimHash of every row as a long; null and empty texts have 0. No shuffle."""
    id_type = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(shingle_hashes(text, shingle)) for text in as_bytes(batch.column(1))]
            values = np.array(found, dtype="<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], [id_column, "fp"])

    return docs.select(id_column, text_column).mapInArrow(lean(run), f"`{id_column}` {id_type}, fp bigint")


def block_masks(radius: int, spare: int = 1) -> list[int]:
    """Masks of bits of which at least one set is equal in any two fingerprints at most `radius` bits apart.

    64 bits in radius + spare + 1 blocks: `radius` flips leave spare + 1 blocks untouched, so every choice of
    that many blocks is a mask. More spare blocks mean longer keys in more tables, for larger corpora.
    """
    edges = np.linspace(0, 64, radius + spare + 2).round().astype(int).tolist()
    blocks = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(blocks, spare + 1)]


def _block_cells(rows: DataFrame, radius: int) -> DataFrame:
    """`rows` (..., fp) once in each table of `block_masks`, with the cell that they share with all rows of the same masked bits."""
    keys = F.array(
        *[
            F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)).alias("key"))
            for t, mask in enumerate(block_masks(radius))
        ]
    )
    return rows.select(F.explode(keys).alias("key"), *rows.columns).select(F.xxhash64("key").alias("cell"), *rows.columns)


def _dealt(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """`rows` (cell, node, ...) with each cell of `sizes` (cell, parts) in one task, sorted by cell and node.

    Rows of a cell of more than one part get a part number and go to every pair of parts; each pair is then a cell of its own.
    """
    parts = F.col("parts")
    part = F.pmod(F.xxhash64("node"), parts).cast("int")
    meetings = F.transform(
        F.sequence(F.lit(0), parts - 1), lambda other: F.struct(F.least(part, other).alias("p"), F.greatest(part, other).alias("q"))
    )
    one = F.array(F.struct(F.lit(0).alias("p"), F.lit(0).alias("q")))
    rest = [name for name in rows.columns if name != "cell"]
    return (
        rows.join(sizes.where(parts > 1), "cell", "left")
        .select("cell", F.explode(F.when(parts.isNull(), one).otherwise(meetings)).alias("meeting"), *rest)
        .select(F.xxhash64("cell", "meeting").alias("cell"), *rest)
        .repartition("cell")
        .sortWithinPartitions("cell", "node")
    )


def _whole_cells(batches: Iterator[pa.RecordBatch], rows: int = 50_000, size: int = 1 << 25) -> Iterator[pa.Table]:
    """Tables of about so many rows or bytes, each of whole cells; the first column is the cell, in sorted order."""
    held: list[pa.RecordBatch] = []
    count = weight = 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        weight += batch.nbytes
        if count >= rows or weight >= size:
            table = pa.Table.from_batches(held).combine_chunks()
            cell = table.column(0).to_numpy()
            cut = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on in the next batch
            if cut:
                yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
            count = table.num_rows - cut
            weight = sum(batch.nbytes for batch in held)
    if count:
        yield pa.Table.from_batches(held)


def near_links(cells: DataFrame, node: str, radius: int, chunk: int = 4096) -> DataFrame:
    """(a, b, distance): links between rows of `cells` (cell, node, fp) of one cell that are at most `radius` bits apart.

    All that lie within the radius in a cell are connected by the links, nearest pairs first; further pairs among the connected are
    not written out, so a cell of near copies gives as many links as rows, not all pairs.

    Cells are compared in the order of a sort, many in one step of numpy. A cell of over `chunk` rows is split: its
    rows get a part number and go to every pair of parts, so each task holds at most two parts and no pair is lost.
    """
    sizes = cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("parts"))
    dealt = _dealt(cells.select("cell", F.col(node).alias("node"), "fp"), sizes)
    node_type = cells.schema[node].dataType.simpleString()

    def links(cell: np.ndarray, nodes: pa.Array, fps: np.ndarray) -> pa.RecordBatch:
        i, j, distance = forest_within(cell, fps.view("<u8"), radius)
        ends = [nodes.take(pa.array(k)) for k in (i, j)]
        return pa.RecordBatch.from_arrays([*ends, pa.array(distance)], ["a", "b", "distance"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_cells(batches):
            yield links(table.column(0).to_numpy(), table.column(1).combine_chunks(), table.column(2).to_numpy())

    return dealt.mapInArrow(lean(run), f"a {node_type}, b {node_type}, distance bigint")


def simhash_components(
    docs: DataFrame, shingle: int = 4, radius: int = 4, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, fp, component_id): the documents linked by fingerprints at most `radius` bits apart, with no pair lost.

    component_id is the smallest id reachable over such links, itself included; of null ids alone it is null. Equal fingerprints are one node, so
    exact copies cost one row each and are never compared. Distinct fingerprints meet in the tables of `block_masks`.

    Null and empty texts have fingerprint 0 and are linked like others. Rows that repeat an id are separate rows. Other
    columns are not read. An empty table gives no rows.
    """
    prints = staged(fingerprints(docs, shingle, id_column, text_column), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min(id_column).alias("first"))
    roots = connected_components(near_links(_block_cells(nodes.select("fp"), radius), "fp", radius), "a", "b")
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(id_column, "fp", "component_id")


def _band_keys(hashes: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """One key per row of multipliers: of the smallest hash in each of the row's orders."""
    smallest = np.full(multipliers.shape, 0xFFFFFFFFFFFFFFFF, dtype="<u8")
    for at in range(0, len(hashes), 2048):
        part = hashes[at : at + 2048]
        smallest = np.minimum(smallest, (part[:, None, None] * multipliers).min(axis=0))
    key = np.zeros(len(multipliers), dtype="<u8")
    for column in range(multipliers.shape[1]):
        key = (key ^ smallest[:, column]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view("<i8")


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """`docs` with two columns that tell its rows apart: the id without nulls, and a hash of id and text."""
    bare = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return docs.withColumns({_ID: bare, _KEY: F.xxhash64(bare, F.col(id_column).isNull(), text_column)})


def _sketches(rows: DataFrame, shingle: int, multipliers: np.ndarray) -> DataFrame:
    """Digest of the word sequence, SimHash and band keys instead of the text, which is the last column of `rows`.

    The SimHash is that of the distinct shingles, as the similarity is that of sets; `fingerprints` counts repeats.
    """
    names = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, prints, keys = [], [], []
            for text in as_bytes(batch.column(len(names))):
                hashes = np.unique(shingle_hashes(text, shingle))
                digests.append(_word_digest(text))
                prints.append(fingerprint(hashes))
                keys.append(_band_keys(hashes, multipliers))
            columns = [
                pa.array(digests),
                pa.array(np.array(prints, dtype="<u8").view("<i8")),
                pa.array(keys, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*names, "words", "fp", "bands"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(lean(run), f"{kept}, words string, fp bigint, bands array<bigint>")


def _word_digest(text: bytes) -> str:
    return xxhash.xxh3_128_hexdigest(b" ".join(text.lower().split()))


def _shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(words, shingles): the distinct shingle hashes of each text, sorted, their upper 32 bits each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(0))
            sets = [np.unique((shingle_hashes(text, shingle) >> np.uint64(32)).astype("<u4")).tobytes() for text in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_word_digest(text) for text in texts]), pa.array(sets, pa.binary())], ["words", "shingles"]
            )

    return texts.mapInArrow(lean(run), "words string, shingles binary").dropDuplicates(["words"])


def _similar(pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b, left, right) whose shingle sets have this Jaccard similarity or more; two empty sets are equal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                both = np.intersect1d(np.frombuffer(left, "<u4"), np.frombuffer(right, "<u4"), assume_unique=True).size
                either = (len(left) + len(right)) // 4 - both
                keep.append(both >= similarity * either)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "left", "right").mapInArrow(lean(run), "a string, b string")


def _joined(
    cell: np.ndarray, fps: np.ndarray, label: np.ndarray, sets: list[np.ndarray], radius: int, similarity: float
) -> list[tuple[int, int]]:
    """Pairs of rows of one cell and of different labels that are within the radius and similar, as many as connect all such pairs.

    A pair is passed over only if pairs that were found similar, or labels, connect its ends already.
    """
    parent = np.arange(label.max() + 1)

    def find(labels: np.ndarray) -> np.ndarray:
        found = parent[labels]
        while (found != parent[found]).any():
            found = parent[found]
        return found

    sizes = np.array([len(one) for one in sets])
    edges = np.concatenate([[0], np.cumsum(sizes)])
    values, codes = np.unique(np.concatenate(sets), return_inverse=True)
    marked = np.zeros(len(values), dtype=bool)
    links = []
    for i, j, _ in pairs_within(cell, fps, radius):
        apart = find(label[i]) != find(label[j])
        if not apart.any():
            continue
        i, j = i[apart], j[apart]
        order = np.lexsort((j, i))
        i, j = i[order], j[order]
        firsts, starts = np.unique(i, return_index=True)
        for row, others in zip(firsts.tolist(), np.split(j, starts[1:]), strict=True):
            mine = codes[edges[row] : edges[row + 1]]
            marked[mine] = True
            for at in range(0, len(others), 256):
                part = others[at : at + 256]
                part = part[find(label[part]) != find(label[row : row + 1])]
                if not len(part):
                    continue
                counts = np.cumsum(marked[np.concatenate([codes[edges[k] : edges[k + 1]] for k in part.tolist()])])
                both = np.diff(np.append(0, counts)[np.append(0, np.cumsum(sizes[part]))])
                for other in part[both >= similarity * (sizes[row] + sizes[part] - both)].tolist():
                    a, b = find(label[[row, other]]).tolist()
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        links.append((row, other))
            marked[mine] = False
    return links


def _missed_links(cells: DataFrame, sets: DataFrame, radius: int, similarity: float, chunk: int = 4096, size: int = 1 << 23) -> DataFrame:
    """(a, b): roots to join as similar texts of theirs, within the radius, share a cell of `cells` (cell, node, fp, root).

    Of every cell with several roots all pairs of different roots are compared by the sets (words, shingles) themselves, until they are
    joined. A cell of two needs no second look: its only pair was a nearest one. Cells of over `chunk` rows or `size` bytes of sets are split.
    """
    mixed = (
        cells.groupBy("cell")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n"))
        .where("low < high and n > 2")
        .select("cell")
    )
    rows = cells.join(mixed, "cell", "left_semi").join(sets.withColumnRenamed("words", "node"), "node")
    rows = staged(rows.select("cell", "node", "fp", "root", "shingles"), "mixed")
    parts = F.greatest(F.count(F.lit(1)) / chunk, F.sum(F.length("shingles")) / size)
    dealt = _dealt(rows, rows.groupBy("cell").agg(F.ceil(parts).cast("int").alias("parts")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_cells(batches):
            root = table.column(3).combine_chunks()
            label = root.dictionary_encode().indices.to_numpy()
            sets = [np.frombuffer(value, "<u4") for value in table.column(4).to_pylist()]
            links = _joined(table.column(0).to_numpy(), table.column(2).to_numpy().view("<u8"), label, sets, radius, similarity)
            ends = [root.take(pa.array([link[k] for link in links], pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(ends, ["a", "b"])

    return dealt.mapInArrow(lean(run), "a string, b string")


def drop_near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    similarity: float = 0.8,
    radius: int = 31,
    bands: int = 25,
    rows: int = 4,
    near: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of `docs` with one document of each group of near copies left, the one with the smallest id.

    Two documents are near copies if their sets of word shingles (A-Z in lower case) have a Jaccard similarity of
    `similarity` or more; groups are what such pairs connect. SimHashes meet in the tables of `block_masks`, as in `simhash_components`, which
    finds all that are at most `near` bits apart. At 0.8 two SimHashes differ in ten bits on average, too many for such tables, and in over `radius` with
    a chance of 1e-10, 2e-8 for texts of four or five shingles (over 22 bits: 0.00003 and 0.0009). So documents also meet where a band of
    `rows` smallest hashes agrees (at 0.8 a pair misses all 25 bands with a chance of 0.000002). In both SimHashes are compared
    bit-sliced, the nearest links that connect a cell are kept, and the texts at their ends are compared exactly. Cells of tables and bands that
    these leave in several groups are compared once more, all pairs of different groups within `near` or the radius, by their shingle sets.

    Texts with the same words in the same order are one node from the start. Null and empty texts are copies of each
    other. Of rows that repeat both id and text one stays; rows that share an id but not the text are separate documents.
    Null ids stand after all others. All columns are kept; an empty table stays empty.
    """
    multipliers = np.random.default_rng(20240607).integers(0, 1 << 63, (bands, rows), dtype="<u8") * np.uint64(2)
    keyed = _keyed(docs, id_column, text_column)
    sketches = staged(_sketches(keyed.select(id_column, _ID, _KEY, text_column), shingle, multipliers + np.uint64(1)), "sketches")
    best = F.min(F.struct(F.col(id_column).isNull().alias("none"), id_column, _ID, _KEY)).alias("best")
    distinct = sketches.groupBy("words").agg(best, F.any_value("fp").alias("fp"), F.any_value("bands").alias("bands"))
    cells = distinct.select(F.posexplode("bands").alias("band", "key"), "words", "fp").select(
        F.xxhash64("band", "key").alias("cell"), "words", "fp"
    )
    tables = _block_cells(distinct.select("words", "fp"), near)
    met = near_links(tables, "words", near).unionByName(near_links(cells, "words", radius))
    links = staged(met.select("a", "b").distinct(), "candidates")
    ends = links.select(F.explode(F.array("a", "b")).alias("words")).distinct()
    first = distinct.join(ends, "words").select("best.*")
    sets = staged(_shingle_sets(keyed.join(first.select(_ID, _KEY), [_ID, _KEY]).select(text_column), shingle), "shingles")
    pairs = (
        links.join(sets.select(F.col("words").alias("a"), F.col("shingles").alias("left")), "a")
        .join(sets.select(F.col("words").alias("b"), F.col("shingles").alias("right")), "b")
    )
    roots = connected_components(_similar(pairs, similarity), "a", "b")
    named = ends.join(roots, F.col("words") == F.col("node"), "left").select("words", F.coalesce("root", "words").alias("root"))

    def missed_in(cells: DataFrame, radius: int) -> DataFrame:
        rooted = cells.join(named, "words").select("cell", F.col("words").alias("node"), "fp", "root")
        return _missed_links(rooted, sets, radius, similarity)

    missed = staged(missed_in(cells, radius).unionByName(missed_in(tables, near)).distinct(), "missed")
    if not missed.isEmpty():
        roots = connected_components(missed.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))), "a", "b")
    groups = sketches.groupBy("words").agg(best).join(roots, F.col("words") == F.col("node"), "left")
    keepers = groups.groupBy(F.coalesce("root", "words").alias("root")).agg(F.min("best").alias("best"))
    kept = keyed.join(keepers.select(f"best.{_ID}", f"best.{_KEY}"), [_ID, _KEY])
    return kept.dropDuplicates([_ID, _KEY]).select(docs.columns)
