"""Published generations of a set of tables: who may publish next, and which folder holds which month."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordermill.session import file_system

#: The column that tables by month are in folders by, and the folder of rows without one.
MONTH = "order_month"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
CLAIMED = "_CLAIMED"
PART = (1 << 24) - 1
#: Publications are files of this folder, one after each generation: `after-00000003` names the generation that follows the third.
LOG = ".published"


class ConcurrentRun(RuntimeError):
    """Another run published after this one began."""


@dataclass(frozen=True)
class Manifest:
    """What a generation consists of.

    tables: for each table its schema and where its rows are: the generation that wrote it, or for a table by month the generation that wrote
    each month. marks: fingerprints of the source per month. batches: the names of the increments that are in it.
    """

    number: int
    base: int
    tables: dict[str, dict] = field(default_factory=dict)
    marks: dict[str, dict[str, list]] = field(default_factory=dict)
    batches: list[str] = field(default_factory=list)

    def written_by(self, table: str) -> dict[str, int]:
        """The generation that wrote each month of a table; a table without months is one entry, ''."""
        return self.tables[table]["months"]

    def schema_of(self, table: str) -> StructType:
        return StructType.fromJson(json.loads(self.tables[table]["schema"]))


def name_of(generation: int) -> str:
    return f"generation-{generation:08d}"


def month_name(month: str | None) -> str:
    return NO_MONTH if month is None else month


def claim(spark: SparkSession, root: str) -> int:
    """A generation number of this run's own. The claim is a file that only one run can create, so two runs never write into one folder."""
    number = max(existing(spark, root), default=0) + 1
    while True:
        path, system = file_system(spark, f"{root}/{name_of(number)}/{CLAIMED}")
        try:
            system.create(path, False).close()
            return number
        except Exception as error:  # py4j wraps the store's own exception
            if not system.exists(path):
                raise error
            number += 1


def existing(spark: SparkSession, root: str) -> list[int]:
    """All generation folders, finished or not."""
    return [int(name.removeprefix("generation-")) for name in _names(spark, root) if name.startswith("generation-")]


def published(spark: SparkSession, root: str) -> list[int]:
    """The published generations that are still there, in the order of publication."""
    here = set(existing(spark, root))
    found = sorted(json.loads(_read(spark, f"{root}/{LOG}/{name}"))["generation"] for name in _names(spark, f"{root}/{LOG}") if name.startswith("after-"))
    return [number for number in found if number in here]


def publish(spark: SparkSession, root: str, manifest: Manifest) -> None:
    """Make a generation the one that follows its base. Of two runs with the same base only one can; the other raises ConcurrentRun.

    The manifest is written first, the publication is the creation of one small file. On stores without exclusive creation two runs must be kept apart
    by other means.
    """
    _write(spark, f"{root}/{name_of(manifest.number)}/_manifest.json", json.dumps(manifest.__dict__))
    last = max(published(spark, root), default=0)
    if last != manifest.base:
        raise ConcurrentRun(f"generation {last} was published below {root} after this run read generation {manifest.base}")
    path = f"{root}/{LOG}/after-{manifest.base:08d}"
    try:
        _write(spark, path, json.dumps({"generation": manifest.number}))
    except Exception as error:
        place, system = file_system(spark, path)
        if system.exists(place):
            raise ConcurrentRun(f"another run published after generation {manifest.base} below {root}") from error
        raise


def manifest_of(spark: SparkSession, root: str, generation: int) -> Manifest:
    return Manifest(**json.loads(_read(spark, f"{root}/{name_of(generation)}/_manifest.json")))


def latest(spark: SparkSession, root: str) -> Manifest:
    """The manifest of the last published generation."""
    generations = published(spark, root)
    if not generations:
        raise FileNotFoundError(f"no finished run below {root}")
    return manifest_of(spark, root, max(generations))


def read_table(spark: SparkSession, root: str, manifest: Manifest, table: str, months: Sequence[str | None] | None = None) -> DataFrame:
    """A table of a generation: the union of the month folders that its manifest names, by column name; with `months`, of these alone.

    Each generation that wrote some of the months is one scan with the month as partition column, so filters and joins on it still leave
    out folders. Columns that an older generation did not have are null.
    """
    schema = manifest.schema_of(table)
    wanted = None if months is None else {month_name(month) for month in months}
    folders: dict[int, list[str]] = {}
    for month, generation in sorted(manifest.written_by(table).items()):
        if wanted is None or month in wanted:
            folders.setdefault(generation, []).append(month)
    parts = []
    for generation, names in sorted(folders.items()):
        base = f"{root}/{name_of(generation)}/{table}"
        everything = names == [""] or sorted(names) == sorted(months_in(spark, base))
        paths = [base] if everything else [f"{base}/{MONTH}={name}" for name in names]
        parts.append(spark.read.schema(schema).option("basePath", base).parquet(*paths))
    if not parts:
        return spark.createDataFrame([], schema)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def history(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, order_month, generation): which run wrote what the last published generation shows, one row per table and month."""
    manifest = latest(spark, root)
    rows = [
        (table, None if month in ("", NO_MONTH) else month, generation)
        for table in manifest.tables
        for month, generation in manifest.written_by(table).items()
    ]
    return spark.createDataFrame(rows, f"table_name string, {MONTH} string, generation int")


def point_names(spark: SparkSession, root: str, manifest: Manifest, prefix: str) -> list[str]:
    """Catalog views `<prefix>_<layer>_<name>` over the tables of a generation, which last as long as the catalog.

    A view is replaced in one step, so readers see the old tables or the new ones, never none. A table by month reads each generation's folder
    with a filter on the months that are still that generation's.
    """
    names = []
    for table in manifest.tables:
        schema = manifest.schema_of(table)
        columns = ", ".join(f"`{column.name}`" for column in schema)
        by: dict[int, list[str]] = {}
        for month, generation in sorted(manifest.written_by(table).items()):
            by.setdefault(generation, []).append(month)
        parts = []
        for generation, months in sorted(by.items()):
            source = f"SELECT {columns} FROM parquet.`{root}/{name_of(generation)}/{table}`"
            if months != [""]:
                known = ", ".join(f"'{month}'" for month in months if month != NO_MONTH)
                filters = ([f"{MONTH} IN ({known})"] if known else []) + ([f"{MONTH} IS NULL"] if NO_MONTH in months else [])
                source += f" WHERE {' OR '.join(filters)}"
            parts.append(source)
        if not parts:
            parts = [f"SELECT {', '.join(f'CAST(NULL AS {c.dataType.simpleString()}) AS `{c.name}`' for c in schema)} WHERE false"]
        name = f"{prefix}_{table.replace('/', '_')}"
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {' UNION ALL '.join(parts)}")
        names.append(name)
    return names


def clear(spark: SparkSession, root: str, keep: int) -> None:
    """Remove what the last `keep` published generations do not need: folders of failed and older runs, and of months written anew since."""
    kept = published(spark, root)[-keep:]
    manifests = [manifest_of(spark, root, number) for number in kept]
    needed = {(generation, table, month) for m in manifests for table in m.tables for month, generation in m.written_by(table).items()}
    for old in existing(spark, root):
        if not kept or old >= min(kept):
            continue  # a run that began before the last publication may still be writing above
        folder = f"{root}/{name_of(old)}"
        if not any(generation == old for generation, _, _ in needed):
            _delete(spark, folder)
            continue
        for table in {table for m in manifests for table in m.tables}:
            for name in _names(spark, f"{folder}/{table}"):
                month = name.removeprefix(f"{MONTH}=") if name.startswith(f"{MONTH}=") else ""
                if (old, table, month) not in needed and (month or name.startswith("part-")):
                    _delete(spark, f"{folder}/{table}/{name}")


def months_in(spark: SparkSession, folder: str) -> list[str]:
    """The months that a written table has folders of."""
    return [name.removeprefix(f"{MONTH}=") for name in _names(spark, folder) if name.startswith(f"{MONTH}=")]


def fingerprints(df: DataFrame, month) -> dict[str, list]:
    """For each month the number of rows and two sums over their hashes: equal for equal rows in any order, and sums of two tables are those of their union.

    The month column of a stored table is no part of a row.
    """
    hashed = F.xxhash64(*[F.col(f"`{name}`") for name in df.columns if name != MONTH])
    # Three sums of parts of the hash, put together here, take whole numbers where one sum would take a decimal for each row.
    low, middle = hashed.bitwiseAND(F.lit(PART)), F.shiftright(hashed, 24).bitwiseAND(F.lit(PART))
    rows = df.groupBy(month.alias("month")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(low).alias("low"),
        F.sum(middle).alias("middle"),
        F.sum(F.shiftright(hashed, 48)).alias("high"),
        F.bit_xor(hashed).alias("xor"),
    )
    return {
        month_name(row.month): [row.n, str((row.high << 48) + (row.middle << 24) + row.low), row.xor] for row in rows.collect()
    }


def added(left: Mapping[str, list], right: Mapping[str, list]) -> dict[str, list]:
    """The fingerprints of two tables together."""
    out = dict(left)
    for month, (n, total, xor) in right.items():
        before = out.get(month, [0, "0", 0])
        out[month] = [before[0] + n, str(int(before[1]) + int(total)), before[2] ^ xor]
    return out


def _names(spark: SparkSession, folder: str) -> list[str]:
    path, system = file_system(spark, folder)
    return [status.getPath().getName() for status in system.listStatus(path)] if system.exists(path) else []


def _delete(spark: SparkSession, folder: str) -> None:
    path, system = file_system(spark, folder)
    system.delete(path, True)


def _write(spark: SparkSession, file: str, text: str) -> None:
    path, system = file_system(spark, file)
    stream = system.create(path, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _read(spark: SparkSession, file: str) -> str:
    path, system = file_system(spark, file)
    stream = system.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    if not text:
        raise RuntimeError(f"{file} is empty: the run that created it ended at that moment; remove the file to go on")
    return text
