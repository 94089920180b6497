"""Bronze tables: source rows under flat lowercase names and fixed types."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.order_time import ISO_MILLIS
from ordermill.sources.jdbc import SourceSchemaError, require_columns

UNREADABLE = "unreadable"
RESCUED = "rescued"

# Source names, target names in table order, and target types.
ITEM_NAMES = {
    "app_name": "appname",
    "restaurant_id": "restaurantid",
    "creation_time_utc": "creationtimeutc",
    "order_id": "orderid",
    "user_id": "userid",
    "printed_card_number": "printedcardnumber",
    "is_loyalty": "isloyalty",
    "lineitem_id": "lineitemid",
    "item_category": "itemcategory",
    "item_name": "itemname",
    "item_price": "itemprice",
    "item_quantity": "itemquantity",
}
ITEM_COLUMNS = (
    "appname", "restaurantid", "creationtimeutc", "orderid", "userid", "printedcardnumber", "isloyalty",
    "currency", "lineitemid", "itemcategory", "itemname", "itemprice", "itemquantity",
)
ITEM_TYPES = {
    "restaurantid": "string",
    "orderid": "string",
    "userid": "string",
    "lineitemid": "int",
    "itemprice": "decimal(10,2)",
    "itemquantity": "int",
    "isloyalty": "boolean",
}
OPTION_NAMES = {
    "ORDER_ID": "orderid",
    "LINEITEM_ID": "lineitemid",
    "OPTION_GROUP_NAME": "optiongroupname",
    "OPTION_NAME": "optionname",
    "OPTION_PRICE": "optionprice",
    "OPTION_QUANTITY": "optionquantity",
}
OPTION_TYPES = {
    "orderid": "string",
    "lineitemid": "string",
    "optionprice": "decimal(10,2)",
    "optionquantity": "int",
}


def _resolved(raw: DataFrame, names: Mapping[str, str], needed: Iterable[str]) -> DataFrame:
    """`raw` with known columns under their target names, whatever the case of the source's names.

    A source column may have its source name or the target name. Two of them for one target are an error.
    """
    wanted = {source.lower(): target for source, target in names.items()} | {t.lower(): t for t in names.values()}
    targets: dict[str, str] = {}
    for column in require_columns(raw).columns:
        target = wanted.get(column.lower(), column)
        if target in targets:
            raise SourceSchemaError(f"both {targets[target]} and {column} are {target}")
        targets[target] = column
    return require_columns(raw.toDF(*targets), tuple(needed))


def _typed(name: str, kind: str) -> Column:
    column = F.col(name)
    return F.date_format(column.try_cast("timestamp"), ISO_MILLIS) if kind == ISO_MILLIS else column.try_cast(kind)


def _lost(columns: Mapping[str, str]) -> dict[str, Column]:
    """For each column whether its value does not fit its type."""
    return {c: F.col(c).isNotNull() & F.col(c).try_cast("timestamp" if kind == ISO_MILLIS else kind).isNull() for c, kind in columns.items()}


def _listed(parts: Iterable[tuple[Column, Column]], some: Column) -> Column:
    """The values, of the type of `some`, whose conditions hold.

    `concat` is compiled with the other expressions of a row, `array_compact` of an array of them is not.
    """
    nothing = F.slice(F.array(some), 1, 0)
    return F.concat(nothing, *[F.when(condition, F.array(value)).otherwise(nothing) for condition, value in parts])


def _entry(name: Column, text: Column) -> Column:
    return F.struct(name.alias("k"), text.alias("v"))


def _variant(parts: Iterable[tuple[Column, Column, Column]]) -> Column:
    """The names and texts whose conditions hold as one VARIANT; NULL where none does."""
    parts = list(parts)
    entries = _listed([(condition, _entry(name, text)) for condition, name, text in parts], _entry(F.lit(""), F.lit("")))
    some = reduce(or_, [condition for condition, _, _ in parts], F.lit(False))
    return F.when(some, F.to_variant_object(F.map_from_entries(entries)))


def unreadable(columns: Mapping[str, str]) -> Column:
    """Names of the columns that hold a value which does not fit its type."""
    return _listed([(is_lost, F.lit(c)) for c, is_lost in _lost(columns).items()], F.lit("")).alias(UNREADABLE)


def rescued(columns: Mapping[str, str]) -> Column:
    """The source's own texts of the values that do not fit their types, by column, as one VARIANT; NULL where all fit."""
    return _variant((is_lost, F.lit(c), F.col(c).cast("string")) for c, is_lost in _lost(columns).items()).alias(RESCUED)


def repaired(df: DataFrame, readers: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """A bronze table with rescued values read again: `readers` gives for a column how to read its source text.

    What a reader makes of a text, cast to the column's type, takes the NULL's place. Texts that still cannot be read stay in the rescued column (and a traced
    table still names their columns); columns without a reader are left as they are. Rows without rescued values do not change.
    """
    kinds = dict(df.dtypes)

    def text(column: str) -> Column:
        return F.try_variant_get(F.col(RESCUED), f"$.{column}", "string")

    again = {c: F.coalesce(F.col(c), read(text(c)).try_cast(kinds[c])) for c, read in readers.items()}
    some = F.col(RESCUED).isNotNull()  # most rows have none, and nothing is looked up in them
    left = _variant(
        (text(c).isNotNull() & again.get(c, F.lit(None)).isNull(), F.lit(c), text(c)) for c in df.columns if c not in (RESCUED, UNREADABLE)
    )
    changed = again | {RESCUED: F.when(some, left)}
    if UNREADABLE in df.columns:
        read = _listed([(text(c).isNotNull() & value.isNotNull(), F.lit(c)) for c, value in again.items()], F.lit(""))
        changed[UNREADABLE] = F.when(some, F.array_except(UNREADABLE, read)).otherwise(F.col(UNREADABLE))
    return df.withColumns(changed)


def bronze_order_items(raw: DataFrame, trace: bool = False, rescue: bool = False) -> DataFrame:
    """Order lines. Columns without a fixed type may be missing; those with one may not.

    A value that does not fit its type becomes NULL; with `trace` a further column names such columns, with `rescue` one has
    their values as the source had them (see `repaired`).
    """
    df = _resolved(raw, ITEM_NAMES | {"currency": "currency"}, ITEM_TYPES)
    kinds = {c: ISO_MILLIS if c == "creationtimeutc" else ITEM_TYPES.get(c) for c in ITEM_COLUMNS if c in df.columns}
    columns = [_typed(c, kind).alias(c) if kind else F.col(c) for c, kind in kinds.items()]
    typed = {c: k for c, k in kinds.items() if k}
    return df.select(*columns, *[unreadable(typed)] * trace, *[rescued(typed)] * rescue)


def bronze_order_item_options(raw: DataFrame, trace: bool = False, rescue: bool = False) -> DataFrame:
    """Options of order lines. Columns the library does not know are kept as they are."""
    df = _resolved(raw, OPTION_NAMES, OPTION_TYPES)
    columns = [_typed(c, OPTION_TYPES[c]).alias(c) if c in OPTION_TYPES else F.col(f"`{c}`") for c in df.columns]
    return df.select(*columns, *[unreadable(OPTION_TYPES)] * trace, *[rescued(OPTION_TYPES)] * rescue)
