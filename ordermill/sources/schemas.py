"""Which changes of a table's schema readers of several generations can bear."""

from __future__ import annotations

from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructField, StructType

#: A type's wider ones, which Parquet readers also give for files of the narrower.
_WIDER: dict[type, tuple[type, ...]] = {ShortType: (IntegerType, LongType), IntegerType: (LongType,), FloatType: (DoubleType,)}


class SchemaNarrowed(ValueError):
    """A column's type cannot hold what older generations have stored."""


def _wider(old: DataType, new: DataType) -> bool:
    if isinstance(old, DecimalType) and isinstance(new, DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return old.simpleString() == new.simpleString() or type(new) in _WIDER.get(type(old), ())


def widened(old: StructType, new: StructType, table: str = "table") -> StructType:
    """The schema that reads files of both by column name.

    Columns are told apart by name in any case. New columns come last and are null in older files; a column that is gone is null in newer ones. A type may get wider
    (whole numbers, float to double, decimals with no fewer digits on either side); any other change raises SchemaNarrowed.
    """
    later = {field.name.lower(): field for field in new.fields}
    fields: list[StructField] = []
    for field in old.fields:
        other = later.pop(field.name.lower(), None)
        if other is not None and not _wider(field.dataType, other.dataType):
            raise SchemaNarrowed(f"{table}.{field.name}: {field.dataType.simpleString()} cannot become {other.dataType.simpleString()}")
        fields.append(StructField(field.name, other.dataType if other is not None else field.dataType, True))
    return StructType([*fields, *(StructField(field.name, field.dataType, True) for field in new.fields if field.name.lower() in later)])
