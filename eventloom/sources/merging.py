"""What becomes of a table's schema when rows of another schema are added.

New columns are added, numbers and dates are widened where the Parquet reader can read
the older files as the wider type; anything else is a conflict, and nothing is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
)

_WHOLE = (ByteType, ShortType, IntegerType, LongType)


class SchemaConflict(ValueError):
    """Rows that a table cannot hold: no common type for a column."""


def _wider(one: DataType, two: DataType) -> DataType | None:
    """The one of two plain types that can hold both."""
    for small, large in ((one, two), (two, one)):
        if isinstance(small, NullType):
            return large
        if isinstance(small, _WHOLE) and isinstance(large, _WHOLE):
            return max(small, large, key=lambda t: _WHOLE.index(type(t)))
        if isinstance(small, (ByteType, ShortType, IntegerType, FloatType)) and isinstance(large, DoubleType):
            return large
        if isinstance(small, DateType) and isinstance(large, TimestampNTZType):
            return large
        if isinstance(small, DecimalType) and isinstance(large, DecimalType):
            whole = large.precision - large.scale >= small.precision - small.scale
            if whole and large.scale >= small.scale:
                return large
    return None


def merged_type(one: DataType, two: DataType, at: str) -> DataType:
    """A type for both; raises where there is none. Nested fields are merged like columns."""
    if isinstance(one, StructType) and isinstance(two, StructType):
        return merged_schema(one, two, at)
    if isinstance(one, ArrayType) and isinstance(two, ArrayType):
        return ArrayType(merged_type(one.elementType, two.elementType, f"{at}.element"))
    if isinstance(one, MapType) and isinstance(two, MapType):
        key = merged_type(one.keyType, two.keyType, f"{at}.key")
        return MapType(key, merged_type(one.valueType, two.valueType, f"{at}.value"))
    if one == two:
        return one
    found = _wider(one, two)
    if found is None:
        raise SchemaConflict(f"column {at}: {two.simpleString()} does not go with {one.simpleString()}")
    return found


def merged_schema(known: StructType, new: StructType, at: str = "") -> StructType:
    """The columns of both, in the table's order, new ones behind; names differ by more than case."""
    added = {field.name.lower(): field for field in new.fields}
    fields = []
    for field in known.fields:
        other = added.pop(field.name.lower(), None)
        name = f"{at}.{field.name}".lstrip(".")
        kind = field.dataType if other is None else merged_type(field.dataType, other.dataType, name)
        fields.append(StructField(field.name, kind))
    return StructType([*fields, *[StructField(field.name, field.dataType) for field in added.values()]])


def plain(schema: StructType) -> StructType:
    """The schema with all columns nullable, as files are read."""
    return merged_schema(schema, schema)


def _shaped(column: Column, have: DataType, want: DataType) -> Column:
    return column if have == want else column.cast(want)


def fitted(df: DataFrame, schema: StructType) -> DataFrame:
    """The rows of `df` with the schema's names and types, columns they lack left out."""
    wanted = {field.name.lower(): field for field in schema.fields}
    columns = []
    for field in df.schema.fields:
        target = wanted[field.name.lower()]
        columns.append(_shaped(F.col(f"`{field.name}`"), field.dataType, target.dataType).alias(target.name))
    return df.select(*columns)
