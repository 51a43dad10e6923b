"""The columns that a dataset has had, and the one schema that reads all of it."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
)

from beaconmill import storage

HISTORY = "_columns"
_WHOLE = (ByteType, ShortType, IntegerType, LongType)


def wider(a: DataType, b: DataType) -> DataType | None:
    """The type that holds both and as which Parquet of either can be read, or None."""
    if a == b:
        return a
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    small = (ByteType, ShortType, IntegerType, FloatType)
    if all(isinstance(t, (*small, DoubleType)) for t in (a, b)):
        return DoubleType()
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale, whole = max(a.scale, b.scale), max(a.precision - a.scale, b.precision - b.scale)
        return DecimalType(scale + whole, scale) if scale + whole <= 38 else None
    if {type(a), type(b)} == {DateType, TimestampNTZType}:
        return TimestampNTZType()
    if isinstance(a, StructType) and isinstance(b, StructType):
        try:
            return merged([a, b])
        except ValueError:
            return None
    return None


def merged(schemas: Iterable[StructType]) -> StructType:
    """All columns in the order of their first appearance, nullable, as wide as needed.

    Names that differ in case only are one column. A column whose types no one type can
    hold is an error that names it, rather than values lost.
    """
    fields: dict[str, StructField] = {}
    for schema in schemas:
        for field in schema.fields:
            known = fields.get(field.name.lower())
            kind = field.dataType if known is None else wider(known.dataType, field.dataType)
            if kind is None:
                raise ValueError(f"column {field.name} is {known.dataType.simpleString()} in one part and {field.dataType.simpleString()} in another")
            fields[field.name.lower()] = StructField(field.name if known is None else known.name, kind, True)
    return StructType(list(fields.values()))


def record_columns(spark: SparkSession, path: str, part: str, schema: StructType) -> None:
    """Note the columns that a part of the dataset was written with; of a part added to, all it has had."""
    place = f"{path}/{HISTORY}/{part}.json"
    if storage.exists(spark, place):
        schema = merged([StructType.fromJson(json.loads(storage.read_text(spark, place))), schema])
        storage.remove(spark, place)
    storage.write_new(spark, place, schema.json())


def recorded_columns(spark: SparkSession, path: str) -> StructType | None:
    """The schema of all parts together, the earliest first, or None where none was noted."""
    found = [n for n in storage.names(spark, f"{path}/{HISTORY}") if n.endswith(".json")]
    found.sort(key=lambda n: (len(n), n))  # microseconds since the epoch, as numbers
    parts = [StructType.fromJson(json.loads(storage.read_text(spark, f"{path}/{HISTORY}/{n}"))) for n in found]
    return merged(parts) if parts else None
