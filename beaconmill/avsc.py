"""Schema documents of Avro (``.avsc``) as Spark schemas."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# Names that the Avro specification gives to types, and Spark's own types for them.
PRIMITIVE = {
    "null": NullType(),
    "boolean": BooleanType(),
    "int": IntegerType(),
    "long": LongType(),
    "float": FloatType(),
    "double": DoubleType(),
    "bytes": BinaryType(),
    "string": StringType(),
}
LOGICAL = {
    ("int", "date"): DateType(),
    ("int", "time-millis"): IntegerType(),
    ("long", "time-micros"): LongType(),
    ("long", "timestamp-millis"): TimestampType(),
    ("long", "timestamp-micros"): TimestampType(),
    ("long", "local-timestamp-millis"): TimestampNTZType(),
    ("long", "local-timestamp-micros"): TimestampNTZType(),
    ("string", "uuid"): StringType(),
}


def compile_avsc(document: str | Mapping | list) -> StructType:
    """The ``StructType`` of a document whose type is a record.

    Records, arrays, maps, enums, fixed, unions, logical types, and names defined earlier in
    the document, with their namespaces, are understood. A union with ``null`` is a nullable
    type; of several others ``int`` with ``long`` is a long, ``float`` with ``double`` a double, and any
    other a struct of ``member0, member1, ...``, as Spark reads Avro itself. A logical type
    that is unknown, or does not go with its type, is ignored, as the specification wants. A
    type that holds itself has no Spark schema and is an error.

    JSON that Avro's own encoder writes wraps each union value in an object that names its
    type; plain JSON as producers send it has the bare value, which is what the schema is for.
    """
    given = json.loads(document) if isinstance(document, str) else document
    found, _ = _Compiler().type_of(given, "")
    if not isinstance(found, StructType):
        raise ValueError(f"the schema's type is {found.simpleString()}, not a record")
    return found


class _Compiler:
    def __init__(self) -> None:
        self.known: dict[str, DataType | None] = {}  # None while a type is being read

    def type_of(self, given: str | Mapping | list, namespace: str) -> tuple[DataType, bool]:
        """The type, and whether it may be null."""
        if isinstance(given, list):
            return self._union(given, namespace)
        if isinstance(given, str):
            return (PRIMITIVE[given], given == "null") if given in PRIMITIVE else (self._named(given, namespace), False)
        kind = given.get("type")
        if isinstance(kind, (list, Mapping)):  # {"type": {...}}: as good as what it holds
            return self.type_of(kind, namespace)
        if kind in ("record", "error", "enum", "fixed"):
            return self._define(given, kind, namespace), False
        if kind == "array":
            items, null = self.type_of(given["items"], namespace)
            return ArrayType(items, null), False
        if kind == "map":
            values, null = self.type_of(given["values"], namespace)
            return MapType(StringType(), values, null), False
        plain, null = self.type_of(kind, namespace)
        return self._logical(given, kind, plain), null

    def _logical(self, given: Mapping, kind: str, plain: DataType) -> DataType:
        name = given.get("logicalType")
        if name == "decimal" and kind in ("bytes", "fixed"):
            precision, scale = given.get("precision", 0), given.get("scale", 0)
            return DecimalType(precision, scale) if 0 < precision <= 38 and 0 <= scale <= precision else plain
        return LOGICAL.get((kind, name), plain)

    def _define(self, given: Mapping, kind: str, namespace: str) -> DataType:
        name = given["name"]
        full = name if "." in name else ".".join(filter(None, (given.get("namespace", namespace), name)))
        inner = full.rpartition(".")[0]
        if kind == "enum":
            found: DataType = StringType()
        elif kind == "fixed":
            found = self._logical(given, kind, BinaryType())
        else:
            self.known[full] = None
            found = StructType([self._field(field, inner) for field in given["fields"]])
        for alias in (full, *(a if "." in a else ".".join(filter(None, (inner, a))) for a in given.get("aliases", ()))):
            self.known[alias] = found
        return found

    def _field(self, field: Mapping, namespace: str) -> StructField:
        found, null = self.type_of(field["type"], namespace)
        metadata = {"comment": field["doc"]} if field.get("doc") else None
        # a default stands for a field that is left out, so it may be missing from the data
        return StructField(field["name"], found, null or "default" in field, metadata)

    def _named(self, name: str, namespace: str) -> DataType:
        full = name if "." in name or not namespace else f"{namespace}.{name}"
        full = full if full in self.known else name
        if full not in self.known:
            raise ValueError(f"the type {name!r} is not defined before it is used")
        found = self.known[full]
        if found is None:
            raise ValueError(f"the record {name!r} holds itself, which no Spark schema can say")
        return found

    def _union(self, members: list, namespace: str) -> tuple[DataType, bool]:
        found = [self.type_of(m, namespace)[0] for m in members]
        types = [t for t in found if not isinstance(t, NullType)]
        null = len(types) < len(found)
        if not types:
            return NullType(), True
        if len(types) == 1:
            return types[0], null
        if all(isinstance(t, (IntegerType, LongType)) for t in types):
            return LongType(), null
        if all(isinstance(t, (FloatType, DoubleType)) for t in types):
            return DoubleType(), null
        return StructType([StructField(f"member{i}", t, True) for i, t in enumerate(types)]), null
