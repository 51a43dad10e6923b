"""JSON of any layout in one folder: an object or an array to a line, or to a file."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from beaconmill.schemas import MALFORMED

LINES, WHOLE = "lines", "whole"
BLANK = " \t\r\n\ufeff"


def read_json_mixed(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """Every JSON object below ``path``, one row each, with the text of what is none in ``_corrupt_record``.

    Each file is read by its own layout. Where every line is an object or an array by itself, or
    no sense can be made of the file as a whole, its lines are read, in splits like any
    text. Where lines are but parts of a value, the file is read as one, in one task, as
    Spark does with ``multiLine``. Arrays give a row for each element. A text that does not
    parse, an element that is no object, and an object with a value that does not fit the
    schema come out with what fits, and the text in ``_corrupt_record``: nothing is lost or
    silently NULL.

    Without a schema it is that of all objects together, found in one pass over them. To
    choose the layouts every line is parsed once more, without a shuffle of texts; the driver gets
    the names of the files that have to be read whole.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    layouts = file_layouts(spark, path)
    whole = sorted(r.file for r in layouts.filter(F.col("layout") == WHOLE).select("file").collect())
    lines = _text(spark, path)
    if whole:
        # left out by name: a list of files, which the scan's own file column is compared with
        lines = lines.join(spark.createDataFrame([(f,) for f in whole], "file string"), "file", "left_anti")
    texts = lines.select("value")
    if whole:
        texts = texts.unionByName(_text(spark, [_escaped(f) for f in whole], whole=True).select("value"))
    elements = _elements(texts)
    if schema is None:
        schema = _common_schema(elements)
    return _typed(elements, schema)


BLANK = " \t\r\n﻿"


def _text(spark: SparkSession, path: str | list[str], whole: bool = False) -> DataFrame:
    text = spark.read.option("recursiveFileLookup", True).text(path, wholetext=whole)
    value = F.btrim("value", F.lit(BLANK))
    return text.select(value.alias("value"), F.col("_metadata.file_path").alias("file")).filter("value <> ''")


def file_layouts(spark: SparkSession, path: str) -> DataFrame:
    """``(file, layout)``: ``whole`` for files whose lines are parts of one value, else ``lines``.

    Only files with a line that is no object or array by itself are tried as a whole; such a file is
    whole if it parses. The driver gets the names of those tried.
    """
    alone = _is_container(_parsed())
    files = _text(spark, path).groupBy("file").agg(F.count_if(~alone).alias("parts"))
    suspects = [r.file for r in files.filter("parts > 0").select("file").collect()]
    if not suspects:
        return files.select("file", F.lit(LINES).alias("layout"))
    tried = _text(spark, [_escaped(f) for f in suspects], whole=True)
    fits = tried.filter(_is_container(_parsed())).select("file", F.lit(True).alias("fits"))
    return files.join(fits, "file", "left").select("file", F.when(F.col("fits"), WHOLE).otherwise(LINES).alias("layout"))


def _escaped(file: str) -> str:
    """A file's own name as a path: what would be a pattern stands for itself."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))


def _parsed(value: str = "value") -> Column:
    """The text as a variant, NULL unless it is just one value: Spark stops reading after the first."""
    alone = F.json_array_length(F.concat(F.lit("["), value, F.lit("]"))) == 1
    return F.when(alone, F.try_parse_json(value))


def _is_container(value: Column) -> Column:
    """Whether a variant is an object or an array."""
    kind = F.schema_of_variant(value)
    return F.coalesce(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(False))


def _elements(texts: DataFrame) -> DataFrame:
    """``(value, element)`` for each object, and each element of an array; the variant is NULL where the text does not parse."""
    parsed = texts.select("value", _parsed().alias("parsed"))
    parsed = parsed.select("value", "parsed", F.try_variant_get("parsed", "$", "array<variant>").alias("elements"))
    # an array's text and its variant do not go with each element, or the work would grow with the square of its length
    own = F.when(F.col("elements").isNull(), F.col("value")).alias("value")
    inside = F.coalesce("elements", F.array(F.col("parsed"))).alias("inside")
    # outer, as Spark works out the array of a plain explode twice more to leave out empty ones first
    each = parsed.select(own, inside).select("value", F.posexplode_outer("inside").alias("at", "element")).filter(F.col("at").isNotNull())
    return each.select(F.coalesce("value", F.to_json("element")).alias("value"), "element")


def _is_object() -> Column:
    return F.coalesce(F.schema_of_variant("element").startswith("OBJECT"), F.lit(False))


def _common_schema(elements: DataFrame) -> StructType:
    """The schema that fits all objects, from Spark's own merge of variants' schemas."""
    found = elements.filter(_is_object()).agg(F.schema_of_variant_agg("element")).first()[0]
    if not found.startswith("OBJECT<"):
        return StructType([])
    ddl = re.sub(r"\bOBJECT<", "STRUCT<", found).replace("STRUCT<>", "STRING").replace("VOID", "STRING")
    return StructType.fromDDL(f"found {ddl}").fields[0].dataType


def _typed(elements: DataFrame, schema: StructType) -> DataFrame:
    """The objects by the schema, as Spark's JSON reader types them."""
    with_text = StructType([*schema.fields, StructField(MALFORMED, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    read = F.when(_is_object(), F.from_json("value", with_text, options)).alias("read")
    out = elements.select("value", read)
    fields = [F.col("read").getField(f.name).alias(f.name) for f in schema.fields]
    text = F.when(F.col("read").isNull(), F.col("value")).otherwise(F.col("read").getField(MALFORMED))
    return out.select(*fields, text.alias(MALFORMED))
