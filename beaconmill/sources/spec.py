"""The source registry and the one reader behind every file format."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from beaconmill import schemas
from beaconmill.sources.mixed import read_json_mixed


@dataclass(frozen=True)
class SourceSpec:
    """Where a dataset lies and how Spark reads it.

    ``options`` are plain reader options. JSON arrays must say ``multiLine=True``;
    the layout is declared, never guessed, and ``read_source`` rejects a wrong
    declaration. ``layout="mixed"`` takes each JSON file as it is (``read_json_mixed``). Land newline-delimited JSON where volume matters: a multi-line
    file cannot be split between tasks.
    """

    name: str
    format: str
    path: str
    schema: str | StructType | None = None
    options: Mapping[str, object] = field(default_factory=dict)


# File names and formats of the known sources.
_KNOWN = {
    "ad_impressions": SourceSpec(
        "ad_impressions", "json", "ad_impressions.json", schemas.AD_IMPRESSIONS
    ),
    "clicks_and_conversions": SourceSpec(
        "clicks_and_conversions", "csv", "clicks_and_conversions.csv", options={"header": True}
    ),
    "bid_requests": SourceSpec("bid_requests", "avro", "bid_requests.avro"),
}

SOURCES = tuple(_KNOWN)


def source_spec(name: str, input_dir: str, **changes) -> SourceSpec:
    """The spec of a known source (any letter case) below ``input_dir``.

    ``changes`` replace single fields, for example ``format="json"``. A ``path``
    given here is taken relative to ``input_dir`` too.
    """
    known = _KNOWN.get(name.lower())
    if known is None:
        raise ValueError(f"Invalid source type: {name!r}; known are {', '.join(SOURCES)}")
    spec = replace(known, **changes)
    return replace(spec, path=os.path.join(input_dir, spec.path))


def read_source(spark: SparkSession, spec: SourceSpec, keep_malformed: bool = False) -> DataFrame:
    """Scan one source lazily.

    A CSV header names the columns, all strings. It has to be the same in all
    files: Spark would take the first one for all and mix up the columns of a
    file that has another, so that file fails here. Where names repeat or are
    missing, and Spark invents others, the header lines are compared as they stand.

    With ``keep_malformed`` a JSON or CSV row that does not parse keeps its raw
    text in ``_corrupt_record``; see ``split_malformed``. JSON needs a schema for it.
    """
    if spec.format == "json" and spec.options.get("layout") == "mixed":
        mixed = read_json_mixed(spark, spec.path, spec.schema)
        return mixed if keep_malformed else mixed.drop(schemas.MALFORMED)
    if spec.format == "json":
        # malformed text would not be kept anywhere: then a file of another layout gives rows of NULL
        lossy = spec.schema is not None and not keep_malformed
        check_json_layout(spark, spec.path, _flag(spec.options.get("multiLine")), every_file=lossy)
    reader = spark.read.format(spec.format).options(**spec.options)
    schema = StructType.fromDDL(spec.schema) if isinstance(spec.schema, str) else spec.schema
    if spec.format == "csv" and schema is None and not _flag(spec.options.get("inferSchema")):
        schema = reader.load(spec.path).schema  # reads one line
        if schema.names == _first_line(spark, spec):
            reader = reader.option("enforceSchema", False)
        elif _flag(spec.options.get("header")):  # Spark had to invent names
            _check_headers(spark, spec)
    if keep_malformed and spec.format in ("json", "csv"):
        if schema is None:
            raise ValueError(f"{spec.name}: keeping malformed rows needs a schema")
        schema = StructType([*schema.fields]).add(schemas.MALFORMED, StringType())
        # Without pruning switched off, a query on few CSV columns would parse
        # only those and miss rows that have too many or too few.
        reader = reader.options(
            mode="PERMISSIVE", columnNameOfCorruptRecord=schemas.MALFORMED, columnPruning=False
        )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(spec.path)


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows without the raw text, malformed rows with it).

    Spark refuses queries on raw files that need no column but the raw text, such
    as a plain count; ask those of the snapshot.
    """
    if schemas.MALFORMED not in df.columns:
        return df, df.limit(0)
    raw = F.col(schemas.MALFORMED)
    return df.filter(raw.isNull()).drop(schemas.MALFORMED), df.filter(raw.isNotNull())


def readable(df: DataFrame) -> DataFrame:
    """All rows but those of which nothing could be read, without the raw text.

    A row that is malformed only in part, such as a CSV line that ends early, goes
    on with the values it has.
    """
    if schemas.MALFORMED not in df.columns:
        return df
    values = [c for c in df.columns if c != schemas.MALFORMED]
    some = reduce(or_, (F.col(f"`{c}`").isNotNull() for c in values))
    return df.filter(F.col(schemas.MALFORMED).isNull() | some).drop(schemas.MALFORMED)


def check_json_layout(spark: SparkSession, path: str, multi_line: bool, every_file: bool = True) -> None:
    """Raise where the declared JSON layout would lose rows.

    An array or an object over several lines gives only malformed rows, read line by line.
    The first line of each file tells, found in one pass over the text without a shuffle of it;
    without ``every_file``, where malformed text is kept and counted, that of one file.

    Read as multi-line, a file gives what its first value holds, one object or one array,
    and no sign of anything after it. So there every file has to be one value, which
    reads the text twice, by files and without a shuffle.
    """
    trimmed = F.btrim("value", F.lit(" \t\r\n\ufeff"))
    text = spark.read.text(path, wholetext=multi_line)
    text = text.select(trimmed.alias("text"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")).filter("text <> ''")
    if not multi_line:
        if not every_file:
            text = text.limit(1)
        placed = text.withColumn("at", F.struct("start", F.monotonically_increasing_id()))
        firsts = placed.groupBy("file").agg(F.min_by("text", "at").alias("text"))
        wrong = firsts.filter("text like '[%' or text = '{'").orderBy("file").first()
        if wrong is not None:
            what = "array" if wrong.text.startswith("[") else "value over several lines"
            raise ValueError(f"{wrong.file} holds a JSON {what}: read it with multiLine=True, or files of several layouts with layout='mixed'")
        return
    # as an element of an array a value counts once; several, with or without commas, do not
    values = F.json_array_length(F.concat(F.lit("["), "text", F.lit("]")))
    wrong = text.filter(~(F.coalesce(values, F.lit(0)) == 1)).select("file").first()
    if wrong is not None:
        raise ValueError(f"{wrong.file} is not one JSON object or array: read one object per line without multiLine")


def _check_headers(spark: SparkSession, spec: SourceSpec) -> None:
    """Raise unless the first lines of all files are the same."""
    lines = spark.read.text(spec.path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"),
    )
    headers = lines.filter("trim(value) <> ''").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    found = headers.groupBy(F.btrim("header", F.lit("\r\ufeff")).alias("header")).agg(F.min("file").alias("file")).orderBy("file").limit(2).collect()
    if len(found) > 1:
        raise ValueError(f"{found[1].file} has another header than {found[0].file}: {found[1].header!r}, {found[0].header!r}")


def _first_line(spark: SparkSession, spec: SourceSpec) -> list[str]:
    row = spark.read.options(**{**spec.options, "header": False}).csv(spec.path).first()
    return list(row) if row is not None else []


def _flag(value: object) -> bool:
    return str(value).lower() == "true"
