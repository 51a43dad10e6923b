"""Readers that give the all-string frames of the staging layer, one per file format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from beaconmill.operators.staging import flatten, stringify
from beaconmill.schemas import schema_from_file
from beaconmill.sources.spec import SourceSpec, read_source


def read_json_strings(
    spark: SparkSession,
    path: str,
    schema: str | StructType | None = None,
    schema_file: str | None = None,
    multi_line: bool = False,
    mixed: bool = False,
) -> DataFrame:
    """JSON as strings, with a schema given or kept in a file. ``mixed`` takes each file's layout as it is.

    Without either Spark infers one, which reads the whole input once more.
    """
    if schema_file is not None:
        schema = schema_from_file(spark, schema_file)
    spec = SourceSpec("json", "json", path, schema, {"layout": "mixed"} if mixed else {"multiLine": multi_line})
    return stringify(flatten(read_source(spark, spec)))


def read_csv_strings(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """CSV as strings, named by its header or ``_c0, _c1, ...`` without one."""
    return stringify(read_source(spark, SourceSpec("csv", "csv", path, None, {"header": header})))


def read_avro_strings(spark: SparkSession, path: str) -> DataFrame:
    """Avro records, flattened and as strings. Needs the ``spark-avro`` package."""
    return stringify(flatten(read_source(spark, SourceSpec("avro", "avro", path))))
