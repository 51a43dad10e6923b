"""Small files of metadata on whatever file system Spark writes to, and how times are written."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a directory; nothing if there is none."""
    fs, where = _at(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that nobody sees before it is whole; False if there is one already."""
    fs, where = _at(spark, path)
    fs.mkdirs(where.getParent())
    _, aside = _at(spark, f"{where.getParent()}/.{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if not fs.exists(where) and fs.rename(aside, where):
        return True
    fs.delete(aside, False)
    return False


def times_with_statistics(spark: SparkSession) -> None:
    """Spark's default Parquet timestamp has no minimum and maximum per row group, so no
    filter on time could skip any. There is a setting for the session only. It is set
    before each write and left so: setting it back would race with another write."""
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)
