"""Where the layers lie, and how their tables are read and written."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from beaconmill.functions import instant
from beaconmill.plans.columns import record_columns, recorded_columns
from beaconmill.plans.published import listed, read_loads
from beaconmill.schemas import KEYS, LOAD_DATE
from beaconmill.storage import times_with_statistics

LAYERS = ("snapshot", "quarantine", "staging", "ingestion", "analytical", "audit")

# The directories of staging, one per arrival, are named by its microseconds since
# the epoch: a number means the same in every time zone.
ARRIVAL = "arrival_micros"

# The directories of analytical tables that are kept up to date, one per day of the impression.
EVENT_DAY = "event_day"


@dataclass(frozen=True)
class Buckets:
    """A catalog table over a layer's directory whose files are hashed and sorted by key.

    Joins on the keys between tables of one ``count`` need no shuffle. The table
    is external and the directory stays plain Parquet for everyone else.
    """

    table: str
    count: int
    keys: Sequence[str] = KEYS


@dataclass(frozen=True)
class Layers:
    """One directory per layer and dataset below a root, on any file system Spark
    can write to. With ``buckets``, loaded datasets are bucketed into that many,
    as tables of ``database`` in the session's catalog."""

    root: str
    buckets: int = 0
    database: str = "default"

    def path(self, layer: str, dataset: str = "") -> str:
        if layer not in LAYERS:
            raise ValueError(f"no layer {layer!r}; there are {', '.join(LAYERS)}")
        return os.path.join(self.root, layer, dataset) if dataset else os.path.join(self.root, layer)

    @property
    def audit(self) -> str:
        return self.path("audit")

    def bucketed(self, dataset: str) -> Buckets | None:
        return Buckets(f"{self.database}.{dataset}", self.buckets) if self.buckets else None


def read_layer(spark: SparkSession, path: str, buckets: Buckets | None = None) -> DataFrame:
    """The table at the path; of a dataset with a list of loads, those that it names. The scan
    decides the partitioning and adaptive execution adjusts it; repartitioning here would
    only add a shuffle."""
    if buckets is not None:
        return spark.table(buckets.table)
    now = listed(spark, path)
    if now is not None:
        return read_loads(spark, path, now.loads)
    recorded = recorded_columns(spark, path)
    reader = spark.read if recorded is None else spark.read.schema(_arriving(recorded))
    return with_arrivals(reader.parquet(path)).drop(EVENT_DAY)


def layer_schema(spark: SparkSession, path: str) -> StructType:
    """The columns of a table as its files lie there. Of staging these are all that any arrival
    has had, by the history kept beside it: the footer of some file knows those of one only."""
    recorded = recorded_columns(spark, path)
    return spark.read.parquet(path).schema if recorded is None else _arriving(recorded)


def _arriving(recorded: StructType) -> StructType:
    return StructType([*recorded.fields]).add(ARRIVAL, LongType())


def with_arrivals(df: DataFrame) -> DataFrame:
    """Take ``load_date`` from the directory names, where the table has them: a filter
    on it then chooses directories before any file is opened."""
    if ARRIVAL not in df.columns:
        return df
    return df.withColumn(LOAD_DATE, F.timestamp_micros(ARRIVAL)).drop(ARRIVAL)


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return read_layer(spark, path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def overwrite(
    df: DataFrame, path: str, reads: str | None = None, buckets: Buckets | None = None
) -> None:
    """Replace the table at the path. It must not be the one the plan reads, which
    Spark would delete before reading it."""
    refuse_same(reads, path)
    _save(df, path, "overwrite", buckets)


def append(df: DataFrame, path: str, buckets: Buckets | None = None) -> None:
    _save(df, path, "append", buckets)


def _save(df: DataFrame, path: str, mode: str, buckets: Buckets | None) -> None:
    times_with_statistics(df.sparkSession)
    if buckets is None:
        df.write.mode(mode).parquet(path)
    else:
        keys = list(buckets.keys)
        writer = df.write.mode(mode).format("parquet").option("path", path)
        writer.bucketBy(buckets.count, keys).sortBy(keys).saveAsTable(buckets.table)


def save_arrivals(df: DataFrame, path: str, arrived: datetime | str, mode: str) -> None:
    """Write staged rows with a directory per arrival, so that an incremental load
    opens only the arrivals after its mark."""
    spark = df.sparkSession
    if mode == "append" and recorded_columns(spark, path) is None:
        earlier = read_if_present(spark, path)
        if earlier is not None:  # arrivals from before the history
            columns = spark.read.option("mergeSchema", True).parquet(path).drop(ARRIVAL).schema
            record_columns(spark, path, "0", columns)
    at = spark.range(1).select(F.unix_micros(instant(arrived))).first()[0]
    writer = df.withColumn(ARRIVAL, F.lit(at)).write.mode(mode)
    times_with_statistics(spark)
    writer.option("partitionOverwriteMode", "static").partitionBy(ARRIVAL).parquet(path)
    if read_if_present(spark, path) is None:
        # No row, hence no directory: leave an empty file that tells the columns.
        append(df.limit(0), f"{path}/{ARRIVAL}={at}")
    record_columns(spark, path, str(at), df.drop(LOAD_DATE).schema)


def at_once(jobs: Iterable[Callable[[], object]], most: int = 4) -> list:
    """Independent jobs side by side, so that one's last tasks leave no executor idle. The
    first failure is raised after all have ended."""
    with ThreadPoolExecutor(most) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def refuse_same(reads: str | None, path: str) -> None:
    if reads is not None and _clean(reads) == _clean(path):
        raise ValueError(f"cannot overwrite {path} while reading it")


def _clean(path: str) -> str:
    return os.path.normpath(path.removeprefix("file://"))
