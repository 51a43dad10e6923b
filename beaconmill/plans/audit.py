"""The audit table: one row per audited step and run."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from beaconmill.plans.layers import append
from beaconmill.schemas import AUDIT


def measure(df: DataFrame, aggregates: Mapping[str, Column]) -> dict[str, int]:
    """The aggregates of all rows, by name, in one query over the columns they need.

    Audit counts are taken this way because a counter that rides along in front of
    a shuffle counts a task's rows again when a lost executor makes Spark run the
    task again.
    """
    return df.agg(*[column.alias(name) for name, column in aggregates.items()]).first().asDict()


def rows_where(condition: Column | None = None) -> Column:
    return F.count(F.lit(1)) if condition is None else F.count_if(condition)


def counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """The frame to write in place of ``df``, and what tells its row count afterwards.

    The counter sits on top of the plan, in the tasks that write. Spark takes
    each of those into account once, however often it had to run them.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), lambda: seen.get["rows"]


def append_audit(spark: SparkSession, path: str, counts: Iterable[tuple[str, int]]) -> None:
    """Append the steps of one run in one file, in a directory of its own: two jobs that
    append to one directory at a time would remove each other's unfinished files.

    The few rows are literals of the plan; ``createDataFrame`` would start Python
    workers to hand them over.
    """
    steps = [
        F.struct(F.lit(step).alias("operation"), F.lit(rows).cast("bigint").alias("record_count"))
        for step, rows in counts
    ]
    rows = spark.range(1, numPartitions=1).select(F.inline(F.array(*steps)))
    stamped = rows.withColumn("operation_timestamp", F.current_timestamp())
    append(stamped, f"{path}/run={uuid.uuid4().hex}")


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """Every audited step of every run, whose id stands in ``run``."""
    return spark.read.schema(f"{AUDIT}, run string").parquet(path)
