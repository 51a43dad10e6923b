"""Streams that keep state by event time: deduplication that bounds it, and the correlation of two streams."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconmill import storage
from beaconmill.functions import all_present, refuse_column
from beaconmill.operators import deduplicate
from beaconmill.plans.audit import append_audit, measure, rows_where
from beaconmill.plans.layers import append, layer_schema, overwrite, with_arrivals
from beaconmill.plans.loads import cleanse
from beaconmill.schemas import KEYS, STREAM_LATE, STREAM_READ, TIME, USER

ROCKS = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
CLOSING = "closing=1"


def _span(delay: timedelta) -> str:
    """``delay`` as Spark reads a span of time, and a second more: a row just at the watermark
    would be dropped, and watermarks are cut to milliseconds."""
    if delay < timedelta(0):
        raise ValueError("the delay must not be negative")
    return f"{delay // timedelta(microseconds=1) + 1_000_000} microseconds"


def _run(spark: SparkSession, start: Callable[[], object]) -> dict[str, int]:
    """Start a query whose state lies in RocksDB, wait for its end, and tell what it counted."""
    before = spark.conf.get(ROCKS[0], None)
    spark.conf.set(*ROCKS)
    try:
        query = start()
        query.awaitTermination()
    finally:
        spark.conf.unset(ROCKS[0]) if before is None else spark.conf.set(ROCKS[0], before)
    states = [state for progress in query.recentProgress for state in progress.stateOperators]
    return {"late": sum(state.numRowsDroppedByWatermark for state in states)}


def stream_deduplicated(
    spark: SparkSession,
    staging_path: str,
    output_path: str,
    late_path: str,
    audit_path: str,
    checkpoint_path: str,
    delay: timedelta,
    keys: Sequence[str] = KEYS,
    time: str = TIME,
    max_files: int = 10_000,
) -> None:
    """Append the staged files that no earlier run has read, each key once, and stop.

    A row is late if its time lies more than ``delay`` before the newest time of all batches
    before its own; late rows are kept in ``late_path``, a directory per batch, and counted.
    Of the others a key comes out once, the first time it is seen and there the first by
    ``deduplicate``: ``dropDuplicatesWithinWatermark`` knows the keys of the last ``delay`` only,
    in RocksDB, so state grows with the delay and not with the keys ever seen. ``keys`` must
    hold the time. Rows without a time are neither late nor in order: they go to ``late_path`` too.

    Two queries in turn: the first cleanses, tells late rows and sets the rest aside, a batch
    in one directory; the second deduplicates what was set aside. Each may fail and run again: a
    batch's directory is replaced, its newest time noted by its number, and the output is a
    file sink, which counts a batch once.
    """
    if time not in keys:
        raise ValueError(f"{time} has to be one of the keys: state is kept by it")
    base = checkpoint_path.rstrip("/")
    allowed = delay // timedelta(microseconds=1)
    pending = f"{base}/pending"

    def newest_before(number: int) -> int | None:
        marks = [int(n[:-5]) for n in storage.names(spark, f"{base}/marks") if n.endswith(".json")]
        marks = [n for n in marks if n < number]
        return json.loads(storage.read_text(spark, f"{base}/marks/{max(marks):012d}.json"))["newest"] if marks else None

    def split(batch: DataFrame, number: int) -> None:
        rows = cleanse(with_arrivals(batch))
        before = newest_before(number)
        at = F.unix_micros(time)
        late = at.isNull() if before is None else at.isNull() | (at < before - allowed)
        seen = measure(rows, {STREAM_READ: rows_where(), STREAM_LATE: rows_where(late), "newest": F.max(at)})
        newest = max((x for x in (before, seen.pop("newest")) if x is not None), default=None)
        if seen[STREAM_LATE]:
            overwrite(rows.filter(late), f"{late_path}/batch={number}")
        overwrite(deduplicate(rows.filter(~late), keys), f"{pending}/batch={number}")
        storage.remove(spark, f"{base}/marks/{number:012d}.json")
        storage.write_new(spark, f"{base}/marks/{number:012d}.json", json.dumps({"newest": newest}))
        append_audit(spark, audit_path, seen.items())

    schema = layer_schema(spark, staging_path)
    _run(
        spark,
        lambda: spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .parquet(staging_path)
        .writeStream.foreachBatch(split)
        .option("checkpointLocation", f"{base}/split")
        .trigger(availableNow=True)
        .start(),
    )
    if not storage.names(spark, pending):
        return
    there = spark.read.parquet(pending).drop("batch").schema
    storage.times_with_statistics(spark)
    seen = _run(
        spark,
        lambda: spark.readStream.schema(there)
        .parquet(pending)
        .withWatermark(time, _span(delay))
        .dropDuplicatesWithinWatermark(list(keys))
        .drop("batch")
        .writeStream.format("parquet")
        .option("path", output_path)
        .option("checkpointLocation", f"{base}/distinct")
        .trigger(availableNow=True)
        .start(),
    )
    if seen["late"]:
        raise RuntimeError(f"{seen['late']} rows in time were dropped as late: the batches were read out of order")


def stream_correlated(
    spark: SparkSession,
    impressions_path: str,
    events_path: str,
    output_path: str,
    checkpoint_path: str,
    id_column: str,
    delay: timedelta,
    keys: Sequence[str] = KEYS,
    time: str = TIME,
) -> None:
    """``correlate`` of two growing datasets: read what is new, append what is settled, and stop.

    Impressions and events wait for each other in state. A match comes out when its second
    half arrives; an impression without one when the watermark, the older of both newest times
    less ``delay``, has passed its time and no event can come any more. Rows later than that
    are not matched, as in any such join: ``delay`` is how late either dataset may be. Rows without a key never match and come
    out at once. ``close_stream`` lets the rest out at the end of the input.
    """
    if time not in keys:
        raise ValueError(f"{time} has to be one of the keys: state is kept by it")
    base = checkpoint_path.rstrip("/")

    def stream(path: str) -> DataFrame:
        schema = spark.read.parquet(path).drop("closing").schema
        return spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(path)

    impressions, events = stream(impressions_path), stream(events_path)
    refuse_column(impressions, id_column)
    present = all_present(keys)
    kept = [F.col(f"i.`{c}`") for c in impressions.columns]
    left = impressions.filter(present).withWatermark(time, _span(delay))
    right = events.select(*keys, id_column).filter(present).withWatermark(time, _span(delay))
    same = F.lit(True)
    for c in keys:
        same = same & (F.col(f"i.{c}") == F.col(f"e.{c}"))
    joined = left.alias("i").join(right.alias("e"), same, "left_outer").select(*kept, F.col(f"e.{id_column}"))
    without = impressions.filter(~present).withColumn(id_column, F.lit(None).cast(events.schema[id_column].dataType))
    out = joined.unionByName(without.select(*joined.columns))
    storage.times_with_statistics(spark)
    _run(
        spark,
        lambda: out.writeStream.format("parquet")
        .option("path", output_path)
        .option("checkpointLocation", base)
        .trigger(availableNow=True)
        .start(),
    )


def close_stream(spark: SparkSession, *paths: str, delay: timedelta, user: str = USER, time: str = TIME) -> None:
    """End the datasets of ``stream_correlated``: one more row in each, later than all by over twice the delay.

    The next run then sees that nothing can come for the rows that wait. The closing rows
    have a user that no other row has, and never come out themselves.
    """
    newest = None
    for path in paths:
        last = spark.read.option("recursiveFileLookup", True).parquet(path).agg(F.max(F.unix_micros(time))).first()[0]
        newest = last if newest is None or (last is not None and last > newest) else newest
    if newest is None:
        return
    at = newest + 2 * (delay // timedelta(microseconds=1)) + 10_000_000
    for n, path in enumerate(paths):
        schema = spark.read.option("recursiveFileLookup", True).parquet(path).schema
        values = {time: F.timestamp_micros(F.lit(at)), user: F.lit(f"\0closing {n}")}
        row = spark.range(1).select(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields))
        append(row, f"{path}/{CLOSING}")
