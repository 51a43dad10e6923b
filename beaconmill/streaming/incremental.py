"""The incremental load as a stream: Spark remembers which files it has loaded."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from beaconmill.operators import deduplicate, not_loaded, stamp_version
from beaconmill.plans.audit import append_audit, counted, measure, rows_where
from beaconmill.plans.layers import Buckets, append, layer_schema, overwrite, read_if_present, with_arrivals
from beaconmill.plans.loads import checks, cleanse, loaded_that_repeat, newest_arrival, parsed, time_span, unparsed
from beaconmill.plans.published import add_load
from beaconmill.schemas import INVALID_TIMESTAMP, KEYS, STREAM_LOAD, STREAM_READ
from beaconmill.scratch import remove_dir


def stream_load(
    spark: SparkSession,
    staging_path: str,
    output_path: str,
    audit_path: str,
    checkpoint_path: str,
    load_ts: datetime | str,
    keys: Sequence[str] = KEYS,
    max_files: int = 10_000,
    buckets: Buckets | None = None,
    unparsed_path: str | None = None,
) -> None:
    """Load the staged files that no earlier run has loaded, then stop.

    ``max_files`` bounds one micro-batch. The batches only cleanse and set aside, a
    directory for each, next to the checkpoint; what all of them brought is then
    deduplicated and loaded as one, so the result does not depend on how files fell into
    batches. Rows whose key is already loaded are left out by a join with the output
    rather than by state that would grow with every key ever seen. It also makes a
    second try harmless after a failure between loading and clearing away, and what
    failed before loading is loaded by the next run. With ``unparsed_path`` rows whose time
    does not parse go there, a directory for each batch; they are counted in the audit.
    """
    pending = f"{checkpoint_path.rstrip('/')}_pending"

    def set_aside(batch: DataFrame, number: int) -> None:
        counts = measure(batch, {STREAM_READ: rows_where(), **checks()})
        rows = with_arrivals(batch)
        if unparsed_path is not None:
            overwrite(unparsed(rows), f"{unparsed_path}/batch={number}")
            rows = parsed(rows)
        overwrite(cleanse(rows), f"{pending}/batch={number}")
        append_audit(spark, audit_path, [(name, counts[name]) for name in (STREAM_READ, INVALID_TIMESTAMP)])

    schema = layer_schema(spark, staging_path)
    query = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .parquet(staging_path)
        .writeStream.foreachBatch(set_aside)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    brought = read_if_present(spark, pending)
    if brought is None:
        return
    rows = deduplicate(brought.drop("batch"), keys)
    seen = measure(brought, {**time_span(), **newest_arrival(brought)})
    target = loaded_that_repeat(spark, output_path, brought, seen["first"], seen["last"], seen["untimed"], keys)
    if target is not None:
        rows = not_loaded(rows, target, keys)
    stamped, written = counted(stamp_version(rows, load_ts))
    if buckets is None:
        add_load(stamped, output_path, seen["mark"], keys)
    else:
        append(stamped, output_path, buckets)
    append_audit(spark, audit_path, [(STREAM_LOAD, written())])
    remove_dir(spark, pending)
