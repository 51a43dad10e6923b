"""Staging to ingestion: the full load and the incremental load."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconmill.operators import (
    close_out,
    convert_types,
    deduplicate,
    drop_null_keys,
    newer_than,
    not_loaded,
    stamp_version,
    standardize,
    uppercase,
    within_span,
)
from beaconmill.plans.audit import append_audit, counted, measure, rows_where
from beaconmill.plans.layers import Buckets, append, overwrite, read_if_present, read_layer, refuse_same
from beaconmill.plans.published import add_load, listed, loads_with, read_loads, replace_dataset
from beaconmill.schemas import (
    DEDUPLICATE_DATA,
    FILTER_DATA,
    FILTER_INCREMENTAL,
    INVALID_TIMESTAMP,
    KEYS,
    LOAD_DATE,
    READ_STAGING,
    STANDARD,
    TIME,
    USER,
)

log = logging.getLogger(__name__)


def cleanse(df: DataFrame, constants: Mapping[str, str] = STANDARD) -> DataFrame:
    """The row-wise steps of a load. The filter on ``user_id`` stands first because
    upper-casing cannot make or lose a NULL, and so it reaches the Parquet scan."""
    return (
        df.transform(drop_null_keys)
        .transform(convert_types)
        .transform(standardize, constants)
        .transform(uppercase)
    )


def unparsed(staging: DataFrame) -> DataFrame:
    """Staged rows that a load would keep, but for a time that does not parse; the text is still there."""
    return staging.filter(F.col(USER).isNotNull() & _lost())


def parsed(staging: DataFrame) -> DataFrame:
    """All other rows. A time that is missing is not one that does not parse."""
    return staging.filter(~_lost())


def _lost() -> Column:
    return F.col(TIME).isNotNull() & F.col(TIME).try_cast("timestamp").isNull()


def full_load_frame(
    staging: DataFrame,
    load_ts: datetime | str,
    keys: Sequence[str] = KEYS,
    order_by: Sequence[Column] | None = None,
    constants: Mapping[str, str] = STANDARD,
) -> DataFrame:
    """Staged rows as the ingestion layer holds them: one plan, one shuffle."""
    return stamp_version(deduplicate(cleanse(staging, constants), keys, order_by), load_ts)


def incremental_load_frame(
    staging: DataFrame,
    last_load_date: datetime | str,
    load_ts: datetime | str,
    target: DataFrame | None = None,
    keys: Sequence[str] = KEYS,
    order_by: Sequence[Column] | None = None,
    constants: Mapping[str, str] = STANDARD,
    mark_column: str = "load_date",
) -> DataFrame:
    """The rows that arrived after the mark, as the ingestion layer holds them.

    The mark comes before the deduplication: after it, an older copy of a row
    might have been kept and the new one lost. It also reaches the scan this way.
    With a ``target``, keys it already holds are left out.
    """
    rows = deduplicate(cleanse(newer_than(staging, last_load_date, mark_column), constants), keys, order_by)
    if target is not None:
        rows = not_loaded(rows, target, keys)
    return stamp_version(rows, load_ts)


def full_load(
    spark: SparkSession,
    staging_path: str,
    output_path: str,
    audit_path: str,
    load_ts: datetime | str,
    order_by: Sequence[Column] | None = None,
    buckets: Buckets | None = None,
    unparsed_path: str | None = None,
) -> dict[str, int]:
    """Replace an ingestion dataset by all that is staged; returns the audited counts.

    Readers see the old rows until the new ones are whole; a load that fails changes nothing.

    With ``unparsed_path`` rows whose time does not parse go there, with its text, and
    not into the dataset, where all of a user's would count as one key.
    """
    refuse_same(staging_path, output_path)
    staging = read_layer(spark, staging_path)
    counts = measure(staging, {READ_STAGING: rows_where(), **checks(), **newest_arrival(staging)})
    mark = counts.pop("mark")
    if unparsed_path is not None:
        overwrite(unparsed(staging), unparsed_path)
        staging = parsed(staging)
    rows, written = counted(full_load_frame(staging, load_ts, order_by=order_by))
    if buckets is None:
        replace_dataset(rows, output_path, mark)
    else:
        overwrite(rows, output_path, buckets=buckets)
    counts[DEDUPLICATE_DATA] = written()
    append_audit(spark, audit_path, counts.items())
    log.info("full load of %s: %s", output_path, counts)
    return counts


def incremental_load(
    spark: SparkSession,
    staging_path: str,
    output_path: str,
    audit_path: str,
    last_load_date: datetime | str | None,
    load_ts: datetime | str,
    order_by: Sequence[Column] | None = None,
    skip_loaded: bool = False,
    buckets: Buckets | None = None,
    unparsed_path: str | None = None,
) -> dict[str, int]:
    """Append what arrived after the mark; writes nothing if there is nothing new.

    Without a mark it is the newest arrival that the dataset's loads have read, or everything
    staged if there is none. ``skip_loaded`` leaves out keys the ingestion dataset already
    holds, which makes running the same load twice harmless; of its loads only those are
    opened whose times and key index leave room for a key that has arrived. ``unparsed_path`` is as in ``full_load``.
    """
    staging = read_layer(spark, staging_path)
    counts = {READ_STAGING: staging.count()}  # from the Parquet footers
    if last_load_date is None:
        last_load_date = remembered_mark(spark, output_path)
    newer = newer_than(staging, last_load_date)
    seen = measure(newer, {FILTER_INCREMENTAL: rows_where(), **checks(), **time_span(), **newest_arrival(staging)})
    span, mark = [seen.pop(name) for name in ("first", "last", "untimed")], seen.pop("mark")
    counts |= seen
    if unparsed_path is not None:
        if counts[INVALID_TIMESTAMP]:
            append(unparsed(newer), unparsed_path)
        staging = parsed(staging)
    if counts[FILTER_DATA]:
        target = loaded_that_repeat(spark, output_path, cleanse(newer), *span) if skip_loaded else None
        frame = incremental_load_frame(staging, last_load_date, load_ts, target, order_by=order_by)
        rows, written = counted(frame)
        if buckets is None:
            add_load(rows, output_path, mark)
        else:
            append(rows, output_path, buckets)
        counts[DEDUPLICATE_DATA] = written()
    else:
        counts[DEDUPLICATE_DATA] = 0
        log.info("no new data to load into %s", output_path)
    append_audit(spark, audit_path, counts.items())
    return counts


def close_versions(spark: SparkSession, path: str, closed_path: str | None = None, keys: Sequence[str] = KEYS) -> None:
    """Mark only the newest version per key current, in place or in a dataset at another path.

    In place the result becomes the dataset once it is whole, and keeps its mark; plain files
    have to go to another path, for Spark would delete them before reading them.
    """
    closed = close_out(read_layer(spark, path), keys)
    before = listed(spark, path)
    if closed_path is not None:
        overwrite(closed, closed_path, reads=path)
    elif before is None:
        raise ValueError(f"{path} has no list of loads: give another path for the closed versions")
    else:
        replace_dataset(closed, path, before.mark, keys)


def time_span() -> dict[str, Column]:
    """The first and last time of staged rows, in microseconds since the epoch, and the rows without one."""
    at = F.unix_micros(F.col(TIME).try_cast("timestamp"))
    return {"first": F.min(at), "last": F.max(at), "untimed": F.count_if(at.isNull())}


def newest_arrival(staging: DataFrame) -> dict[str, Column]:
    """The newest arrival among staged rows, in microseconds since the epoch."""
    known = LOAD_DATE in staging.columns
    return {"mark": F.max(F.unix_micros(LOAD_DATE)) if known else F.lit(None).cast("bigint")}


def remembered_mark(spark: SparkSession, path: str) -> datetime:
    """Up to which arrival the dataset's loads have read; before all times if there is none."""
    now = listed(spark, path)
    mark = now.mark if now is not None else None
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=-(1 << 55) if mark is None else mark)


def loaded_that_repeat(
    spark: SparkSession, path: str, rows: DataFrame, first: int | None, last: int | None, untimed: int, keys: Sequence[str] = KEYS
) -> DataFrame | None:
    """The loaded rows that ``rows``, of the time span, can repeat, if there are any.

    Of a dataset with a list of loads only those are opened whose times meet the span and
    whose key index has a key of ``rows``.
    """
    now = listed(spark, path)
    if now is None:
        target = read_if_present(spark, path)
        return None if target is None else within_span(target, first, last)
    loads = [load for load in now.loads if load.may_repeat(first, last, untimed > 0)]
    loads = loads_with(spark, path, loads, rows, keys) if loads else []
    return within_span(read_loads(spark, path, loads), first, last) if loads else None


def checks() -> dict[str, Column]:
    """What a load audits about its input: rows kept by the filter, and among
    these the timestamps that are lost because they do not parse."""
    kept = F.col(USER).isNotNull()
    return {FILTER_DATA: rows_where(kept), INVALID_TIMESTAMP: rows_where(kept & _lost())}
