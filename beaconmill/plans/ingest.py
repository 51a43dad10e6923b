"""Source to snapshot, and snapshot to staging."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconmill.operators import (
    clicks_of,
    conversions_of,
    flatten,
    rename_interactions,
    stamp_arrival,
    stringify,
)
from beaconmill.plans.audit import append_audit, counted
from beaconmill.plans.layers import Layers, at_once, overwrite, read_layer, save_arrivals
from beaconmill.schemas import MALFORMED
from beaconmill.sources import SourceSpec, read_source, readable, split_malformed

# Staged dataset -> (snapshot dataset, what makes the one of the other).
STAGED: Mapping[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "ad_impressions": ("ad_impressions", lambda df: df),
    "clicks": ("clicks_and_conversions", lambda df: clicks_of(rename_interactions(df))),
    "conversions": ("clicks_and_conversions", lambda df: conversions_of(rename_interactions(df))),
    "bid_requests": ("bid_requests", lambda df: df),
}


def snapshot(spark: SparkSession, specs: Iterable[SourceSpec], layers: Layers) -> None:
    """Land every source as Parquet, rows and types as they come.

    The raw files are parsed once. The text of a row that does not parse stays in
    its own column, which costs next to nothing where it is NULL, and such rows are
    copied from the snapshot to the quarantine layer.
    """

    def land(spec: SourceSpec) -> dict[str, int]:
        landed = layers.path("snapshot", spec.name)
        keep = spec.format == "csv" or (spec.format == "json" and spec.schema is not None)
        overwrite(read_source(spark, spec, keep_malformed=keep), landed, reads=spec.path)
        _, malformed = split_malformed(read_layer(spark, landed))
        if MALFORMED not in malformed.columns:
            return {}
        rows, written = counted(malformed)
        overwrite(rows, layers.path("quarantine", spec.name))
        return {f"malformed_{spec.name}": written()}

    counts = {}
    for found in at_once(lambda s=spec: land(s) for spec in specs):
        counts |= found
    if counts:
        append_audit(spark, layers.audit, counts.items())


def staged(df: DataFrame, arrived: datetime | str) -> DataFrame:
    """A snapshot frame as staging holds it: flat, all strings, with its arrival."""
    return stamp_arrival(stringify(flatten(df)), arrived)


def stage(
    spark: SparkSession,
    layers: Layers,
    arrived: datetime | str,
    datasets: Iterable[str] = tuple(STAGED),
    mode: str = "overwrite",
) -> None:
    """Snapshot to staging, one map-only job per dataset, side by side. ``mode="append"`` keeps
    what arrived earlier, for incremental loads to choose from. Rows of which nothing
    could be read stay behind."""

    def one(dataset: str) -> None:
        origin, make = STAGED[dataset]
        df = make(readable(read_layer(spark, layers.path("snapshot", origin))))
        save_arrivals(staged(df, arrived), layers.path("staging", dataset), arrived, mode)

    at_once(lambda d=dataset: one(d) for dataset in datasets)


def malformed_rows(spark: SparkSession, layers: Layers, dataset: str) -> DataFrame:
    """The raw text of the rows of a source that did not parse."""
    return read_layer(spark, layers.path("quarantine", dataset)).select(F.col(MALFORMED).alias("raw"))
