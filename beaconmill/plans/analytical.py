"""Ingestion to analytical, and the whole way from the sources."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import SparkSession

from beaconmill.operators import correlate, current_versions
from beaconmill.plans.audit import append_audit
from beaconmill.plans.ingest import STAGED, snapshot, stage
from beaconmill.plans.layers import Layers, at_once, overwrite, read_layer
from beaconmill.plans.loads import full_load, incremental_load
from beaconmill.schemas import READ_INGESTION
from beaconmill.scratch import remove_dir, scratch_dir
from beaconmill.sources import SourceSpec


def correlate_layers(spark: SparkSession, layers: Layers) -> None:
    """Impressions with clicks, and impressions with conversions, as two tables.

    Of each dataset the current rows take part: the newest version of a key, whether or
    not ``close-versions`` has run. So events hold a key at most once, both ids fit beside
    each impression, and one shuffle of each dataset serves both tables: the joined rows
    are kept in scratch and written twice from there. Bucketed tables need no shuffle.
    """
    names = ("ad_impressions", "clicks", "conversions")
    frames = {
        name: read_layer(spark, layers.path("ingestion", name), layers.bucketed(name)) for name in names
    }
    append_audit(spark, layers.audit, [(READ_INGESTION, df.count()) for df in frames.values()])
    ids = {"clicks": "click_id", "conversions": "conversion_id"}
    joined = current_versions(frames["ad_impressions"])
    for name, id_column in ids.items():
        joined = correlate(joined, current_versions(frames[name]), id_column, one_per_key=True)
    scratch = scratch_dir(spark, "correlated")
    overwrite(joined, scratch)
    both = read_layer(spark, scratch)
    at_once(
        lambda n=name, c=other: overwrite(both.drop(c), layers.path("analytical", f"ad_impressions_{n}"))
        for name, other in (("clicks", "conversion_id"), ("conversions", "click_id"))
    )
    remove_dir(spark, scratch)


def load_all(
    spark: SparkSession,
    layers: Layers,
    load_ts: datetime | str,
    last_load_date: datetime | str | None = None,
    skip_loaded: bool = False,
    datasets: Iterable[str] = tuple(STAGED),
    incremental: bool = False,
) -> dict[str, dict[str, int]]:
    """Load every dataset: fully, or incrementally if there is a last load date or, with
    ``incremental``, after the newest arrival that each dataset's loads have read."""

    def load(dataset: str) -> dict[str, int]:
        paths = (layers.path("staging", dataset), layers.path("ingestion", dataset), layers.audit)
        aside = {"buckets": layers.bucketed(dataset), "unparsed_path": layers.path("quarantine", f"{dataset}_times")}
        if last_load_date is None and not incremental:
            return full_load(spark, *paths, load_ts, **aside)
        return incremental_load(spark, *paths, last_load_date, load_ts, skip_loaded=skip_loaded, **aside)

    datasets = list(datasets)
    return dict(zip(datasets, at_once(lambda d=dataset: load(d) for dataset in datasets), strict=True))


def run_all(
    spark: SparkSession, specs: Iterable[SourceSpec], layers: Layers, load_ts: datetime | str
) -> None:
    """Source, snapshot, staging, full load, analytical."""
    specs = list(specs)
    landed = {spec.name for spec in specs}
    datasets = [dataset for dataset, (origin, _) in STAGED.items() if origin in landed]
    snapshot(spark, specs, layers)
    stage(spark, layers, load_ts, datasets)
    load_all(spark, layers, load_ts, datasets=datasets)
    correlate_layers(spark, layers)
