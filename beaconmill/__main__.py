"""``spark-submit``-able jobs, one per step between the layers.

A failure ends the job with a non-zero exit code. Paths may be on any file system
Spark can reach; connection and sizing settings belong to the submit command.
"""

from __future__ import annotations

import argparse
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from beaconmill import plans, schemas
from beaconmill.plans.ingest import STAGED
from beaconmill.sources import SOURCES, SourceSpec, source_spec
from beaconmill.streaming import stream_load


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="beaconmill", description=__doc__)
    option = parser.add_argument
    option("job", choices=list(JOBS))
    option("--root", required=True, help="directory that holds the layers")
    option("--input", help="directory that holds the source files")
    option("--source", action="append", metavar="NAME[=FORMAT[:PATH]]",
           help="source to read, with another format or file if given; default all")
    option("--multi-line", action="store_true", help="JSON sources are arrays")
    option("--dataset", action="append", choices=list(STAGED), help="staged dataset; default all")
    option("--load-date", default=datetime.now(timezone.utc).isoformat(sep=" "))
    option("--last-load-date", help="incremental-load: the mark; default the newest arrival loaded")
    option("--skip-loaded", action="store_true", help="incremental-load: leave out loaded keys")
    option("--append", action="store_true", help="stage: keep earlier arrivals")
    option("--buckets", type=int, default=0,
           help="bucket loaded datasets by key as catalog tables, for joins without a shuffle")
    option("--database", default="default", help="the database of bucketed tables")
    given = parser.parse_args(argv)
    if given.job in ("snapshot", "run-all") and not given.input:
        parser.error(f"{given.job} needs --input")
    given.dataset = given.dataset or list(STAGED)
    return given


def sources(given: argparse.Namespace) -> list[SourceSpec]:
    return [_source(given, text) for text in given.source or SOURCES]


def _source(given: argparse.Namespace, text: str) -> SourceSpec:
    name, _, change = text.partition("=")
    form, _, path = change.partition(":")
    spec = source_spec(name, given.input, **({"path": path} if path else {}))
    if form:
        spec = replace(spec, format=form)
    if spec.format == "json" and spec.name == "bid_requests":
        spec = replace(spec, schema=schemas.BID_REQUESTS)
    if spec.format == "json" and given.multi_line:
        spec = replace(spec, options={"multiLine": True})
    return spec


def snapshot(spark, given, layers):
    plans.snapshot(spark, sources(given), layers)


def stage(spark, given, layers):
    mode = "append" if given.append else "overwrite"
    plans.stage(spark, layers, given.load_date, given.dataset, mode)


def load(spark, given, layers):
    incremental = given.job == "incremental-load"
    mark = given.last_load_date if incremental else None
    plans.load_all(spark, layers, given.load_date, mark, given.skip_loaded, given.dataset, incremental)


def stream(spark, given, layers):
    for name in given.dataset:
        loaded = layers.path("ingestion", name)
        checkpoint = layers.path("ingestion", f"_stream_{name}")
        stream_load(spark, layers.path("staging", name), loaded, layers.audit, checkpoint,
                    given.load_date, buckets=layers.bucketed(name),
                    unparsed_path=layers.path("quarantine", f"{name}_times"))


def close_versions(spark, given, layers):
    for name in given.dataset:
        loaded = layers.path("ingestion", name)
        plans.close_versions(spark, loaded, f"{loaded}_closed" if given.buckets else None)


def correlate(spark, given, layers):
    plans.correlate_layers(spark, layers)


def update(spark, given, layers):
    plans.update_analytical(spark, layers)


def run_all(spark, given, layers):
    plans.run_all(spark, sources(given), layers, given.load_date)


JOBS = {
    "snapshot": snapshot,
    "stage": stage,
    "full-load": load,
    "incremental-load": load,
    "stream-load": stream,
    "close-versions": close_versions,
    "correlate": correlate,
    "update-analytical": update,
    "run-all": run_all,
}


def main(argv: list[str] | None = None) -> None:
    given = arguments(argv)
    spark = SparkSession.builder.appName(f"beaconmill {given.job}").getOrCreate()
    JOBS[given.job](spark, given, plans.Layers(given.root, given.buckets, given.database))


if __name__ == "__main__":
    main()
