"""An audit that proves nothing was lost: what each layer should hold beside what it holds."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconmill.operators import current_versions
from beaconmill.plans.ingest import STAGED, staged
from beaconmill.plans.layers import Layers, append, read_layer
from beaconmill.plans.loads import cleanse, parsed
from beaconmill.schemas import KEYS, LOAD_DATE
from beaconmill.sources import readable

IDS = {"ad_impressions_clicks": "click_id", "ad_impressions_conversions": "conversion_id"}


def fingerprint(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row that tells whether two tables hold the same rows, in whatever order and however often each.

    ``rows`` counts, ``hash`` adds up a 64-bit hash of each whole row, exactly, and ``hash2`` another one: an
    addition does not depend on the order, unlike a hash of hashes, and does not
    cancel repeated rows, unlike an exclusive or. ``keys`` is a sketch of the distinct keys, which may be
    merged with those of other runs. Columns are taken by name, a NULL is a value, and
    all is partial before the one row that is shuffled.
    """
    columns = [_hashable(df, c) for c in sorted(df.columns)]
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)"))
    held = [F.col(k).cast("string") for k in keys if k in df.columns]
    sketch = F.hll_sketch_agg(F.xxhash64(*held, F.lit(0))) if held else F.hll_sketch_agg(F.xxhash64(*columns))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(total(1), F.lit(0).cast("decimal(38,0)")).alias("hash"),
        F.coalesce(total(2), F.lit(0).cast("decimal(38,0)")).alias("hash2"),
        sketch.alias("keys"),
    )


def _hashable(df: DataFrame, column: str) -> Column:
    """The value beside whether it is there: a hash alone passes over NULL."""
    return F.struct(F.col(f"`{column}`").isNull().alias("none"), F.col(f"`{column}`").alias("value"))


def compared(dataset: str, step: str, expected: DataFrame, found: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Both fingerprints of one step as one row, and whether they agree."""
    side = lambda df, name: fingerprint(df, keys).select(F.lit(name).alias("side"), "*")
    both = side(expected, "expected").unionByName(side(found, "found"))
    of = lambda column, name: F.max(F.when(F.col("side") == name, F.col(column))).alias(f"{name}_{column}")
    sketches = [F.hll_sketch_estimate(F.max(F.when(F.col("side") == name, F.col("keys")))).alias(f"{name}_keys") for name in ("expected", "found")]
    row = both.groupBy().agg(*(of(c, name) for c in ("rows", "hash", "hash2") for name in ("expected", "found")), *sketches)
    agrees = reduce(Column.__and__, (F.col(f"expected_{c}") == F.col(f"found_{c}") for c in ("rows", "hash", "hash2")))
    return row.select(F.lit(dataset).alias("dataset"), F.lit(step).alias("step"), agrees.alias("agrees"), "*")


def reconcile(spark: SparkSession, layers: Layers, datasets: Iterable[str] = tuple(STAGED)) -> DataFrame:
    """Compare the layers step by step, append what was found to the audit layer, and return it.

    ``stage``: the rows that staging should hold of the snapshot, with the rows of the newest
    arrival. ``load``: the distinct keys of the staged rows that loads keep, with those of the
    ingestion layer. ``correlate``: the current impressions, with the impression columns of
    each analytical table. A lost, added or changed row, or a key that was not loaded, makes
    the step disagree; two layers that differ agree with a probability of 2^-128.
    Snapshots are replaced by the next one, so ``stage`` is for runs right after staging.
    """
    datasets = list(datasets)
    steps = []
    for dataset in datasets:
        origin, make = STAGED[dataset]
        staging = read_layer(spark, layers.path("staging", dataset))
        newest = staging.agg(F.max(F.unix_micros(LOAD_DATE))).first()[0]
        arrived = staging.filter(F.unix_micros(LOAD_DATE).eqNullSafe(F.lit(newest))).drop(LOAD_DATE)
        snapshot = staged(make(readable(read_layer(spark, layers.path("snapshot", origin)))), "2000-01-01").drop(LOAD_DATE)
        # columns that other arrivals have had are NULL in this one
        snapshot = snapshot.withColumns({c: F.lit(None).cast("string") for c in arrived.columns if c not in snapshot.columns})
        steps.append(compared(dataset, "stage", snapshot, arrived))
        kept = cleanse(parsed(staging)).select(*KEYS).distinct()
        loaded = read_layer(spark, layers.path("ingestion", dataset), layers.bucketed(dataset)).select(*KEYS).distinct()
        steps.append(compared(dataset, "load", kept, loaded))
    if "ad_impressions" in datasets:
        current = current_versions(read_layer(spark, layers.path("ingestion", "ad_impressions"), layers.bucketed("ad_impressions")))
        for name, id_column in IDS.items():
            found = read_layer(spark, layers.path("analytical", name)).drop(id_column)
            steps.append(compared(name, "correlate", current, found))
    run = uuid.uuid4().hex
    place = f"{layers.audit}/_reconciled/run={run}"
    out = reduce(DataFrame.unionByName, steps)
    append(out.withColumn("compared_at", F.current_timestamp()), place)
    return spark.read.parquet(place)


def read_reconciled(spark: SparkSession, layers: Layers) -> DataFrame:
    """All that was ever compared, by run."""
    return spark.read.parquet(f"{layers.audit}/_reconciled")
