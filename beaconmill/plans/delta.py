"""The analytical tables kept up to date: only what the loads since the last run touch is joined again."""

from __future__ import annotations

import json
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconmill import storage
from beaconmill.operators import correlate, current_versions
from beaconmill.plans.audit import append_audit
from beaconmill.plans.layers import EVENT_DAY, Layers, overwrite
from beaconmill.plans.published import Listed, Load, listed, loads_with, read_loads
from beaconmill.schemas import KEYS, READ_INGESTION, TIME
from beaconmill.scratch import remove_dir, scratch_dir

IDS = {"clicks": "click_id", "conversions": "conversion_id"}
NAMES = ("ad_impressions", *IDS)
NO_DAY = "none"  # the directory of impressions without a time


def update_analytical(spark: SparkSession, layers: Layers) -> list[str] | None:
    """Bring both analytical tables up to the loads of the ingestion layer.

    The tables have a directory per day of the impression. The keys that new loads of any of
    the three datasets hold are joined alone: their current versions, found in the loads that
    their times and key indexes leave room for. Of the days that have such keys the other rows are
    kept, and these days are written anew; the files of all other days stay as they are.

    Returns the days written, or None after a whole run, which the first one is and every
    one after a dataset was replaced. What has been read is noted last, so a run that failed
    is made up for by the next one.
    """
    now = {name: listed(spark, layers.path("ingestion", name)) for name in NAMES}
    missing = [name for name, found in now.items() if found is None]
    if missing:
        raise ValueError(f"{', '.join(missing)}: no list of loads; bucketed tables and plain files are for correlate_layers")
    seen = _state(spark, layers)
    held = {name: {load.name for load in found.loads} for name, found in now.items()}
    if seen is None or any(not set(seen[name]) <= held[name] for name in NAMES):
        joined = _joined({name: read_loads(spark, layers.path("ingestion", name), now[name].loads) for name in NAMES})
        days = None
        _write(spark, layers, joined, None, None)
    else:
        new = {name: [load for load in now[name].loads if load.name not in seen[name]] for name in NAMES}
        if not any(new.values()):
            return []
        days = _update(spark, layers, now, new)
    _note(spark, layers, held)
    append_audit(spark, layers.audit, [(READ_INGESTION, sum(load.rows for load in now[name].loads)) for name in NAMES])
    return days


def _update(spark: SparkSession, layers: Layers, now: dict[str, Listed], new: dict[str, list[Load]]) -> list[str]:
    paths = {name: layers.path("ingestion", name) for name in NAMES}
    scratch = scratch_dir(spark, "touched")
    parts = [read_loads(spark, paths[name], loads).select(*KEYS) for name, loads in new.items() if loads]
    overwrite(reduce(DataFrame.unionByName, parts).distinct().withColumn(EVENT_DAY, _day()), f"{scratch}/keys")
    touched = spark.read.parquet(f"{scratch}/keys")
    at = F.unix_micros(TIME)
    span = touched.agg(F.min(at), F.max(at), F.count(F.lit(1)) > F.count(at)).first()
    days = sorted(r[0] for r in touched.select(EVENT_DAY).distinct().collect())
    frames = {}
    for name in NAMES:
        loads = [load for load in now[name].loads if load.may_repeat(*span)]
        loads = loads_with(spark, paths[name], loads, touched, KEYS) if loads else []
        columns = read_loads(spark, paths[name], now[name].loads).schema  # of all loads, also those not opened
        found = spark.read.schema(columns).parquet(*(f"{paths[name]}/{load.name}" for load in loads or now[name].loads[:1]))
        frames[name] = _of_keys(found, touched, days)
    overwrite(_joined(frames), f"{scratch}/joined")
    # an impression's days are its own: where only an event is new, there may be none
    joined = spark.read.parquet(f"{scratch}/joined")
    changed = sorted(r[0] for r in joined.select(EVENT_DAY).distinct().collect())
    _write(spark, layers, joined, touched, changed)
    remove_dir(spark, scratch)
    return changed


def _of_keys(df: DataFrame, touched: DataFrame, days: list[str]) -> DataFrame:
    """The rows with a touched key; the range of days reaches the Parquet scan."""
    dated = [d for d in days if d != NO_DAY]
    within = F.col(TIME).isNull()
    if dated:
        first, last = F.lit(dated[0]).cast("date"), F.lit(dated[-1]).cast("date")
        within = within | ((F.col(TIME) >= first.cast("timestamp")) & (F.col(TIME) < F.date_add(last, 1).cast("timestamp")))
    return df.filter(within).alias("d").join(touched.alias("t"), _same("d", "t"), "left_semi")


def _joined(frames: dict[str, DataFrame]) -> DataFrame:
    """Current impressions with both ids, and the day of each."""
    joined = current_versions(frames["ad_impressions"])
    for name, id_column in IDS.items():
        joined = correlate(joined, current_versions(frames[name]), id_column, one_per_key=True)
    return joined.withColumn(EVENT_DAY, _day())


def _write(spark: SparkSession, layers: Layers, joined: DataFrame, touched: DataFrame | None, days: list[str] | None) -> None:
    """Write all days, or those given, with the rows that are there and have no touched key."""
    if days is None:
        scratch = scratch_dir(spark, "correlated")
        overwrite(joined, scratch)
        joined = spark.read.parquet(scratch)
    for name, id_column in IDS.items():
        path = layers.path("analytical", f"ad_impressions_{name}")
        rows = joined.drop(*(c for c in IDS.values() if c != id_column))
        if days is not None:
            # a column that came later is NULL in the files of other days
            there = spark.read.schema(rows.schema).parquet(path).filter(F.col(EVENT_DAY).isin(days))
            kept = there.alias("d").join(touched.alias("t"), _same("d", "t"), "left_anti")
            rows = kept.select(*rows.columns).unionByName(rows)
        storage.times_with_statistics(spark)
        # one file a day where it is small; adaptive execution splits the days that are large
        spread = rows.hint("rebalance", EVENT_DAY)
        writer = spread.write.mode("overwrite").option("partitionOverwriteMode", "static" if days is None else "dynamic")
        if days is None or days:
            writer.partitionBy(EVENT_DAY).parquet(path)
    if days is None:
        remove_dir(spark, scratch)


def _day():
    return F.coalesce(F.date_format(TIME, "yyyy-MM-dd"), F.lit(NO_DAY))


def _same(left: str, right: str):
    return reduce(and_, (F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in KEYS))


def _place(layers: Layers) -> str:
    return f"{layers.path('analytical')}/_propagated"


def _state(spark: SparkSession, layers: Layers) -> dict[str, list[str]] | None:
    found = [n for n in storage.names(spark, _place(layers)) if n.endswith(".json")]
    return json.loads(storage.read_text(spark, f"{_place(layers)}/{max(found)}")) if found else None


def _note(spark: SparkSession, layers: Layers, held: dict[str, set[str]]) -> None:
    found = [n for n in storage.names(spark, _place(layers)) if n.endswith(".json")]
    turn = int(max(found)[:-5]) + 1 if found else 0
    text = json.dumps({name: sorted(loads) for name, loads in held.items()})
    if not storage.write_new(spark, f"{_place(layers)}/{turn:012d}.json", text):
        raise RuntimeError("the analytical tables are being updated by another job; run again")
    for old in found:
        storage.remove(spark, f"{_place(layers)}/{old}")
