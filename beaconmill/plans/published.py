"""Datasets made of loads, one directory each, and the list of those that count.

A load is written to a directory of its own, which nobody reads until a new version of the list
names it: one small file, put in place by a rename. So a write that fails changes nothing, and
replacing a dataset, its own rows included, is a list of other directories. What the previous
version held stays for its readers and goes with the version after.

The list also tells of each load when its rows happened, up to which arrival it read, and how
its keys are indexed: a bitmap of 32768 bits for each page of keys, a Bloom filter cut into
rows, built and probed by Spark. An incremental load opens just the loads that may hold a key of it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from beaconmill import storage
from beaconmill.plans.columns import merged
from beaconmill.schemas import KEYS, TIME

LISTS, INDEX = "_lists", "_keys"
BITS = 1 << 15  # of one bitmap: what bitmap_construct_agg makes
PROBES = 6  # bits set for a key
BITS_A_KEY = 24  # gives about one false hit in ten thousand keys


@dataclass(frozen=True)
class Load:
    """One directory of a dataset. Times are microseconds since the epoch; ``mark`` is the
    newest arrival that was read for it, ``pages`` the size of its index, 0 without one, and
    ``schema`` has the columns it was written with."""

    name: str
    rows: int
    first: int | None = None
    last: int | None = None
    untimed: bool = True
    mark: int | None = None
    pages: int = 0
    keys: tuple[str, ...] = ()
    schema: str = ""  # as JSON

    def may_repeat(self, first: int | None, last: int | None, untimed: bool) -> bool:
        """Whether its times leave room for rows of the span, or for rows without a time."""
        timed = first is not None and last is not None and self.first is not None and self.first <= last and first <= self.last
        return bool(timed or (untimed and self.untimed))


@dataclass(frozen=True)
class Listed:
    version: int
    loads: tuple[Load, ...]

    @property
    def mark(self) -> int | None:
        return max((load.mark for load in self.loads if load.mark is not None), default=None)


def listed(spark: SparkSession, path: str, version: int | None = None) -> Listed | None:
    """The newest list of the dataset, or None where it has none."""
    found = [int(n[:-5]) for n in storage.names(spark, f"{path}/{LISTS}") if n.endswith(".json")]
    if not found:
        return None
    version = max(found) if version is None else version
    loads = json.loads(storage.read_text(spark, f"{path}/{LISTS}/{version:012d}.json"))
    return Listed(version, tuple(Load(**{**load, "keys": tuple(load["keys"])}) for load in loads))


def read_loads(spark: SparkSession, path: str, loads: Iterable[Load]) -> DataFrame:
    """The rows of the loads, with all columns that any of them has."""
    loads = list(loads)
    schema = merged(StructType.fromJson(json.loads(text)) for text in dict.fromkeys(load.schema for load in loads))
    return spark.read.schema(schema).parquet(*(f"{path}/{load.name}" for load in loads))


def write_load(
    df: DataFrame, path: str, mark: int | None = None, keys: Sequence[str] = (), time: str = TIME
) -> Load:
    """Write a load that no list names yet, with the index of its keys."""
    spark = df.sparkSession
    name = f"load={uuid.uuid4().hex}"
    storage.times_with_statistics(spark)
    timed = time in df.columns and df.schema[time].dataType.typeName() == "timestamp"
    at = F.unix_micros(time) if timed else F.lit(None).cast("bigint")
    # measured on top of the plan, in the tasks that write: each counts once, however often it has to run
    measured = Observation()
    told = df.observe(measured, F.count(F.lit(1)).alias("rows"), F.min(at).alias("first"), F.max(at).alias("last"), F.count(at).alias("timed"))
    told.write.parquet(f"{path}/{name}")
    rows, first, last, timed = (measured.get[c] for c in ("rows", "first", "last", "timed"))
    pages = 0
    if keys and rows:
        pages = 1 << max(0, (rows * BITS_A_KEY - 1).bit_length() - BITS.bit_length() + 1)
        index = key_pages(spark.read.schema(df.schema).parquet(f"{path}/{name}"), keys, pages)
        index.write.parquet(f"{path}/{INDEX}/{name}")
    return Load(name, rows, first, last, timed < rows, mark, pages, tuple(keys), df.schema.json())


def publish(spark: SparkSession, path: str, loads: Sequence[Load], instead_of: Listed | None) -> Listed:
    """Make ``loads`` the dataset, provided its list is still the one given."""
    version = 0 if instead_of is None else instead_of.version + 1
    text = json.dumps([asdict(load) for load in loads], indent=1)
    if not storage.write_new(spark, f"{path}/{LISTS}/{version:012d}.json", text):
        raise RuntimeError(f"{path} has been changed by another job since version {version - 1}; run again")
    now = Listed(version, tuple(loads))
    if version > 1:
        _retire(spark, path, listed(spark, path, version - 2), {load.name for load in (*now.loads, *instead_of.loads)})
    return now


def _retire(spark: SparkSession, path: str, old: Listed, kept: set[str]) -> None:
    """Remove what only lists before the previous one name."""
    for load in old.loads:
        if load.name not in kept:
            storage.remove(spark, f"{path}/{load.name}")
            storage.remove(spark, f"{path}/{INDEX}/{load.name}")
    storage.remove(spark, f"{path}/{LISTS}/{old.version:012d}.json")


def remove_unlisted(spark: SparkSession, path: str) -> list[str]:
    """Remove the directories that no list names, left by writes that failed. Not while another job writes."""
    versions = [int(n[:-5]) for n in storage.names(spark, f"{path}/{LISTS}") if n.endswith(".json")]
    kept = {load.name for v in versions for load in listed(spark, path, v).loads}
    gone = [n for n in storage.names(spark, path) if n.startswith("load=") and n not in kept] if versions else []
    for name in gone:
        storage.remove(spark, f"{path}/{name}")
        storage.remove(spark, f"{path}/{INDEX}/{name}")
    return gone


def replace_dataset(df: DataFrame, path: str, mark: int | None = None, keys: Sequence[str] = KEYS) -> Load:
    """``df`` in place of the dataset, which it may read. Until the end readers see the old one."""
    spark = df.sparkSession
    before = listed(spark, path)
    load = write_load(df, path, mark, keys)
    publish(spark, path, [load], before)
    return load


def add_load(df: DataFrame, path: str, mark: int | None = None, keys: Sequence[str] = KEYS) -> Load | None:
    """``df`` beside the loads of the dataset. Plain files without a list are added to as they are."""
    spark = df.sparkSession
    before = listed(spark, path)
    if before is None and any(not n.startswith(("_", ".", "load=")) for n in storage.names(spark, path)):
        storage.times_with_statistics(spark)
        df.write.mode("append").parquet(path)
        return None
    load = write_load(df, path, mark, keys)
    publish(spark, path, [*(before.loads if before else ()), load], before)
    return load


def key_pages(df: DataFrame, keys: Sequence[str], pages: int) -> DataFrame:
    """``(pages, page, bits)``: a bitmap for each page of the keys' hashes."""
    page, bits = _places(F.xxhash64(*keys), F.lit(pages))
    spots = df.select(page.alias("page"), F.explode(bits).alias("at"))
    return spots.groupBy("page").agg(F.bitmap_construct_agg("at").alias("bits")).select(F.lit(pages).alias("pages"), "page", "bits")


def _places(key: Column, pages: Column) -> tuple[Column, Column]:
    spots = F.array(*(F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BITS)) for i in range(PROBES)))
    return F.pmod(key, pages).cast("int"), spots


def loads_with(spark: SparkSession, path: str, loads: Sequence[Load], rows: DataFrame, keys: Sequence[str]) -> list[Load]:
    """Those of ``loads`` that may hold a key of ``rows``; one without an index always may.

    The distinct hashes of the keys are joined with the pages of the index. A load that holds none
    of them is named with a probability of about one in ten thousand for each key.
    """
    indexed = [load for load in loads if load.pages and load.keys == tuple(keys)]
    if not indexed:
        return list(loads)
    of_size = F.explode(F.array(*(F.lit(n) for n in sorted({load.pages for load in indexed}))))
    asked = rows.select(F.xxhash64(*keys).alias("key")).distinct().select("key", of_size.alias("pages"))
    page, bits = _places(F.col("key"), F.col("pages"))
    asked = asked.select("pages", page.alias("page"), bits.alias("at"))
    read = spark.read.option("basePath", f"{path}/{INDEX}").schema("pages int, page int, bits binary, load string")
    index = read.parquet(*(f"{path}/{INDEX}/{load.name}" for load in indexed))
    # the bits of a page that a key asks for are all set
    every = F.expr("forall(at, p -> shiftright(cast(conv(hex(substring(bits, cast(p div 8 + 1 as int), 1)), 16, 10) as int), cast(p % 8 as int)) & 1 = 1)")
    found = {f"load={r.load}" for r in asked.join(index, ["pages", "page"]).filter(every).select("load").distinct().collect()}
    return [load for load in loads if load not in indexed or load.name in found]
