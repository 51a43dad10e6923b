"""What several operators share: stored steps, bounded samples, batches, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconmill.scratch import remove_dir, scratch_dir


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends there."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(*tables: DataFrame) -> None:
    """The files of stored tables go, each table with a folder of its own; nothing may read them afterwards."""
    for df in tables:
        for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
            remove_dir(df.sparkSession, path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it each action's shuffle files go when it ends, not when the driver next collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def unused(columns: list[str], name: str) -> str:
    """``name``, longer by underscores until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(column: str, divisor: int) -> Column:
    """``crc32`` of the value as text, modulo ``divisor``; 0 where the value is null."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % divisor, F.lit(0))


def share(column: Column, part: float) -> Column:
    """True for about ``part`` of all values, the same ones in every run."""
    return F.pmod(F.xxhash64(F.lit("sample"), column), F.lit(1_000_003)) < int(min(part, 1.0) * 1_000_003)


def rows(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    return zip(*(batch.column(c).to_pylist() for c in columns), strict=True)


def slices(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = 16_000_000) -> Iterator[pa.RecordBatch]:
    """The batches, cut where their texts would fill more than about ``most_bytes``."""
    for batch in batches:
        column = batch.column(text)
        size = max(1, column.nbytes)
        step = max(1, batch.num_rows * most_bytes // size) if size > most_bytes else batch.num_rows
        for at in range(0, batch.num_rows, max(1, step)):
            yield batch.slice(at, step)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node on an edge ``(a, b)``; the root is the smallest node.

    Alternating large and small stars: each round is a few joins on node ids, and the
    number of rounds grows with the logarithm of the longest chain. The smallest
    neighbours are stored before the join, so that adaptive execution can split a node
    with very many edges.
    """

    def star(pairs: DataFrame, least: DataFrame) -> DataFrame:
        return pairs.join(least, "u")

    now = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    while True:
        # done when the edges are stars: each node has one parent, and no parent has one
        parents = now.select(F.col("v").alias("node"), F.lit(0).alias("up")).distinct()
        sides = now.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(parents)
        shape = sides.groupBy("node").agg(F.sum("up").alias("parents"), F.min("up").alias("low"))
        if shape.filter("parents > 1 or (parents = 1 and low = 0)").isEmpty():
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = star(both.filter("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u <> v").distinct(), "large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = star(large, least).select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")
        )
        now = stored(small.select("e.u", "e.v").filter("u <> v").distinct(), "small")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
