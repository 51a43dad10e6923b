"""Row versions across loads: which are current, and which keys are already loaded."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconmill.functions import unused
from beaconmill.schemas import IS_CURRENT, KEYS, LOAD_DATE, TIME


def close_out(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Set ``is_current`` on one version of every key and clear it on the others.

    The newest load date decides, then a hash of the row's content, then, among equal
    rows, any one of them. Each task cuts a key to its newest version before the shuffle
    (``WindowGroupLimit``); joining that back on key, load date and hash leaves no task
    that must hold all versions of one key, only equal copies of one row meet.
    """
    content, rank, first, copy = unused(df.columns, "_hash", "_rank", "_newest", "_copy")
    marked = df.drop(IS_CURRENT).withColumn(content, _content(df, keys))
    newest = W.partitionBy(*keys).orderBy(F.desc(LOAD_DATE), content)
    at = [*keys, LOAD_DATE, content]
    top = marked.select(*at, F.row_number().over(newest).alias(rank)).filter(F.col(rank) == 1).drop(rank)
    copies = W.partitionBy(*at).orderBy(content)
    joined = marked.alias("v").join(top.withColumn(first, F.lit(True)).alias("n"), _same(at, "v", "n"), "left_outer")
    ranked = joined.select("v.*", f"n.{first}").withColumn(copy, F.when(F.col(first), F.row_number().over(copies)))
    current = F.coalesce(F.col(copy) == 1, F.lit(False)).alias(IS_CURRENT)
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns if c != IS_CURRENT], current)


def current_versions(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Just the version of every key that ``close_out`` calls current, whether or not it has run.

    One shuffle on the keys, which a join on them afterwards reuses.
    """
    content, rank = unused(df.columns, "_hash", "_rank")
    marked = df.withColumn(content, _content(df, keys))
    newest = W.partitionBy(*keys).orderBy(F.desc(LOAD_DATE), content)
    return marked.withColumn(rank, F.row_number().over(newest)).filter(F.col(rank) == 1).drop(rank, content)


def _content(df: DataFrame, keys: Sequence[str]) -> Column:
    """A hash of what a row holds beside its key and version columns."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns) if c not in (*keys, LOAD_DATE, IS_CURRENT)], F.lit(0))


def not_loaded(incoming: DataFrame, target: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The incoming rows whose key the target does not hold; NULL equals NULL.

    Meant for deduplicated rows. The target is reduced to its distinct keys
    before the shuffle, so repeated keys cost nothing.
    """
    known = target.select(*keys).distinct().alias("t")
    return incoming.alias("i").join(known, _same(keys, "i", "t"), "left_anti")


def within_span(
    target: DataFrame, first_micros: int | None, last_micros: int | None, time: str = TIME
) -> DataFrame:
    """The rows of the target that rows of the span can repeat: times in it, and NULL.

    Put before ``not_loaded`` it keeps an incremental load from reading the keys of
    loads that lie long back.
    """
    at = F.col(time)
    if first_micros is None or last_micros is None:
        return target.filter(at.isNull())
    first, last = (F.timestamp_micros(F.lit(micros)) for micros in (first_micros, last_micros))
    return target.filter(at.isNull() | at.between(first, last))


def _same(columns: Sequence[str], left: str, right: str):
    return reduce(and_, (F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns))
