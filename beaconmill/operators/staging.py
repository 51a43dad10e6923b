"""Snapshot to staging: flatten, rename, stringify, stamp the arrival, split interactions."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from beaconmill.functions import event_id, instant
from beaconmill.schemas import INTERACTION_NAMES, LOAD_DATE, TIME, USER


def flatten(df: DataFrame, prefix: bool = False) -> DataFrame:
    """Replace every struct column by its leaves, at any depth, in one projection.

    Leaves keep their own name, or with ``prefix`` the path joined by ``_``.
    Two leaves of one name are an error. Arrays stay as they are.
    """
    leaves = list(_leaves(df.schema, ()))
    names = ["_".join(path) if prefix else path[-1] for path in leaves]
    twice = [name for name, n in Counter(name.lower() for name in names).items() if n > 1]
    if twice:
        raise ValueError(f"flatten: more than one leaf is named {', '.join(sorted(twice))}")
    return df.select([_nested(path).alias(name) for path, name in zip(leaves, names)])


def _leaves(schema: StructType, above: tuple[str, ...]):
    for part in schema.fields:
        path = (*above, part.name)
        if isinstance(part.dataType, StructType):
            yield from _leaves(part.dataType, path)
        else:
            yield path


def _nested(path: tuple[str, ...]) -> Column:
    return F.col(".".join("`" + name.replace("`", "``") + "`" for name in path))


def stringify(df: DataFrame) -> DataFrame:
    """Cast every column to string in one projection. Flatten first: a struct
    cast to string loses its field names."""
    return df.select([_nested((c,)).cast("string").alias(c) for c in df.columns])


def rename_interactions(df: DataFrame) -> DataFrame:
    """The header names of the interactions file become the canonical names."""
    return df.withColumnsRenamed(INTERACTION_NAMES)


def stamp_arrival(df: DataFrame, arrived: datetime | str) -> DataFrame:
    """Add ``load_date``, the mark incremental loads filter on. Apply it after
    ``stringify``: it has to stay a timestamp."""
    return df.withColumn(LOAD_DATE, instant(arrived))


def clicks_of(interactions: DataFrame) -> DataFrame:
    """Every interaction is a click; adds ``click_id``."""
    return interactions.withColumn("click_id", _interaction_id())


def conversions_of(interactions: DataFrame) -> DataFrame:
    """Interactions that name a conversion type; adds ``conversion_id``."""
    named = interactions.filter(F.col("conversion_type").isNotNull())
    return named.withColumn("conversion_id", _interaction_id())


def _interaction_id() -> Column:
    return event_id(USER, TIME, "ad_campaign_id", "conversion_type")
