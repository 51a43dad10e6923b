"""Impressions with the events of the same user at the same time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconmill.functions import all_present, refuse_column
from beaconmill.schemas import KEYS


def correlate(
    impressions: DataFrame,
    events: DataFrame,
    id_column: str,
    keys: Sequence[str] = KEYS,
    one_per_key: bool = False,
) -> DataFrame:
    """Impressions left outer join events on the keys: all impression columns and the id.

    Every impression stays; one with several events comes out several times; a
    NULL key never matches.

    In an outer join adaptive execution can split a key that is hot on the left, but
    not on the right. So matches are an inner join, in which it splits either side,
    and impressions without one are found against the distinct keys of the events.
    Both joins read one shuffle of the impressions. Pass ``one_per_key`` for events that
    hold each key once, as current rows do: they need no splitting, and one outer join does.
    """
    refuse_column(impressions, id_column)
    if one_per_key:
        ids = events.select(*keys, id_column).filter(all_present(keys))
        joined = impressions.alias("i").join(ids.alias("e"), _equal(keys), "left_outer")
        return joined.select("i.*", F.col(f"e.{id_column}"))
    present = all_present(keys)
    left = impressions.filter(present)
    ids = events.select(*keys, id_column).filter(present)
    kept = [F.col(f"i.`{c}`") for c in impressions.columns]
    matched = left.alias("i").join(ids.alias("e"), _equal(keys), "inner").select(*kept, F.col(f"e.{id_column}"))
    missed = left.alias("i").join(ids.select(*keys).distinct().alias("e"), _equal(keys), "left_anti").select(*kept)
    without = missed.union(impressions.filter(~present))
    return matched.union(without.withColumn(id_column, F.lit(None).cast(events.schema[id_column].dataType)))


def _equal(columns: Sequence[str], left: str = "i", right: str = "e") -> Column:
    return reduce(and_, (F.col(f"{left}.{c}") == F.col(f"{right}.{c}") for c in columns))
