"""Staging to ingestion, one step per function. All are lazy, ``df.transform``-friendly."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, AtomicType, DataType, StructType

from beaconmill.functions import all_present, instant, unused
from beaconmill.schemas import IS_CURRENT, KEYS, LOAD_DATE, STANDARD, TIME, USER


def convert_types(df: DataFrame, timestamps: Sequence[str] = (TIME,)) -> DataFrame:
    """Timestamp strings become timestamps; one that does not parse becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast("timestamp") for c in timestamps})


def standardize(df: DataFrame, constants: Mapping[str, str] = STANDARD) -> DataFrame:
    """Set columns to a constant, adding those that are absent."""
    return df.withColumns({c: F.lit(value) for c, value in constants.items()})


def uppercase(df: DataFrame, columns: Sequence[str] = (USER,)) -> DataFrame:
    return df.withColumns({c: F.upper(c) for c in columns})


def drop_null_keys(df: DataFrame, columns: Sequence[str] = (USER,)) -> DataFrame:
    """Keep the rows in which all the columns have a value."""
    return df.filter(all_present(columns))


def deduplicate(
    df: DataFrame, keys: Sequence[str] = KEYS, order_by: Sequence[Column] | None = None
) -> DataFrame:
    """One row per key; NULL equals NULL. ``order_by`` says which row comes first.

    Without it any row would do. The remaining columns settle what it leaves open, so the
    choice is the same however rows are dealt and when tasks are run again. Spark cuts every key
    to one row before the shuffle as well as after (``WindowGroupLimit``), so a
    key that fills a third of the table reaches its reducer as one row per task.
    """
    if set(keys) == set(df.columns):
        return df.distinct()  # hash aggregate, no sort
    rest = [f.name for f in df.schema.fields if f.name not in keys and _sortable(f.dataType)]
    order = [*(order_by or []), *(F.col(c) for c in rest)] or [F.col(c) for c in keys]
    window = W.partitionBy(*keys).orderBy(*order)
    (rank,) = unused(df.columns, "_rank")
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)


def _sortable(data_type: DataType) -> bool:
    if isinstance(data_type, ArrayType):
        return _sortable(data_type.elementType)
    if isinstance(data_type, StructType):
        return all(_sortable(f.dataType) for f in data_type.fields)
    return isinstance(data_type, AtomicType) and data_type.typeName() != "variant"


def newer_than(df: DataFrame, mark: datetime | str, column: str = LOAD_DATE) -> DataFrame:
    """Rows whose time lies strictly after the mark. Text would compare letter by
    letter, so the column has to be a timestamp."""
    data_type = df.schema[column].dataType.simpleString()
    if not data_type.startswith("timestamp"):
        raise TypeError(f"{column} is {data_type}, a watermark needs a timestamp")
    return df.filter(F.col(column) > instant(mark, data_type))


def stamp_version(df: DataFrame, load_ts: datetime | str) -> DataFrame:
    """Add the version columns of one load: when it ran, and that it is current."""
    return df.withColumns({LOAD_DATE: instant(load_ts), IS_CURRENT: F.lit(True)})
