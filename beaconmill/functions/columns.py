"""Column expressions shared by the operators. All of them run inside code generation."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def event_id(*columns: str) -> Column:
    """A content hash that names an event the same way in every run.

    NULL counts as the empty string, so a missing value keeps its position.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def all_present(columns: Iterable[str]) -> Column:
    """True where none of the columns is NULL. Written as ``IS NOT NULL`` terms,
    which reach a Parquet scan; those of ``dropna`` do not."""
    return reduce(and_, (F.col(c).isNotNull() for c in columns))


def instant(value: datetime | str, data_type: str = "timestamp") -> Column:
    """A timestamp literal. Text and naive datetimes are read in the session time zone."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast(data_type)


def micros(df: DataFrame, column: str) -> Column:
    """Microseconds since the epoch, for arithmetic on time ranges.

    A time without a zone is taken as UTC whatever the zone of the session is, in which
    an hour can be missing or come twice.
    """
    return F.expr(_micros(df, column))


def time_bucket(df: DataFrame, column: str, width: int) -> Column:
    """The number of the bucket, ``width`` microseconds wide, that holds the time."""
    at = _micros(df, column)
    return F.expr(f"({at} - pmod({at}, {width})) div {width}")


def _micros(df: DataFrame, column: str) -> str:
    if df.schema[column].dataType.typeName() == "timestamp_ntz":
        # the difference of two such times needs no zone, unlike a cast or timestampdiff
        span = f"cast(`{column}` - timestamp_ntz'1970-01-01' as interval second)"
        return f"cast(cast({span} as decimal(18, 6)) * 1000000 as bigint)"
    return f"unix_micros(cast(`{column}` as timestamp))"


def refuse_column(df: DataFrame, name: str) -> None:
    """An operator that adds a column cannot take a table that has it."""
    if name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"the table already has a column named {name}")


def unused(columns: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names, each longer by underscores until no column, nor another of them, has it."""
    taken, found = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found
