"""Attribution when impression and event times are close rather than equal.

A user may own a third of all rows, so neither join nor window below works on
the user alone: time is cut into buckets first, and what must cross a bucket
boundary travels as one row per bucket.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconmill.functions import all_present, micros, refuse_column, time_bucket, unused
from beaconmill.schemas import TIME, USER


def attribute_within(
    impressions: DataFrame,
    events: DataFrame,
    id_column: str,
    tolerance: timedelta,
    user: str = USER,
    time: str = TIME,
) -> DataFrame:
    """Impressions left outer join the user's events from the impression's time
    until ``tolerance`` later, both ends included. All matches come out.

    With buckets as wide as the tolerance, an event can only serve impressions of
    its own bucket or the one before, so it joins once under each. Matches are an
    inner join, in which adaptive execution can split a hot bucket on either
    side. Impressions without a match are found against the first and last event
    per bucket: two rows, however many events the bucket holds. Both joins read
    one shuffle of the impressions.
    """
    refuse_column(impressions, id_column)
    width = _width(tolerance)
    timed = all_present([user, time])
    at, bucket, first, last = names = unused([*impressions.columns, user, time, id_column], "_at", "_bucket", "_first", "_last")
    left = _bucketed(impressions.filter(timed), time, width, *names[:2])
    right = _bucketed(events.filter(timed).select(user, time, id_column), time, width, *names[:2]).drop(time)
    same = (F.col(f"i.{user}") == F.col(f"e.{user}")) & (F.col(f"i.{bucket}") == F.col(f"e.{bucket}"))
    until = F.col(f"i.{at}") + F.lit(width)
    kept = [F.col(f"i.`{c}`") for c in impressions.columns]
    matched = (
        left.alias("i")
        .join(
            _and_the_one_before(right, bucket).alias("e"),
            same & F.col(f"e.{at}").between(F.col(f"i.{at}"), until),
            "inner",
        )
        .select(*kept, F.col(f"e.{id_column}"))
    )
    spans = right.groupBy(user, bucket).agg(F.min(at).alias(first), F.max(at).alias(last))
    meets = same & (F.col(f"e.{last}") >= F.col(f"i.{at}")) & (F.col(f"e.{first}") <= until)
    missed = left.alias("i").join(_and_the_one_before(spans, bucket).alias("e"), meets, "left_anti").select(*kept)
    without = missed.union(impressions.filter(~timed))
    none = F.lit(None).cast(events.schema[id_column].dataType)
    return matched.union(without.withColumn(id_column, none))


def _width(span: timedelta) -> int:
    if span <= timedelta(0):
        raise ValueError("the time span must be positive; correlate joins equal times")
    return span // timedelta(microseconds=1)


def _bucketed(df: DataFrame, time: str, width: int, at: str, bucket: str) -> DataFrame:
    """Adds the instant and its bucket to rows whose time is present. Declared free of NULL,
    they give every join on them the same plan, and one shuffle serves them all."""
    columns = {at: F.coalesce(micros(df, time), F.lit(0)), bucket: F.coalesce(time_bucket(df, time, width), F.lit(0))}
    return df.withColumns(columns)


def _and_the_one_before(df: DataFrame, bucket: str) -> DataFrame:
    """Every row under its own bucket and under the bucket before it."""
    (under,) = unused(df.columns, "_under")
    shifted = F.explode(F.array(F.col(bucket), F.col(bucket) - 1))
    return df.withColumn(under, shifted).drop(bucket).withColumnRenamed(under, bucket)


def attribute_first(
    impressions: DataFrame,
    events: DataFrame,
    id_column: str,
    tolerance: timedelta,
    user: str = USER,
    time: str = TIME,
) -> DataFrame:
    """Each impression with the id of the user's first event from its time until ``tolerance`` later, or NULL.

    One row per impression, and no pairs are formed on the way: of several events at one
    instant the smallest id counts, and a window finds the next event of the same bucket.
    With buckets as wide as the tolerance, the only other one it can lie in is the next,
    of which the first event is enough.
    """
    refuse_column(impressions, id_column)
    width = _width(tolerance)
    at, bucket, ident, asked, following, later_ = unused([user, time, id_column], "_at", "_bucket", "_id", "_asked", "_next", "_later")
    none = F.lit(None).cast(events.schema[id_column].dataType)
    both = (
        impressions.select(user, time, none.alias(id_column), F.lit(True).alias(asked))
        .unionByName(events.select(user, time, id_column, F.lit(False).alias(asked)))
        .filter(all_present([user, time]))
    )
    instants = (
        both.withColumns({at: micros(both, time), bucket: time_bucket(both, time, width)})
        .groupBy(user, bucket, time, at)
        .agg(F.min(id_column).alias(ident), F.max(asked).alias(asked))
    )
    when = F.when(F.col(ident).isNotNull(), F.struct(F.col(at).alias("at"), F.col(ident).alias("id")))
    from_now = W.partitionBy(user, bucket).orderBy(at).rowsBetween(0, W.unboundedFollowing)
    inside = instants.withColumn(following, F.first(when, ignorenulls=True).over(from_now))
    # the first event of each bucket, under the bucket before it; read from the windows' own shuffle
    later = (
        inside.filter(F.col(ident).isNotNull())
        .groupBy(user, bucket)
        .agg(F.min(when).alias(later_))
        .select(user, (F.col(bucket) - 1).alias(bucket), later_)
    )
    found = F.coalesce(following, later_)
    answers = (
        inside.filter(asked)
        .join(later, [user, bucket], "left_outer")
        .select(user, time, F.when(found["at"] - F.col(at) <= width, found["id"]).alias(id_column))
    )
    same = (F.col(f"i.{user}") == F.col(f"a.{user}")) & (F.col(f"i.{time}") == F.col(f"a.{time}"))
    joined = impressions.alias("i").join(answers.alias("a"), same, "left_outer")
    return joined.select("i.*", F.col(f"a.{id_column}"))


def attribute_last_touch(
    events: DataFrame,
    touches: DataFrame,
    id_column: str,
    user: str = USER,
    time: str = TIME,
    bucket: timedelta = timedelta(minutes=1),
) -> DataFrame:
    """Each event with the id of the user's last touch at or before its time, or NULL.

    Of several touches at one instant the largest id counts. The work is done on
    the distinct instants per user, so copies vanish before the shuffle, and in
    two steps: the last touch within the bucket, else the last one of an earlier
    bucket. A window group holds at most the instants of one bucket, or the
    buckets of one user. The answers then join back to all events.
    """
    refuse_column(events, id_column)
    width = _width(bucket)
    asked = events.select(user, time).withColumn(
        id_column, F.lit(None).cast(touches.schema[id_column].dataType)
    )
    both = (
        asked.withColumn("_asked", F.lit(True))
        .unionByName(touches.select(user, time, id_column).withColumn("_asked", F.lit(False)))
        .filter(all_present([user, time]))
    )
    instants = (
        both.withColumn("_bucket", time_bucket(both, time, width))
        .groupBy(user, "_bucket", time)
        .agg(F.max(id_column).alias("_id"), F.max("_asked").alias("_asked"))
    )
    until_now = W.partitionBy(user, "_bucket").orderBy(time).rowsBetween(W.unboundedPreceding, 0)
    inside = instants.withColumn("_inside", F.last("_id", ignorenulls=True).over(until_now))

    earlier = W.partitionBy(user).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    # read from the windows' own shuffle, which is on the same columns
    carried = (
        inside.groupBy(user, "_bucket")
        .agg(
            F.max_by("_id", F.when(F.col("_id").isNotNull(), F.col(time))).alias("_last"),
            F.max("_asked").alias("_asked"),
        )
        .withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier))
        .filter("_asked")
        .select(user, "_bucket", "_carried")
    )
    answers = (
        inside.filter("_asked")
        .join(carried, [user, "_bucket"], "left_outer")
        .select(user, time, F.coalesce("_inside", "_carried").alias(id_column))
    )
    same = (F.col(f"e.{user}") == F.col(f"a.{user}")) & (F.col(f"e.{time}") == F.col(f"a.{time}"))
    joined = events.alias("e").join(answers.alias("a"), same, "left_outer")
    return joined.select("e.*", F.col(f"a.{id_column}"))
