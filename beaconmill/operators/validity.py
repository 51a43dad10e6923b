"""Which version of a key was valid when: intervals from versions, and a join by point in time."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconmill.functions import all_present, micros, refuse_column, time_bucket, unused
from beaconmill.schemas import LOAD_DATE

VALID_FROM, VALID_TO = "valid_from", "valid_to"


def validity(versions: DataFrame, keys: Sequence[str], start: str = LOAD_DATE, bucket: timedelta = timedelta(days=1)) -> DataFrame:
    """The versions with ``valid_from``, their own start, and ``valid_to``, the next later start of the key.

    The newest versions are open: ``valid_to`` is NULL. Versions of a key with one start are valid
    together. Rows without a start are valid never: both ends are NULL. NULL equals NULL in keys.

    The work is done on the distinct starts, which are looked up within a bucket of time
    and else in the key's next bucket: a window holds the starts of one key and bucket,
    or the buckets of one key. The answers join back to all versions.
    """
    for column in (VALID_FROM, VALID_TO):
        refuse_column(versions, column)
    width = bucket // timedelta(microseconds=1)
    part, following, later, own = unused([*versions.columns, *keys], "_part", "_following", "_later", "_own")
    starts = versions.filter(F.col(start).isNotNull()).select(*keys, F.col(start).alias(own)).distinct()
    starts = starts.withColumn(part, time_bucket(starts, own, width))
    inside = starts.withColumn(following, F.lead(own).over(W.partitionBy(*keys, part).orderBy(own)))
    firsts = inside.groupBy(*keys, part).agg(F.min(own).alias(later))
    firsts = firsts.withColumn(later, F.lead(later).over(W.partitionBy(*keys).orderBy(part)))
    ends = inside.alias("s").join(firsts.alias("f"), _same([*keys, part], "s", "f"), "left_outer")
    ends = ends.select(*(F.col(f"s.{c}") for c in (*keys, own)), F.coalesce(following, later).alias(VALID_TO))
    found = versions.alias("v").join(ends.alias("e"), _same(keys, "v", "e") & (F.col(f"v.{start}") == F.col(f"e.{own}")), "left_outer")
    return found.select("v.*", F.col(f"v.{start}").alias(VALID_FROM), F.col(f"e.{VALID_TO}"))


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    time: str,
    columns: Sequence[str],
    bucket: timedelta = timedelta(days=1),
) -> DataFrame:
    """The facts, left outer, with ``columns`` of the versions of their key that were valid at their ``time``.

    ``versions`` are as ``validity`` gives them: from ``valid_from`` on and before ``valid_to``, or
    for good where that is NULL. Several versions valid at once all come out; a fact whose key or
    time is NULL, or that no version covers, stays with NULL.

    Each interval is cut by ``bucket`` into the parts that facts lie in, an open one at the last
    fact, so that a key which holds a third of the facts is joined bucket by bucket: an
    inner join on key and bucket, in which adaptive execution may split either side. Facts
    without a match are found against the distinct spans that are covered, one row per
    key, bucket and interval.
    """
    for column in columns:
        refuse_column(facts, column)
    width = bucket // timedelta(microseconds=1)
    at, part, first, last = unused([*facts.columns, *keys, *columns], "_at", "_part", "_from", "_to")
    present = all_present([*keys, time])
    timed = facts.filter(present)
    timed = timed.withColumns({at: F.coalesce(micros(timed, time), F.lit(0)), part: F.coalesce(time_bucket(timed, time, width), F.lit(0))})
    begin, end = micros(versions, VALID_FROM), micros(versions, VALID_TO)
    spans = versions.filter(all_present([*keys, VALID_FROM])).withColumns({first: begin, last: F.coalesce(end, F.lit((1 << 63) - 1))}).filter(F.col(first) < F.col(last))
    # cut at the buckets that facts of any key lie in: two numbers
    low, high = timed.agg(F.min(part), F.max(part)).first()
    bucket_of = lambda c: f"((`{c}` - pmod(`{c}`, {width})) div {width})"
    ends = [f"greatest({low or 0}, {bucket_of(first)})", f"least({-1 if high is None else high}, {bucket_of(last)})"]
    cut = spans.select(*keys, *columns, first, last).filter(f"{ends[0]} <= {ends[1]}").withColumn(part, F.explode(F.expr(f"sequence({ends[0]}, {ends[1]})")))
    same = reduce(and_, (F.col(f"f.{c}") == F.col(f"v.{c}") for c in (*keys, part)))
    valid = same & (F.col(f"v.{first}") <= F.col(f"f.{at}")) & (F.col(f"f.{at}") < F.col(f"v.{last}"))
    kept = [F.col(f"f.`{c}`") for c in facts.columns]
    matched = timed.alias("f").join(cut.alias("v"), valid, "inner").select(*kept, *(F.col(f"v.{c}") for c in columns))
    covered = cut.select(*keys, part, first, last).distinct()
    missed = timed.alias("f").join(covered.alias("v"), valid, "left_anti").select(*kept)
    without = missed.unionByName(facts.filter(~present))
    return matched.unionByName(without.withColumns({c: F.lit(None).cast(versions.schema[c].dataType) for c in columns}))


def _same(columns: Sequence[str], left: str, right: str):
    return reduce(and_, (F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns))
