"""Streams with state by event time, over several runs."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from beaconmill import operators as ops
from beaconmill import plans
from beaconmill.streaming import close_stream, stream_correlated, stream_deduplicated

HOUR = timedelta(hours=1)


def staged(spark, rows):
    return spark.createDataFrame(rows, "user_id string, timestamp string, ad_creative_id string")


def run(spark, root, arrival, **more):
    if arrival is not None:
        plans.append(arrival.coalesce(1), f"{root}/staging")
    stream_deduplicated(spark, *(f"{root}/{n}" for n in ("staging", "out", "late", "audit", "state")), HOUR, **more)
    out = plans.read_if_present(spark, f"{root}/out")
    late = plans.read_if_present(spark, f"{root}/late")
    return [[] if df is None else sorted(r.ad_creative_id for r in df.collect()) for df in (out, late)]


def test_late_rows_are_kept_apart_and_keys_come_out_once(spark, tmp_path):
    root = str(tmp_path)
    first = [("u1", "2024-05-01 10:00:00", "b"), ("u1", "2024-05-01 10:00:00", "a"), ("u2", "2024-05-01 12:00:00", "c"), (None, "2024-05-01 12:00:00", "gone"), ("u3", "no time", "n")]
    assert run(spark, root, staged(spark, first)) == [["a", "c"], ["n"]]
    second = [("u2", "2024-05-01 12:00:00", "again"), ("u1", "2024-05-01 11:00:00", "just in time"), ("u1", "2024-05-01 10:59:59", "late"), ("u9", "2024-05-02 00:00:00", "d")]
    assert run(spark, root, staged(spark, second)) == [["a", "c", "d", "just in time"], ["late", "n"]]
    assert run(spark, root, None) == [["a", "c", "d", "just in time"], ["late", "n"]]  # a restart without files
    third = [("u9", "2024-05-02 00:00:00", "once more"), ("u1", "2024-05-01 11:00:00", "now late"), ("u5", "2024-05-01 23:00:00", "e")]
    assert run(spark, root, staged(spark, third)) == [["a", "c", "d", "e", "just in time"], ["late", "n", "now late"]]
    counts = plans.read_audit(spark, f"{root}/audit").groupBy("operation").agg(F.sum("record_count")).collect()
    assert dict(map(tuple, counts)) == {"stream_read": 11, "stream_late": 3}


def test_batches_of_one_file_each(spark, tmp_path):
    root = str(tmp_path)
    for hour in range(6):
        rows = [(f"u{u}", f"2024-05-01 {h:02d}:00:00", f"{hour}") for u in range(3) for h in (hour, hour - 1) if h >= 0]
        plans.append(staged(spark, rows).coalesce(1), f"{root}/staging")
    out, late = run(spark, root, None, max_files=1)
    assert len(out) == 18 and late == []
    with pytest.raises(ValueError):
        run(spark, root, None, keys=["user_id"])


def test_stream_of_two_equals_the_batch(spark, tmp_path):
    def part(frame, day):
        return frame.filter(F.col("timestamp").isNull() if day is None else F.to_date("timestamp") == F.lit(day))

    stamps = [(f"u{n % 7}", f"2024-05-0{1 + n % 3} {n % 5:02d}:00:00", f"i{n}") for n in range(60)]
    impressions = spark.createDataFrame(stamps, "user_id string, timestamp string, ad string").withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    odd = spark.createDataFrame([(None, None, "x"), ("u1", None, "y")], "user_id string, timestamp timestamp, ad string")
    impressions = impressions.unionByName(odd)
    clicks = impressions.filter("ad like '%3' or ad like '%5' or ad = 'y'").withColumnRenamed("ad", "click_id")
    clicks = clicks.unionByName(clicks.filter("click_id = 'i13'").withColumn("click_id", F.lit("twice")))
    paths = [str(tmp_path / n) for n in ("impressions", "clicks", "out", "state")]
    settled = []
    for day in ("2024-05-01", "2024-05-02", "2024-05-03", None):
        plans.append(part(impressions, day), paths[0])
        plans.append(part(clicks, day), paths[1])
        stream_correlated(spark, *paths, "click_id", HOUR)
        settled.append(spark.read.parquet(paths[2]).count())
    assert settled == sorted(settled) and settled[0] < settled[-1]
    close_stream(spark, *paths[:2], delay=HOUR)
    stream_correlated(spark, *paths, "click_id", HOUR)
    got = sorted(map(repr, spark.read.parquet(paths[2]).collect()))
    want = sorted(map(repr, ops.correlate(impressions, clicks, "click_id").collect()))
    assert got == want and settled[-1] < len(want)
