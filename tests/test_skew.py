"""One key holds a third of the rows: does its work spread over tasks?"""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from beaconmill import operators as ops

TASKS = 16
SETTINGS = {
    "spark.sql.shuffle.partitions": str(TASKS),
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


@pytest.fixture
def cluster_like(spark):
    """Small sizes count as large, so that 100,000 rows bring out what a table would."""
    before = {name: spark.conf.get(name) for name in SETTINGS if spark.conf.get(name, None) is not None}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield spark
    for name in SETTINGS:
        spark.conf.unset(name)
    for name, value in before.items():
        spark.conf.set(name, value)


def skewed(spark, rows, column):
    return spark.range(0, rows, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', concat('u', id)) as user_id",
        "timestamp_seconds(if(id % 3 = 0, 0, id)) as timestamp",
        f"sha2(cast(id as string), 256) as {column}",
    )


def even(spark, rows, column):
    return spark.range(0, rows, 1, 8).selectExpr(
        "if(id = 0, 'hot', concat('u', id)) as user_id",
        "timestamp_seconds(id) as timestamp",
        f"sha2(cast(id as string), 256) as {column}",
    )


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    done = df.filter(F.lit(True))
    rows = done.collect()
    return done._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0], rows


def test_hot_impressions_are_split(cluster_like):
    joined = ops.correlate(skewed(cluster_like, 60_000, "ad"), even(cluster_like, 60_000, "click_id"), "click_id", one_per_key=True)
    plan, rows = final_plan(joined)
    assert len(rows) == 60_000
    assert "skew=true" in plan


def largest_share(df):
    """Of the rows of the last stage, the share that its busiest task has."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    return max(sizes) / sum(sizes)


def test_hot_events_are_split(cluster_like):
    impressions, events = even(cluster_like, 2_000, "ad"), skewed(cluster_like, 60_000, "click_id")
    plan, rows = final_plan(ops.correlate(impressions, events, "click_id"))
    assert len(rows) == 20_000 + 1_999
    assert "skew=true" in plan and "skewed" in plan
    assert "ReusedExchange" in plan


def test_hot_versions_are_spread_by_their_content(cluster_like):
    cluster_like.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    versions = skewed(cluster_like, 60_000, "ad").selectExpr(
        "user_id", "timestamp", "ad", "timestamp_seconds(0) as load_date", "true as is_current"
    )
    closed = ops.close_out(versions)
    assert closed.count() == 60_000
    assert closed.filter("is_current").count() == 40_001
    assert largest_share(closed) < 0.35


@pytest.mark.parametrize("hot_side", ["impressions", "events"])
def test_hot_users_are_split_in_attribution(cluster_like, hot_side):
    spark = cluster_like
    hot, cool = skewed(spark, 60_000, "ad"), even(spark, 60_000, "ad")
    left, right = (hot, cool) if hot_side == "impressions" else (cool, hot)
    joined = ops.attribute_within(left, right.withColumnRenamed("ad", "click_id"), "click_id", timedelta(seconds=10))
    plan, rows = final_plan(joined)
    assert len(rows) >= 60_000
    splits = {"impressions": 2, "events": 1}  # joins that meet the hot side unsummed
    assert plan.count("skew=true") == splits[hot_side]


def test_last_touch_sees_each_instant_once(cluster_like):
    spark = cluster_like
    joined = ops.attribute_last_touch(skewed(spark, 60_000, "ad"), skewed(spark, 60_000, "touch"), "touch")
    plan, rows = final_plan(joined)
    assert len(rows) == 60_000 and all(r.touch for r in rows)
    assert "partial_max" in plan[plan.index("Window"):]
    assert "skew=true" in plan[:plan.index("Window")]


def test_deduplication_shuffles_a_hot_key_once_per_task(cluster_like):
    spark = cluster_like
    df = skewed(spark, 60_000, "ad")
    assert ops.deduplicate(df).count() == 40_001
    deduplicated = ops.deduplicate(df)
    plan, _ = final_plan(deduplicated)
    shuffled = plan[plan.index("ShuffleQueryStage"):]
    assert "WindowGroupLimit" in shuffled and "Partial" in shuffled
