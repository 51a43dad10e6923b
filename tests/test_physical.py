"""What the plans look like: pruned scans, reduction before shuffles, no cross joins."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from beaconmill import operators as ops
from beaconmill import plans

SF_DIR = "/root/testdata/sf0.001"
LAZY = [
    "analytical", "attribute_interval", "attribute_last_touch", "correlate_clicks", "correlate_hot_keys",
    "dedup_keep_latest", "full_load", "incremental_anti_join", "incremental_load", "incremental_skip_loaded",
    "scd2_current",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_query_joins_without_an_equal_key(spark, name):
    text = plan(registered.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text


@pytest.fixture
def staging(spark, tmp_path):
    path = str(tmp_path / "staging")
    df = spark.range(1000).selectExpr(
        "concat('u', id) as user_id", "cast(timestamp_seconds(id) as string) as timestamp", "'x' as ad",
        "'w' as website", "timestamp_seconds(id) as load_date",
    )
    df.write.parquet(path)
    return plans.read_layer(spark, path)


def test_loads_push_their_filters_and_prune_overwritten_columns(staging):
    text = plan(plans.full_load_frame(staging, "2024-06-01"))
    assert "PushedFilters: [IsNotNull(user_id)]" in text
    assert "website:string" not in text.split("ReadSchema")[1]
    text = plan(plans.incremental_load_frame(staging, "1970-01-01 00:01:00", "2024-06-01"))
    assert "GreaterThan(load_date," in text and "IsNotNull(user_id)" in text


def test_a_load_is_one_shuffle_and_cuts_keys_before_it(staging):
    text = plan(plans.full_load_frame(staging, "2024-06-01"))
    assert text.count("Exchange") == 1
    before = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_loaded_frames_correlate_without_another_shuffle(staging):
    loaded = plans.full_load_frame(staging, "2024-06-01")
    other = plans.full_load_frame(staging.withColumnRenamed("ad", "click_id"), "2024-06-01")
    text = plan(ops.correlate(loaded, other, "click_id", one_per_key=True))
    assert text.count("Exchange hashpartitioning") <= 3


def test_correlation_reads_three_columns_of_the_events(staging):
    events = staging.withColumnRenamed("ad", "click_id")
    text = plan(ops.correlate(staging, events, "click_id", one_per_key=True))
    assert "ReadSchema: struct<user_id:string,timestamp:string,ad:string>" in text
    assert "PushedFilters: [IsNotNull(user_id), IsNotNull(timestamp)]" in text


def test_audit_counts_read_only_their_columns(spark, staging):
    from beaconmill.plans.loads import checks

    counted = staging.agg(F.count(F.lit(1)), *checks().values())
    assert "ReadSchema: struct<user_id:string,timestamp:string>" in plan(counted)


def test_close_out_cuts_keys_before_the_shuffle(staging):
    text = plan(ops.close_out(staging.withColumn("is_current", F.lit(True))))
    limits = text[text.index("WindowGroupLimit"):]
    assert "Partial" in limits[limits.index("Exchange"):]


def test_both_joins_of_a_correlation_read_one_shuffle_of_the_impressions(staging):
    events = staging.withColumnRenamed("ad", "click_id")
    staging.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = ops.correlate(staging, events, "click_id")
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "ReusedExchange" in plan(joined)
    finally:
        staging.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_events_form_no_pairs(staging):
    from datetime import timedelta

    events = staging.withColumnRenamed("ad", "click_id")
    text = plan(ops.attribute_first(ops.convert_types(staging), ops.convert_types(events), "click_id", timedelta(hours=1)))
    assert "Window" in text and "Inner" not in text
