import os
from datetime import datetime, timezone

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from beaconmill import operators as ops
from beaconmill import plans, schemas
from beaconmill.__main__ import main
from beaconmill.sources import source_spec
from beaconmill.streaming import stream_load
from tests.samples import write_samples

LOAD_TS = "2024-06-01 00:00:00"
ARRAY = {"options": {"multiLine": True}}


def sample_specs(folder):
    return [
        source_spec("ad_impressions", folder, **ARRAY),
        source_spec("clicks_and_conversions", folder, path="clicks_conversions.csv"),
        source_spec("bid_requests", folder, format="json", path="bid_requests.json",
                    schema=schemas.BID_REQUESTS, **ARRAY),
    ]


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("samples")
    write_samples(str(folder))
    layers = plans.Layers(str(folder / "layers"))
    plans.run_all(spark, sample_specs(str(folder)), layers, LOAD_TS)
    return layers


def test_sample_impressions_through_the_full_load(spark, layers):
    df = plans.read_layer(spark, layers.path("ingestion", "ad_impressions"))
    assert dict(df.dtypes) == {
        "ad_creative_id": "string", "user_id": "string", "timestamp": "timestamp",
        "website": "string", "load_date": "timestamp", "is_current": "boolean",
    }
    got = df.collect()
    assert sorted(r.user_id for r in got) == ["USER123", "USER123", "USER456", "USER789", "USER789"]
    assert {r.website for r in got} == {"example.com"}
    assert {r.load_date for r in got} == {datetime(2024, 6, 1)} and all(r.is_current for r in got)
    assert min(r.timestamp for r in got) == datetime(2024, 5, 5, 12, 30, 45)


def test_sample_staging_is_strings_with_an_arrival(spark, layers):
    for dataset in ("ad_impressions", "clicks", "conversions", "bid_requests"):
        types = dict(plans.read_layer(spark, layers.path("staging", dataset)).dtypes)
        assert types.pop("load_date") == "timestamp"
        assert set(types.values()) == {"string"}
    bids = plans.read_layer(spark, layers.path("staging", "bid_requests"))
    first = bids.filter("auction_id = 'auction123'").first()
    assert (first.user_id, first.location, first.age, first.bid_amount) == ("user789", "New York", "28", "0.5")
    assert first.keywords == "[sports, technology]"


def test_sample_correlation_finds_no_equal_times(spark, layers):
    for name, id_column in (("clicks", "click_id"), ("conversions", "conversion_id")):
        df = plans.read_layer(spark, layers.path("analytical", f"ad_impressions_{name}"))
        assert df.count() == 5 and df.filter(F.col(id_column).isNotNull()).count() == 0
    assert plans.read_layer(spark, layers.path("ingestion", "conversions")).count() == 5


def test_sample_audit_has_every_step(spark, layers):
    df = plans.read_audit(spark, layers.audit)
    assert dict(df.dtypes) == {"operation": "string", "record_count": "bigint",
                               "operation_timestamp": "timestamp", "run": "string"}
    assert df.filter("operation = 'read_ingestion'").select("run").distinct().count() == 1
    got = df.groupBy("operation").agg(F.count("*"), F.sum("record_count")).collect()
    assert {tuple(r) for r in got} == {
        ("read_staging", 4, 20), ("filter_data", 4, 20), ("invalid_timestamp", 4, 0), ("deduplicate_data", 4, 20),
        ("malformed_ad_impressions", 1, 0), ("malformed_clicks_and_conversions", 1, 0), ("malformed_bid_requests", 1, 0),
        ("read_ingestion", 3, 15),
    }
    assert df.filter("operation_timestamp is null").count() == 0


def test_bucketed_layers_join_without_a_shuffle(spark, tmp_path):
    write_samples(str(tmp_path))
    spark.sql("create database if not exists ads")
    layers = plans.Layers(str(tmp_path / "layers"), buckets=4, database="ads")
    plans.run_all(spark, sample_specs(str(tmp_path)), layers, LOAD_TS)
    plans.stage(spark, layers, "2024-06-02", mode="append")
    plans.load_all(spark, layers, "2024-06-03", "2024-06-01", datasets=["ad_impressions", "clicks"])
    plans.correlate_layers(spark, layers)
    result = plans.read_layer(spark, layers.path("analytical", "ad_impressions_clicks"))
    assert result.count() == 5  # the second load's versions take the place of the first's
    assert plans.read_layer(spark, layers.path("ingestion", "clicks")).count() == 10
    clicks = plans.read_layer(spark, "", layers.bucketed("clicks"))
    impressions = plans.read_layer(spark, "", layers.bucketed("ad_impressions"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = ops.correlate(impressions, clicks, "click_id", one_per_key=True)
    text = joined._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in text and "Exchange" not in text


# ------------------------------------------------------------ staging


def test_arrivals_are_directories_that_a_load_prunes_in_any_time_zone(spark, tmp_path):
    write_samples(str(tmp_path))
    layers = plans.Layers(str(tmp_path / "layers"))
    plans.snapshot(spark, sample_specs(str(tmp_path))[:1], layers)
    for arrived in ("2024-05-05 23:30:00", "2024-05-06 00:30:00.000001", "2024-05-07"):
        plans.stage(spark, layers, arrived, ["ad_impressions"], mode="append")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        staging = plans.read_layer(spark, layers.path("staging", "ad_impressions"))
        assert dict(staging.dtypes)["load_date"] == "timestamp"
        newer = ops.newer_than(staging, "2024-05-06 00:30:00.000000+00:00")
        assert newer.count() == 10
        text = newer._jdf.queryExecution().executedPlan().toString()
        assert "timestamp_micros(arrival_micros" in text.split("PartitionFilters: [")[1].split("]")[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    plans.stage(spark, layers, "2024-05-08", ["ad_impressions"])
    assert plans.read_layer(spark, layers.path("staging", "ad_impressions")).count() == 5


# ------------------------------------------------------------ loads


STAGED_ROWS = [
    ("u1", "2024-05-05T12:00:00Z", "a", "2024-05-04"),
    ("U1", "2024-05-05T12:00:00Z", "b", "2024-05-05"),
    ("u2", "soon", "c", "2024-05-05"),
    ("u2", "later", "d", "2024-05-06"),
    (None, "2024-05-05T12:00:00Z", "e", "2024-05-06"),
    (None, "no time", "f", "2024-05-06"),
    ("u3", "2024-05-05T12:00:01Z", "g", "2024-05-06"),
]


@pytest.fixture
def paths(spark, tmp_path):
    stage_rows(spark, str(tmp_path / "staging"), STAGED_ROWS)
    return [str(tmp_path / name) for name in ("staging", "ingestion", "audit")]


def stage_rows(spark, path, given):
    df = spark.createDataFrame(given, "user_id string, timestamp string, ad string, load_date string")
    plans.append(df.withColumn("load_date", F.col("load_date").cast("timestamp")), path)


def loaded(spark, paths):
    rows = plans.read_layer(spark, paths[1]).select("user_id", "timestamp", "ad", "load_date", "is_current").collect()
    return sorted(map(tuple, rows), key=repr)


def test_full_load_cleans_and_audits(spark, paths):
    counts = plans.full_load(spark, *paths, LOAD_TS)
    assert counts == {"read_staging": 7, "filter_data": 5, "invalid_timestamp": 2, "deduplicate_data": 3}
    noon, loaded_at = datetime(2024, 5, 5, 12), datetime(2024, 6, 1)
    assert loaded(spark, paths) == [
        ("U1", noon, "a", loaded_at, True),
        ("U2", None, "c", loaded_at, True),
        ("U3", datetime(2024, 5, 5, 12, 0, 1), "g", loaded_at, True),
    ]
    audit = plans.read_audit(spark, paths[2])
    assert {(r.operation, r.record_count) for r in audit.collect()} == set(counts.items())


def test_full_load_twice_gives_the_same_and_appends_to_the_audit(spark, paths):
    plans.full_load(spark, *paths, LOAD_TS)
    once = loaded(spark, paths)
    plans.full_load(spark, *paths, LOAD_TS)
    assert loaded(spark, paths) == once
    assert plans.read_audit(spark, paths[2]).count() == 8


def test_full_load_may_order_the_copies(spark, paths):
    plans.full_load(spark, *paths, LOAD_TS, order_by=[F.desc("load_date"), F.asc("ad")])
    assert [row[2] for row in loaded(spark, paths)] == ["b", "d", "g"]


def test_full_load_refuses_to_overwrite_its_input(spark, paths):
    with pytest.raises(ValueError, match="while reading"):
        plans.full_load(spark, paths[0], paths[0] + "/", paths[2], LOAD_TS)
    assert plans.read_layer(spark, paths[0]).count() == 7


def test_incremental_load_takes_rows_after_the_mark_before_it_deduplicates(spark, paths):
    counts = plans.incremental_load(spark, *paths, "2024-05-04", LOAD_TS)
    assert counts == {"read_staging": 7, "filter_incremental": 6, "filter_data": 4,
                      "invalid_timestamp": 2, "deduplicate_data": 3}
    assert [row[2] for row in loaded(spark, paths)] == ["b", "c", "g"]


def test_incremental_load_without_news_writes_nothing(spark, paths):
    counts = plans.incremental_load(spark, *paths, "2024-05-06", LOAD_TS)
    assert counts["filter_incremental"] == 0 and counts["deduplicate_data"] == 0
    assert not os.path.exists(paths[1])
    assert plans.read_audit(spark, paths[2]).count() == 5


def test_incremental_load_appends_or_skips_what_is_loaded(spark, paths):
    plans.full_load(spark, *paths, LOAD_TS)
    plans.incremental_load(spark, *paths, "2024-05-05", LOAD_TS, skip_loaded=True)
    assert len(loaded(spark, paths)) == 3
    stage_rows(spark, paths[0], [("u4", "2024-05-07T00:00:00Z", "h", "2024-05-07"),
                                 ("u2", "never", "i", "2024-05-07")])
    for _ in range(2):
        plans.incremental_load(spark, *paths, "2024-05-06", "2024-06-02", skip_loaded=True)
        assert [row[2] for row in loaded(spark, paths)] == ["a", "c", "g", "h"]
    plans.incremental_load(spark, *paths, "2024-05-06", "2024-06-03")
    assert len(loaded(spark, paths)) == 6


def test_loaded_times_have_statistics_and_bound_the_search(spark, paths):
    plans.full_load(spark, *paths, LOAD_TS)
    files = [f for f in os.listdir(paths[1]) if f.endswith(".parquet")]
    groups = [pq.ParquetFile(os.path.join(paths[1], f)).metadata.row_group(0) for f in files]
    for group in groups:
        column = next(c for c in map(group.column, range(group.num_columns)) if c.path_in_schema == "timestamp")
        assert column.physical_type == "INT64" and column.is_stats_set
    target = plans.read_layer(spark, paths[1])
    noon = int(datetime(2024, 5, 5, 12, tzinfo=timezone.utc).timestamp()) * 1_000_000
    near = ops.within_span(target, noon, noon)
    assert sorted(r.ad for r in near.collect()) == ["a", "c"]
    assert "Or(IsNull(timestamp),And(GreaterThanOrEqual(timestamp" in near._jdf.queryExecution().toString()
    assert [r.ad for r in ops.within_span(target, None, None).collect()] == ["c"]


def test_loads_of_nothing_end_and_count_nothing(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("staging", "ingestion", "audit")]
    stage_rows(spark, paths[0], [(None, "2024-05-05T12:00:00Z", "a", "2024-05-04")])
    assert plans.full_load(spark, *paths, LOAD_TS)["deduplicate_data"] == 0
    assert plans.incremental_load(spark, *paths, "2024-05-03", LOAD_TS)["deduplicate_data"] == 0
    stream_load(spark, *paths, str(tmp_path / "checkpoint"), LOAD_TS)
    assert loaded(spark, paths) == []
    empty = str(tmp_path / "empty")
    spark.range(0).selectExpr("'u' as user_id", "'t' as timestamp", "'a' as ad").write.parquet(empty)
    counts = plans.full_load(spark, empty, str(tmp_path / "out"), paths[2], LOAD_TS)
    assert set(counts.values()) == {0}
    assert plans.read_layer(spark, str(tmp_path / "out")).count() == 0


def test_a_day_without_events_goes_through_all_layers(spark, tmp_path):
    write_samples(str(tmp_path))
    (tmp_path / "none.csv").write_text("Event Timestamp,User ID,Ad Campaign ID,Conversion Type\n")
    specs = [sample_specs(str(tmp_path))[0],
             source_spec("clicks_and_conversions", str(tmp_path), path="none.csv")]
    layers = plans.Layers(str(tmp_path / "layers"))
    plans.run_all(spark, specs, layers, LOAD_TS)
    for name in ("clicks", "conversions"):
        assert plans.read_layer(spark, layers.path("ingestion", name)).count() == 0
        assert plans.read_layer(spark, layers.path("analytical", f"ad_impressions_{name}")).count() == 5


def test_versions_are_closed_into_another_path(spark, paths, tmp_path):
    plans.full_load(spark, *paths, LOAD_TS)
    plans.incremental_load(spark, *paths, "2024-05-05", "2024-06-02")
    closed = str(tmp_path / "closed")
    plans.close_versions(spark, paths[1], closed)
    got = plans.read_layer(spark, closed)
    assert got.count() == 5
    assert sorted((r.user_id, r.load_date.month, r.load_date.day) for r in got.filter("is_current").collect()) == [
        ("U1", 6, 1), ("U2", 6, 2), ("U3", 6, 2)]


def test_stream_loads_each_file_once(spark, paths, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    stream_load(spark, *paths, checkpoint, LOAD_TS)
    assert len(loaded(spark, paths)) == 3
    stream_load(spark, *paths, checkpoint, "2024-06-02")
    assert len(loaded(spark, paths)) == 3
    stage_rows(spark, paths[0], [("u4", "2024-05-07T00:00:00Z", "h", "2024-05-07"),
                                 ("u1", "2024-05-05T12:00:00Z", "again", "2024-05-07")])
    stream_load(spark, *paths, checkpoint, "2024-06-03")
    assert [row[0] for row in loaded(spark, paths)] == ["U1", "U2", "U3", "U4"]
    audit = plans.read_audit(spark, paths[2]).filter("operation = 'stream_load'")
    assert sorted(r.record_count for r in audit.collect()) == [1, 3]


def test_stream_and_loads_read_staging_by_arrival(spark, tmp_path):
    write_samples(str(tmp_path))
    layers = plans.Layers(str(tmp_path / "layers"))
    plans.snapshot(spark, sample_specs(str(tmp_path))[:1], layers)
    paths = [layers.path("staging", "ad_impressions"), layers.path("ingestion", "ad_impressions"), layers.audit]
    for arrived, total in (("2024-05-05 23:30:00", 5), ("2024-05-06 00:30:00.000001", 5)):
        plans.stage(spark, layers, arrived, ["ad_impressions"], mode="append")
        stream_load(spark, *paths, str(tmp_path / "checkpoint"), LOAD_TS)
        assert plans.read_layer(spark, paths[1]).count() == total
    counts = plans.incremental_load(spark, *paths, "2024-05-06 00:30:00", "2024-06-02", skip_loaded=True)
    assert (counts["read_staging"], counts["filter_incremental"], counts["deduplicate_data"]) == (10, 5, 0)


def test_a_stream_that_lost_its_checkpoint_adds_nothing(spark, paths, tmp_path):
    stream_load(spark, *paths, str(tmp_path / "one"), LOAD_TS)
    before = loaded(spark, paths)
    stream_load(spark, *paths, str(tmp_path / "two"), "2024-06-02")
    assert loaded(spark, paths) == before


# ------------------------------------------------------------ jobs


def test_jobs_from_the_command_line(spark, tmp_path):
    write_samples(str(tmp_path))
    root = str(tmp_path / "layers")
    sources = ["--source", "ad_impressions", "--source", "clicks_and_conversions=csv:clicks_conversions.csv",
               "--source", "bid_requests=json:bid_requests.json", "--multi-line"]
    main(["snapshot", "--root", root, "--input", str(tmp_path), *sources])
    main(["stage", "--root", root, "--load-date", "2024-05-05 13:00:00"])
    main(["full-load", "--root", root, "--load-date", LOAD_TS])
    main(["incremental-load", "--root", root, "--last-load-date", "2024-05-05", "--skip-loaded"])
    main(["stream-load", "--root", root, "--dataset", "clicks"])
    main(["close-versions", "--root", root, "--dataset", "clicks"])
    main(["correlate", "--root", root])
    layers = plans.Layers(root)
    assert plans.read_layer(spark, layers.path("analytical", "ad_impressions_clicks")).count() == 5
    assert plans.read_layer(spark, layers.path("ingestion", "clicks")).filter("is_current").count() == 5
    # nothing has arrived after the newest arrival loaded; the first update is a whole run
    main(["incremental-load", "--root", root])
    assert len(plans.listed(spark, layers.path("ingestion", "clicks")).loads) == 1
    main(["update-analytical", "--root", root])
    assert plans.read_layer(spark, layers.path("analytical", "ad_impressions_clicks")).count() == 5


def test_jobs_fail_loudly(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        main(["full-load", "--root", str(tmp_path)])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        main(["incremental-load", "--root", str(tmp_path)])
    with pytest.raises(SystemExit):
        main(["snapshot", "--root", str(tmp_path)])


def test_writes_side_by_side_keep_their_statistics(spark, tmp_path):
    from beaconmill.plans.layers import at_once

    df = spark.range(1000).selectExpr("id", "timestamp_seconds(id) as timestamp")
    paths = [str(tmp_path / str(i)) for i in range(6)]
    at_once(lambda p=path: plans.overwrite(df, p) for path in paths)
    for path in paths:
        files = [f for f in os.listdir(path) if f.endswith(".parquet")]
        groups = [pq.ParquetFile(os.path.join(path, f)).metadata.row_group(0) for f in files]
        assert all(g.column(1).statistics.has_min_max for g in groups)


def test_a_failing_job_is_raised_after_the_others_ended():
    from beaconmill.plans.layers import at_once

    done = []
    with pytest.raises(ZeroDivisionError):
        at_once([lambda: 1 / 0, lambda: done.append(1)])
    assert done == [1]
