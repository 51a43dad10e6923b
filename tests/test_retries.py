"""Tasks fail and run again; results and audit counts stay the same."""

import pytest
from pyspark import TaskContext

from beaconmill import operators as ops
from beaconmill import plans

LOAD_TS = "2024-06-01"


def flaky(df):
    """The same rows, from tasks that give some and then fail in their first attempt."""

    def rows(batches):
        for batch in batches:
            yield batch
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("lost")

    return df.mapInArrow(rows, df.schema)


@pytest.fixture
def staging(spark):
    return spark.range(0, 3000, 1, 6).selectExpr(
        "concat('u', id % 50) as user_id", "cast(timestamp_seconds(id % 40) as string) as timestamp",
        "cast(id as string) as ad",
    )


def test_a_load_survives_tasks_that_fail_before_and_after_the_shuffle(spark, staging, tmp_path):
    want = sorted(map(tuple, plans.full_load_frame(staging, LOAD_TS).collect()))
    rows, written = plans.counted(flaky(plans.full_load_frame(flaky(staging), LOAD_TS)))
    plans.overwrite(rows, str(tmp_path / "out"))
    assert sorted(map(tuple, plans.read_layer(spark, str(tmp_path / "out")).collect())) == want
    assert written() == len(want) == 200


def test_hot_keys_survive_tasks_that_fail(spark, staging):
    impressions = ops.convert_types(staging.filter("ad < '2'"))
    events = ops.convert_types(staging.withColumnRenamed("ad", "click_id"))
    want = ops.correlate(impressions, events, "click_id").collect()
    got = ops.correlate(flaky(impressions), flaky(events), "click_id").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
