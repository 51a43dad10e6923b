"""Arrivals whose columns change, and audits that prove nothing was lost."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from beaconmill import plans
from beaconmill.plans.layers import ARRIVAL
from tests.samples import write_samples
from tests.test_plans import LOAD_TS, sample_specs


def schema(ddl):
    return StructType.fromDDL(ddl)


def test_types_are_as_wide_as_needed(spark):
    found = plans.merged([schema("a int, b float, c decimal(5,2), d date, s struct<x:int>"), schema("A bigint, b double, c decimal(6,0), d timestamp_ntz, s struct<x:bigint,y:string>, e string")])
    assert found == schema("a bigint, b double, c decimal(8,2), d timestamp_ntz, s struct<x:bigint,y:string>, e string")
    assert plans.merged([]) == StructType([])
    for one, other in (("a int", "a string"), ("a bigint", "a double"), ("a decimal(38,0)", "a decimal(38,10)"), ("a array<int>", "a array<string>")):
        with pytest.raises(ValueError, match="column a is"):
            plans.merged([schema(one), schema(other)])


def test_arrivals_stay_whole_when_columns_change(spark, tmp_path):
    path = str(tmp_path / "staging")
    rows = spark.createDataFrame([("u1", "t1", "x"), ("u2", "t2", None)], "user_id string, timestamp string, old string")
    plans.save_arrivals(rows, path, "2024-05-01", "overwrite")
    plans.save_arrivals(rows.withColumnRenamed("old", "new"), path, "2024-05-02", "append")
    plans.save_arrivals(rows.limit(0).withColumn("third", F.lit("")), path, "2024-05-03", "append")
    df = plans.read_layer(spark, path)
    assert df.columns == ["user_id", "timestamp", "old", "new", "third", "load_date"]
    got = {(r.user_id, r.old, r.new, r.load_date.day) for r in df.collect()}
    assert got == {("u1", None, "x", 2), ("u1", "x", None, 1), ("u2", None, None, 1), ("u2", None, None, 2)}
    # a filter on the arrival still chooses directories
    assert "PartitionFilters: []" not in df.filter("load_date > '2024-05-01 12:00:00'")._jdf.queryExecution().toString()
    plans.save_arrivals(rows, path, "2024-05-04", "overwrite")
    assert plans.read_layer(spark, path).columns == ["user_id", "timestamp", "old", "load_date"]


def test_arrivals_from_before_the_history_count(spark, tmp_path):
    path = str(tmp_path / "staging")
    rows = spark.createDataFrame([("u1", "t1", "x")], "user_id string, timestamp string, old string")
    rows.withColumn(ARRIVAL, F.lit(1_000_000)).write.partitionBy(ARRIVAL).parquet(path)
    plans.save_arrivals(rows.withColumnRenamed("old", "new"), path, "2024-05-02", "append")
    assert sorted((r.old, r.new) for r in plans.read_layer(spark, path).select("old", "new").na.fill("").collect()) == [("", "x"), ("x", "")]


def test_loads_take_columns_that_came_later(spark, tmp_path):
    staging, out, audit = (str(tmp_path / n) for n in ("staging", "out", "audit"))
    rows = spark.createDataFrame([("u1", "2024-05-01 10:00:00")], "user_id string, timestamp string")
    plans.save_arrivals(rows, staging, "2024-05-01", "overwrite")
    plans.incremental_load(spark, staging, out, audit, None, "2024-05-01")
    plans.save_arrivals(rows.withColumns({"user_id": F.lit("u2"), "extra": F.lit("e")}), staging, "2024-05-02", "append")
    plans.incremental_load(spark, staging, out, audit, None, "2024-05-02")
    got = {r.user_id: r.extra for r in plans.read_layer(spark, out).collect()}
    assert got == {"U1": None, "U2": "e"}


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("samples")
    write_samples(str(folder))
    layers = plans.Layers(str(folder / "layers"))
    plans.run_all(spark, sample_specs(str(folder)), layers, LOAD_TS)
    return layers


def steps(df):
    return {(r.dataset, r.step): r.agrees for r in df.collect()}


def test_layers_of_a_whole_run_agree(spark, layers):
    found = plans.reconcile(spark, layers)
    assert len(steps(found)) == 10 and all(steps(found).values())
    row = found.filter("dataset = 'clicks' and step = 'load'").first()
    assert (row.expected_rows, row.found_rows, row.expected_keys, row.found_keys) == (5, 5, 5, 5)
    assert plans.read_reconciled(spark, layers).select("run").distinct().count() == 1
    assert plans.read_audit(spark, layers.audit).filter("operation is null").count() == 0


def test_one_row_removed_is_found(spark, layers, tmp_path):
    loaded = layers.path("ingestion", "clicks")
    plans.replace_dataset(plans.read_layer(spark, loaded).filter("ad_campaign_id <> 'CampaignABC' or conversion_type = 'signup'"), loaded)
    table = layers.path("analytical", "ad_impressions_conversions")
    plans.overwrite(plans.read_layer(spark, table).withColumn("website", F.when(F.col("user_id") == "USER456", "other").otherwise(F.col("website"))), str(tmp_path / "t"))
    plans.overwrite(plans.read_layer(spark, str(tmp_path / "t")), table)
    wrong = {step for step, agrees in steps(plans.reconcile(spark, layers)).items() if not agrees}
    assert wrong == {("clicks", "load"), ("ad_impressions_conversions", "correlate")}


def test_fingerprints_do_not_depend_on_order_but_on_copies(spark):
    rows = [(1, None, "a"), (None, 1, "a"), (2, 2, None), (2, 2, None)]
    df = spark.createDataFrame(rows, "x int, y int, z string")
    of = lambda d: tuple(plans.fingerprint(d, ["x"]).drop("keys").first())
    assert of(df) == of(spark.createDataFrame(rows[::-1], df.schema).repartition(3).select("z", "y", "x"))
    assert of(df) != of(df.distinct()) and of(df) != of(df.selectExpr("y as x", "x as y", "z").filter("z = 'a' or x = 2").limit(3))
    assert of(df.filter("z = 'a'").limit(1)) != of(df.filter("z = 'a' and y = 1"))
    assert of(df.limit(0)) == (0, 0, 0)
