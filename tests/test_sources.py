import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.types import StructType

from beaconmill import plans, schemas
from beaconmill.sources import (
    SourceSpec,
    read_avro_strings,
    read_csv_strings,
    read_json_strings,
    read_source,
    source_spec,
    split_malformed,
)
from tests.samples import BIDS, IMPRESSIONS, INTERACTIONS, write_samples


@pytest.fixture
def samples(tmp_path):
    write_samples(str(tmp_path))
    return str(tmp_path)


def test_registry_ignores_case_and_rejects_unknown_names():
    assert source_spec("AD_Impressions", "/in").path == "/in/ad_impressions.json"
    assert source_spec("clicks_and_conversions", "/in").format == "csv"
    assert source_spec("bid_requests", "/in").format == "avro"
    assert source_spec("bid_requests", "/in", path="b.json", format="json").path == "/in/b.json"
    with pytest.raises(ValueError, match="Invalid source type"):
        source_spec("bids", "/in")


def test_json_array_is_read_with_multi_line(spark, samples):
    spec = source_spec("ad_impressions", samples, options={"multiLine": True})
    df = read_source(spark, spec)
    assert df.columns == ["ad_creative_id", "user_id", "timestamp", "website"]
    assert sorted(map(tuple, df.collect())) == sorted(IMPRESSIONS)


def test_json_schema_is_inferred_where_none_is_given(spark, samples):
    spec = SourceSpec("x", "json", f"{samples}/bid_requests.json", options={"multiLine": True})
    types = dict(read_source(spark, spec).select("user_info.*", "auction_details.*").dtypes)
    assert types["age"] == "bigint" and types["bid_amount"] == "double"


def test_json_array_without_multi_line_is_rejected(spark, samples):
    with pytest.raises(ValueError, match="JSON array"):
        read_source(spark, source_spec("ad_impressions", samples))


@pytest.mark.parametrize(
    "text", ['{\n "a": 1\n}\n{\n "a": 2\n}\n', '[{"a": 1}]\n[{"a": 2}]\n', '{"a": 1},\n{"a": 2}', '[{"a": 1}', "x"]
)
def test_multi_line_files_of_more_than_one_value_are_rejected(spark, tmp_path, text):
    (tmp_path / "1.json").write_text('[{"a": 1}]')
    (tmp_path / "2.json").write_text(text)
    with pytest.raises(ValueError, match="2.json is not one"):
        read_source(spark, SourceSpec("x", "json", str(tmp_path), options={"multiLine": True}))


@pytest.mark.parametrize(("first", "second"), [("a,b,a", "b,a,a"), ("a,,", ",a,"), ("a,a", "a,b")])
def test_headers_that_repeat_or_lack_names_must_agree(spark, tmp_path, first, second):
    width = first.count(",")
    (tmp_path / "1.csv").write_text(first + "\n" + "1" + ",2" * width + "\n")
    spec = SourceSpec("x", "csv", str(tmp_path), options={"header": True})
    assert read_source(spark, spec).count() == 1
    (tmp_path / "2.csv").write_text(first + "\r\n" + "3" + ",4" * width + "\r\n")
    assert read_source(spark, spec).count() == 2
    (tmp_path / "3.csv").write_text(second + "\n" + "5" + ",6" * width + "\n")
    with pytest.raises(ValueError, match="another header"):
        read_source(spark, spec)


def test_json_lines_with_multi_line_are_rejected(spark, tmp_path):
    (tmp_path / "lines.json").write_text('\n{"a": 1}\n\n{"a": 2}\n')
    path = str(tmp_path / "lines.json")
    with pytest.raises(ValueError, match="not one JSON object or array"):
        read_source(spark, SourceSpec("x", "json", path, options={"multiLine": True}))
    assert read_source(spark, SourceSpec("x", "json", path)).count() == 2


def test_every_file_of_a_multi_line_source_is_looked_at(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.json").write_text('[\n{"a": 1},\n{"a": 2}\n]\n')
    spec = SourceSpec("x", "json", str(tmp_path), options={"multiLine": True})
    assert read_source(spark, spec).count() == 10
    (tmp_path / "5.json").write_text('{"a": 1}\n{"a": \n{"a": 3}\n')
    with pytest.raises(ValueError, match="5.json is not one JSON object or array"):
        read_source(spark, spec)


def test_a_json_array_among_lines_is_counted_as_malformed(spark, tmp_path):
    row = '{"ad_creative_id": "A", "user_id": "u", "timestamp": "2024-05-05T12:00:00Z", "website": "w"}'
    folder = tmp_path / "ad_impressions.json"
    folder.mkdir()
    (folder / "1.json").write_text(f"{row}\n" * 5)
    (folder / "2.json").write_text(f"[\n{row[:-1]}\n}}\n]\n")
    for changes in ({}, {"schema": None}):
        layers = plans.Layers(str(tmp_path / f"layers{len(changes)}"))
        plans.snapshot(spark, [source_spec("ad_impressions", str(tmp_path), **changes)], layers)
        assert [r.record_count for r in plans.read_audit(spark, layers.audit).collect()] == [4]


def test_many_files_of_one_object_each_may_be_multi_line(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(f'{{"a": {i}}}')
    spec = SourceSpec("x", "json", str(tmp_path), options={"multiLine": True})
    assert read_source(spark, spec).count() == 3


def test_csv_columns_are_strings_named_by_the_header(spark, samples):
    spec = source_spec("clicks_and_conversions", samples, path="clicks_conversions.csv")
    df = read_source(spark, spec)
    assert df.columns == ["Event Timestamp", "User ID", "Ad Campaign ID", "Conversion Type"]
    assert {t for _, t in df.dtypes} == {"string"}
    assert sorted(map(tuple, df.collect())) == INTERACTIONS


def test_csv_columns_may_stand_in_any_order_but_the_same_in_all_files(spark, tmp_path):
    folder = tmp_path / "c.csv"
    folder.mkdir()
    spec = source_spec("clicks_and_conversions", str(tmp_path), path="c.csv")
    (folder / "1.csv").write_text("User ID,Event Timestamp,Extra\nu,t,x\n")
    assert read_source(spark, spec).select("Event Timestamp", "User ID", "Extra").collect() == [("t", "u", "x")]
    (folder / "2.csv").write_text("Event Timestamp,User ID,Extra\nt,u,x\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_source(spark, spec).collect()


def test_csv_names_that_spark_has_to_invent(spark, tmp_path):
    (tmp_path / "c.csv").write_text("a,a,\n1,2,3\n")
    spec = SourceSpec("x", "csv", str(tmp_path / "c.csv"), options={"header": True})
    df = read_source(spark, spec)
    assert (df.columns, df.collect()) == (["a0", "a1", "_c2"], [("1", "2", "3")])


def test_csv_strings_without_header(spark, tmp_path):
    (tmp_path / "c.csv").write_text("1,b\n2,c\n")
    df = read_csv_strings(spark, str(tmp_path / "c.csv"), header=False)
    assert df.columns == ["_c0", "_c1"]
    assert sorted(map(tuple, df.collect())) == [("1", "b"), ("2", "c")]


def test_json_strings_with_a_schema_file(spark, samples, tmp_path):
    schema_file = tmp_path / "schema.json"
    schema_file.write_text(json.dumps(json.loads(StructType.fromDDL(schemas.BID_REQUESTS).json())))
    df = read_json_strings(
        spark, f"{samples}/bid_requests.json", schema_file=str(schema_file), multi_line=True
    )
    assert {t for _, t in df.dtypes} == {"string"}
    got = {r.auction_id: (r.user_id, r.age, r.bid_amount, r.keywords) for r in df.collect()}
    assert got["auction101"] == ("user456", "25", "0.8", "[fitness, lifestyle]")
    assert set(got) == {bid[3] for bid in BIDS}


def test_avro(spark, tmp_path):
    bids = spark.createDataFrame([(("u", "NY", 3),)], "user_info struct<user_id:string,location:string,age:int>")
    try:
        bids.write.format("avro").save(str(tmp_path / "bids.avro"))
    except AnalysisException as error:
        pytest.skip(f"needs --packages org.apache.spark:spark-avro_2.13: {error.getCondition()}")
    df = read_avro_strings(spark, str(tmp_path / "bids.avro"))
    assert df.collect() == [("u", "NY", "3")]
    assert read_source(spark, SourceSpec("bids", "avro", str(tmp_path / "bids.avro"))).count() == 1


def test_malformed_json_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1, "b": "x"}\n{"a": \n{"a": "no int", "b": "y"}\n')
    spec = SourceSpec("x", "json", str(tmp_path / "a.json"), "a int, b string")
    good, bad = split_malformed(read_source(spark, spec, keep_malformed=True))
    assert good.collect() == [(1, "x")]
    assert {r[schemas.MALFORMED] for r in bad.collect()} == {'{"a": ', '{"a": "no int", "b": "y"}'}


def test_malformed_csv_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n1\n1,2,3\n")
    spec = SourceSpec("x", "csv", str(tmp_path / "a.csv"), "a string, b string", {"header": True})
    good, bad = split_malformed(read_source(spark, spec, keep_malformed=True))
    assert good.collect() == [("1", "2")]
    assert good.select("a").collect() == [("1",)]
    assert {r[schemas.MALFORMED] for r in bad.collect()} == {"1", "1,2,3"}


def test_snapshot_quarantines_and_staging_takes_what_is_readable(spark, tmp_path):
    row = '{"ad_creative_id": "A", "user_id": "u", "timestamp": "2024-05-05T12:00:00Z", "website": "w"}'
    (tmp_path / "ad_impressions.json").write_text(f"{row}\n{{broken\n")
    header = "Event Timestamp,User ID,Ad Campaign ID,Conversion Type"
    (tmp_path / "clicks_and_conversions.csv").write_text(f"{header}\n\"\"\nt1,u1,c1,signup\nt2,u2,c2\nt3,u3,c3,signup,x\n")
    layers = plans.Layers(str(tmp_path / "layers"))
    names = ("ad_impressions", "clicks_and_conversions")
    plans.snapshot(spark, [source_spec(name, str(tmp_path)) for name in names], layers)
    assert plans.read_layer(spark, layers.path("snapshot", "ad_impressions")).count() == 2
    plans.stage(spark, layers, "2024-05-06", ["ad_impressions", "clicks", "conversions"])
    staged = plans.read_layer(spark, layers.path("staging", "ad_impressions"))
    assert [r.ad_creative_id for r in staged.collect()] == ["A"]
    assert dict(staged.dtypes)["load_date"] == "timestamp"
    clicks = plans.read_layer(spark, layers.path("staging", "clicks"))
    assert sorted((r.user_id, r.conversion_type or "") for r in clicks.collect()) == [
        ("u1", "signup"), ("u2", ""), ("u3", "signup")]
    assert plans.read_layer(spark, layers.path("staging", "conversions")).count() == 2
    assert [r.raw for r in plans.malformed_rows(spark, layers, "ad_impressions").collect()] == ["{broken"]
    raw = plans.malformed_rows(spark, layers, "clicks_and_conversions").collect()
    assert sorted(r.raw for r in raw) == ['""', "t2,u2,c2", "t3,u3,c3,signup,x"]
    audit = plans.read_audit(spark, layers.audit).collect()
    assert {(r.operation, r.record_count) for r in audit} == {
        ("malformed_ad_impressions", 1), ("malformed_clicks_and_conversions", 3)}
