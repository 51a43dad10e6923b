"""Validity intervals and joins by point in time, and schema documents."""

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from beaconmill import operators as ops
from beaconmill.avsc import compile_avsc
from beaconmill.schemas import schema_from_file

VERSIONS = [("u1", "2024-01-01", "a"), ("u1", "2024-01-01", "a2"), ("u1", "2024-03-01 10:00:00", "b"), ("u1", "2024-03-01 11:00:00", "c"), ("u2", "2024-02-01", "d"), (None, "2024-02-01", "n"), ("u3", None, "never")]
FACTS = [(1, "u1", "2023-12-31"), (2, "u1", "2024-01-01"), (3, "u1", "2024-02-10"), (4, "u1", "2024-03-01 10:30:00"), (5, "u1", "2024-03-01 11:00:00"), (6, "u1", "2025-01-01"), (7, "u2", "2024-01-31 23:59:59.999999"), (8, "u2", "2024-02-01"), (9, None, "2024-03-01"), (10, "u2", None), (11, "u3", "2024-03-01"), (12, "u9", "2024-03-01")]


def frames(spark):
    versions = spark.createDataFrame(VERSIONS, "user_id string, load_date string, v string").withColumn("load_date", F.col("load_date").cast("timestamp"))
    facts = spark.createDataFrame(FACTS, "id int, user_id string, at string").withColumn("at", F.col("at").cast("timestamp"))
    return versions.withColumns({c: F.lit("x") for c in ("_part", "_own")}), facts.withColumns({c: F.lit("y") for c in ("_at", "_from")})


def test_intervals_end_where_the_next_begins(spark):
    versions, _ = frames(spark)
    out = ops.validity(versions, ["user_id"])
    assert out.columns == [*versions.columns, "valid_from", "valid_to"]
    got = {r.v: (r.valid_from and str(r.valid_from), r.valid_to and str(r.valid_to), r._own) for r in out.collect()}
    assert got == {
        "a": ("2024-01-01 00:00:00", "2024-03-01 10:00:00", "x"), "a2": ("2024-01-01 00:00:00", "2024-03-01 10:00:00", "x"),
        "b": ("2024-03-01 10:00:00", "2024-03-01 11:00:00", "x"), "c": ("2024-03-01 11:00:00", None, "x"),
        "d": ("2024-02-01 00:00:00", None, "x"), "n": ("2024-02-01 00:00:00", None, "x"), "never": (None, None, "x"),
    }


@pytest.mark.parametrize("bucket", [timedelta(hours=1), timedelta(days=1), timedelta(days=400)])
def test_facts_meet_the_versions_of_their_time(spark, bucket):
    versions, facts = frames(spark)
    out = ops.as_of(facts, ops.validity(versions, ["user_id"], bucket=bucket), ["user_id"], "at", ["v"], bucket=bucket)
    assert out.columns == [*facts.columns, "v"]
    assert sorted((r.id, r.v or "") for r in out.collect()) == [
        (1, ""), (2, "a"), (2, "a2"), (3, "a"), (3, "a2"), (4, "b"), (5, "c"), (6, "c"), (7, ""), (8, "d"), (9, ""), (10, ""), (11, ""), (12, "")
    ]
    with pytest.raises(ValueError):
        ops.as_of(facts, versions, ["user_id"], "at", ["id"])


def test_no_facts_and_no_versions(spark):
    versions, facts = frames(spark)
    known = ops.validity(versions, ["user_id"])
    assert ops.as_of(facts.limit(0), known, ["user_id"], "at", ["v"]).count() == 0
    assert ops.as_of(facts, known.limit(0), ["user_id"], "at", ["v"]).filter("v is null").count() == len(FACTS)


# ------------------------------------------------------------ Avro schema documents

BIDS = {
    "type": "record", "name": "bid", "namespace": "com.ads",
    "fields": [
        {"name": "user", "type": {"type": "record", "name": "User", "fields": [
            {"name": "id", "type": "string", "doc": "who"}, {"name": "age", "type": ["null", "int"], "default": None}]}},
        {"name": "other", "type": ["null", "User"]},
        {"name": "money", "type": {"type": "bytes", "logicalType": "decimal", "precision": 10, "scale": 2}},
        {"name": "at", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "day", "type": {"type": "int", "logicalType": "date"}},
        {"name": "tags", "type": {"type": "array", "items": ["string", "null"]}},
        {"name": "more", "type": {"type": "map", "values": {"type": "array", "items": "long"}}},
        {"name": "device", "type": {"type": "enum", "name": "Device", "symbols": ["mobile"]}},
        {"name": "again", "type": "com.ads.Device"},
        {"name": "number", "type": ["int", "null", "long"]},
        {"name": "either", "type": ["int", "string"]},
        {"name": "odd", "type": {"type": "string", "logicalType": "unheard-of"}},
        {"name": "hash", "type": {"type": "fixed", "name": "Hash", "size": 16}},
        {"name": "defaulted", "type": "boolean", "default": False},
    ],
}


def test_documents_become_schemas():
    found = compile_avsc(json.dumps(BIDS))
    assert found.simpleString() == (
        "struct<user:struct<id:string,age:int>,other:struct<id:string,age:int>,money:decimal(10,2),at:timestamp,day:date,"
        "tags:array<string>,more:map<string,array<bigint>>,device:string,again:string,number:bigint,"
        "either:struct<member0:int,member1:string>,odd:string,hash:binary,defaulted:boolean>"
    )
    nullable = {f.name: f.nullable for f in found.fields}
    assert not nullable["user"] and nullable["other"] and nullable["number"] and nullable["defaulted"]
    assert found["tags"].dataType.containsNull and not found["more"].dataType.valueType.containsNull
    assert found["user"].dataType["id"].metadata == {"comment": "who"}


@pytest.mark.parametrize("document, message", [
    ('"string"', "not a record"),
    ({"type": "record", "name": "n", "fields": [{"name": "next", "type": ["null", "n"]}]}, "holds itself"),
    ({"type": "record", "name": "n", "fields": [{"name": "x", "type": "later"}]}, "not defined"),
])
def test_documents_without_a_schema_are_errors(document, message):
    with pytest.raises(ValueError, match=message):
        compile_avsc(document)


def test_schema_files_of_both_kinds(spark, tmp_path):
    (tmp_path / "bid.avsc").write_text(json.dumps(BIDS, indent=2))
    found = schema_from_file(spark, str(tmp_path / "bid.avsc"))
    (tmp_path / "spark.json").write_text(found.json())
    assert schema_from_file(spark, str(tmp_path / "spark.json")) == found
