"""JSON files of several layouts in one folder."""

import json

import pytest
from pyspark.sql import functions as F

from beaconmill.sources import SourceSpec, file_layouts, read_json_mixed, read_json_strings, read_source, readable, split_malformed

SCHEMA = "a int, b string"


@pytest.fixture
def folder(tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text, encoding="utf-8")

    put("lines.json", "".join(json.dumps({"a": i, "b": f"l{i}"}) + "\n" for i in range(100)))
    put("pretty array.json", json.dumps([{"a": 100, "b": "p"}, {"a": 101, "b": "{x}"}], indent=2) + "\n")
    put("pretty[1].json", "﻿" + json.dumps({"a": 102, "b": "o"}, indent=2))
    put("arrays.json", '[{"a": 103}, {"a": 104, "b": null}]\n\n[]\n[{"a": 105}]\n{"a": 106}\n')
    put("broken.json", '{"a": 107}\n{"a": \nnonsense\n"text"\n[1, {"a": 108}]\n{"a": "no number", "b": "kept"}\n')
    put("empty.json", "\n \n")
    return str(tmp_path)


def test_no_object_of_any_layout_is_lost(spark, folder):
    df = read_json_mixed(spark, folder, SCHEMA).cache()
    assert df.columns == ["a", "b", "_corrupt_record"]
    good, bad = split_malformed(df)
    assert sorted(r.a for r in good.collect()) == list(range(109))
    assert {r.b for r in good.filter("a in (101, 102)").collect()} == {"{x}", "o"}
    assert sorted(r._corrupt_record for r in bad.collect()) == ['"text"', "1", "nonsense", '{"a":', '{"a": "no number", "b": "kept"}']
    assert readable(df).filter("b = 'kept'").count() == 1
    assert df.filter("a is null and b is null and _corrupt_record is null").count() == 0


def test_each_file_has_its_layout(spark, folder):
    found = {r.file.rsplit("/", 1)[1]: r.layout for r in file_layouts(spark, folder).collect()}
    assert found == {"lines.json": "lines", "pretty%20array.json": "whole", "pretty%5B1%5D.json": "whole", "arrays.json": "lines", "broken.json": "lines"}


def test_schema_is_that_of_all_files(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1, "n": {"x": 1.5}}\n')
    (tmp_path / "y.json").write_text('[\n {"a": 2, "k": ["p"], "n": {"y": true}},\n {"z": null}\n]')
    df = read_json_mixed(spark, str(tmp_path))
    rows = {(r.a, r.n.x if r.n else None, r.n.y if r.n else None, tuple(r.k or ())) for r in df.collect()}
    assert {(a, x if x is None else float(x), y, k) for a, x, y, k in rows} == {(1, 1.5, None, ()), (2, None, True, ("p",)), (None, None, None, ())}
    assert "z" in df.columns


def test_many_lines_stay_splittable(spark, tmp_path):
    spark.range(20_000).select(F.to_json(F.struct("id")).alias("value")).repartition(4).write.text(str(tmp_path / "t"))
    df = read_json_mixed(spark, str(tmp_path / "t"), "id bigint")
    assert df.filter("_corrupt_record is null").agg(F.sum("id")).first()[0] == 20_000 * 19_999 // 2


def test_a_later_file_of_another_layout_is_an_error_or_read(spark, tmp_path):
    (tmp_path / "a.json").write_text("".join(json.dumps({"a": i}) + "\n" for i in range(100)))
    (tmp_path / "b.json").write_text(json.dumps([{"a": 100}, {"a": 101}], indent=2))
    with pytest.raises(ValueError, match="b.json"):
        read_json_strings(spark, str(tmp_path), schema="a int")
    rows = read_source(spark, SourceSpec("x", "json", str(tmp_path), "a int", {"layout": "mixed"})).collect()
    assert sorted(r.a for r in rows) == list(range(102))
    assert read_json_strings(spark, str(tmp_path), schema="a int", mixed=True).filter("a is not null").count() == 102


def test_declared_lines_may_begin_with_a_broken_one(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": \n{"a": 1}\n')
    assert read_json_strings(spark, str(tmp_path), schema="a int").count() == 2


@pytest.mark.parametrize("between", [", ", ",\n"])
def test_a_long_array_takes_work_in_proportion(spark, tmp_path, between):
    # with the whole text beside each element this would be 40 GB
    rows = [json.dumps({"a": i, "b": "x" * 80}) for i in range(20_000)]
    (tmp_path / "a.json").write_text(f"[{between.join(rows)}]")
    (tmp_path / "b.json").write_text('{"a": 20000}\n[]\n[null, {"a": 20001}]\n')
    df = read_json_mixed(spark, str(tmp_path), SCHEMA)
    assert df.filter("a is not null").agg(F.count("a"), F.sum("a"), F.count("b")).first() == (20_002, 20_001 * 20_002 // 2, 20_000)
    assert df.filter("a is null").count() == 1
