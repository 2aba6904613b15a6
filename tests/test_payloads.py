"""JSON replies of unknown shape."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from airstrata.sources.payloads import read_payload, read_records, record_schema, shape_of, typed_records


def land(spark, tmp_path, *replies):
    path = str(tmp_path / "replies")
    texts = [r if isinstance(r, str) else json.dumps(r) for r in replies]
    spark.createDataFrame([(t,) for t in texts], "value string").write.mode("overwrite").text(path)
    return path


def test_types_follow_the_records(spark, tmp_path):
    path = land(spark, tmp_path, [{"a": 1, "b": "x"}, {"a": 2.5}], {"c": {"d": True}, "e": [1, 2]}, {"f": None})
    rows, rejects = read_payload(spark, path)
    assert rows.schema.simpleString() == (
        "struct<a:double,b:string,c:struct<d:boolean>,e:array<bigint>,f:string>"
    )
    assert sorted((r.asDict(recursive=True) for r in rows.collect()), key=repr) == sorted([
        {"a": 1.0, "b": "x", "c": None, "e": None, "f": None},
        {"a": 2.5, "b": None, "c": None, "e": None, "f": None},
        {"a": None, "b": None, "c": {"d": True}, "e": [1, 2], "f": None},
        {"a": None, "b": None, "c": None, "e": None, "f": None},
    ], key=repr)
    assert rejects.isEmpty()


def test_conflicts_follow_the_majority(spark, tmp_path):
    path = land(
        spark, tmp_path, {"k": 1, "v": 10}, {"k": 2, "v": "11"}, {"k": 3, "v": 12}, {"k": 4, "v": "n/a"},
        {"k": 5, "v": {"x": 1}}, {"k": 6, "v": [13]}, {"k": 7, "v": None}, {"k": 8}, {"k": 9, "v": 14},
    )
    rows, rejects = read_payload(spark, path)
    assert dict(rows.dtypes) == {"k": "bigint", "v": "bigint"}
    assert {r.k: r.v for r in rows.collect()} == {1: 10, 2: 11, 3: 12, 7: None, 8: None, 9: 14}
    assert sorted(json.loads(r.text)["k"] for r in rejects.collect()) == [4, 5, 6]
    assert {r.reason for r in rejects.collect()} == {"v is no bigint"}


def test_a_field_of_objects_mostly(spark, tmp_path):
    """Objects that are the majority stay variants; a scalar in their place is a reject."""
    path = land(spark, tmp_path, {"v": {"x": 1}}, {"v": {"y": "z"}}, {"v": 3})
    rows, rejects = read_payload(spark, path)
    assert isinstance(rows.schema["v"].dataType, T.VariantType)
    assert sorted(r.t for r in rows.select(F.to_json("v").alias("t")).collect()) == ['{"x":1}', '{"y":"z"}']
    assert [r.reason for r in rejects.collect()] == ["v is no variant"]


def test_replies_that_are_no_records(spark, tmp_path):
    path = land(spark, tmp_path, "[]", "  ", "{bad", "3", "null", '["x", {"a": 1}]', '{"a":1,"a":2}')
    records, rejects = read_records(spark, path)
    assert records.count() == 1
    found = sorted((r.reason, r.text) for r in rejects.collect())
    assert found == [("no JSON", '{"a":1,"a":2}'), ("no JSON", "{bad"), ("no record", '"x"'), ("no record", "3"), ("no record", "null")]


def test_records_within_a_reply(spark, tmp_path):
    path = land(spark, tmp_path, {"total": 2, "results": [{"a b": 1, "c.d": "é", "`": 2}, {"a b": 3}]}, {"total": 0})
    rows, rejects = read_payload(spark, path, at="$.results")
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted([(2, 1, "é"), (None, 3, None)], key=repr)
    assert set(rows.columns) == {"a b", "c.d", "`"}
    assert [r.reason for r in rejects.collect()] == ["no record"]


def test_whole_files_and_a_given_schema(spark, tmp_path):
    path = tmp_path / "reply.json"
    path.write_text(json.dumps([{"a": 1, "b": 2}, {"a": "x"}], indent=2))
    rows, rejects = read_payload(spark, str(path), whole_file=True, schema=T.StructType([T.StructField("a", T.LongType())]))
    assert [tuple(r) for r in rows.collect()] == [(1,)]
    assert [r.reason for r in rejects.collect()] == ["a is no bigint"]


def test_nothing_at_all(spark, tmp_path):
    records, _ = read_records(spark, land(spark, tmp_path, " "))
    assert record_schema(records) == T.StructType()
    rows, rejects = read_payload(spark, land(spark, tmp_path, "{}"))
    assert rows.columns == [] and rejects.isEmpty()


def test_shapes_are_counted(spark, tmp_path):
    records, _ = read_records(spark, land(spark, tmp_path, {"v": 1}, {"v": 2.5}, {"v": "x"}, {"w": None}))
    found = {(r.field, r.kind): r.rows for r in shape_of(records).collect()}
    assert found == {("v", "number"): 2, ("v", "STRING"): 1, ("w", "VOID"): 1}


@pytest.mark.parametrize("kind", ["bigint", "double", "string", "boolean"])
def test_nulls_fit_every_type(spark, tmp_path, kind):
    records, _ = read_records(spark, land(spark, tmp_path, {"v": None}, {}))
    rows, rejects = typed_records(records, T.StructType([T.StructField("v", T.DataType.fromDDL(kind))]))
    assert [r.v for r in rows.collect()] == [None, None] and rejects.isEmpty()
