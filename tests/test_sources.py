import struct
import zlib

import pytest
from pyspark.sql import functions as F, types as T

from airstrata.functions.paths import partition_value
from airstrata.schemas import COMBINED_SCHEMA, MEASUREMENT_COLUMNS, measurement_schema
from airstrata.sinks.layers import write_delimited, write_layer
from airstrata.sources.images import read_labelled_images
from airstrata.sources.listing import has_files, list_files
from airstrata.sources.tables import (
    read_delimited, read_json_payload, read_measurements, read_parquet, read_stations,
)
from airstrata.sources.wide import read_notes, read_wide_table
from airstrata.plans.tables import clean_wide_table, store_map, store_payload, store_stations, store_wide_table

from data import raw, reading, stations


def test_delimited_columns_are_found_by_name(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = raw(spark, reading(), reading(valeur=None))
    shuffled = df.withColumn("extra", F.lit("x")).select("extra", *reversed(MEASUREMENT_COLUMNS))
    write_delimited(shuffled, path, sep=";")
    got = read_measurements(spark, path)
    assert got.schema == measurement_schema()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


def test_delimited_rejects_missing_and_differing_headers(spark, tmp_path):
    path = tmp_path / "raw"
    path.mkdir()
    (path / "a.csv").write_text("a;b\n1;2\n")
    with pytest.raises(ValueError, match="columns missing"):
        read_delimited(spark, str(path), T.StructType().add("a", "integer").add("c", "integer"))
    (path / "b.csv").write_text("b;a\n1;2\n")
    with pytest.raises(Exception):
        read_delimited(spark, str(path), T.StructType().add("a", "integer").add("b", "integer")).collect()


def test_delimited_with_inferred_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n;x;t\n1;1.5;2025-03-01 10:00:00\n2;;x\n")
    df = read_delimited(spark, str(tmp_path / "a.csv"))
    assert [f.dataType.typeName() for f in df.schema] == ["integer", "double", "string"]


def test_bad_numbers_become_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n\n1\noops\n")
    df = read_delimited(spark, str(tmp_path / "a.csv"), T.StructType().add("n", "integer"))
    assert [r.n for r in df.collect()] == [1, None]


def test_stations_roundtrip(spark, tmp_path):
    write_delimited(stations(spark), str(tmp_path / "s"))
    got = read_stations(spark, str(tmp_path / "s"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        map(tuple, stations(spark).collect()), key=repr
    )


def test_folder_column_returns_with_the_root(spark, tmp_path):
    root = str(tmp_path / "L1")
    df = raw(spark, reading(Polluant="NOX as NO2"), reading(Polluant="PM2.5"), reading())
    write_layer(df, root)
    one = read_parquet(spark, f"{root}/Polluant=PM2.5", root=root)
    assert [r.Polluant for r in one.collect()] == ["PM2.5"]
    two = read_parquet(spark, f"{root}/Polluant=PM2.5", f"{root}/Polluant=NOX as NO2", root=root)
    assert sorted(r.Polluant for r in two.collect()) == ["NOX as NO2", "PM2.5"]
    leaf = read_parquet(spark, f"{root}/Polluant=PM2.5")
    assert "Polluant" not in leaf.columns
    by_path = leaf.select(partition_value(F.col("_metadata.file_path"), "Polluant").alias("p"))
    assert by_path.first().p == "PM2.5"


def test_explicit_schema_adds_absent_columns(spark, tmp_path):
    spark.range(2).select(F.lit("x").alias("Name")).write.parquet(str(tmp_path / "p"))
    df = read_parquet(spark, str(tmp_path / "p"), schema=COMBINED_SCHEMA)
    assert len(df.columns) == 19 and df.first().Name == "x" and df.first().valeur is None


def test_file_list(spark, tmp_path):
    root = tmp_path / "files"
    assert not has_files(spark, str(root))
    (root / "deep").mkdir(parents=True)
    assert not has_files(spark, str(root))
    (root / "a.csv").write_text("abc")
    (root / "deep" / "b.parquet").write_text("ab")
    (root / "deep" / "marker").write_text("")
    got = {r.path.rsplit("/", 1)[1]: (r.length, r.media_type) for r in list_files(spark, str(root)).collect()}
    assert got == {"a.csv": (3, "application/csv"), "b.parquet": (2, "text/plain")}
    assert has_files(spark, str(root), ".parquet") and not has_files(spark, str(root), ".json")
    plan = list_files(spark, str(root))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


SCHEMA = T.StructType().add("id", "integer").add("name", "string")


def test_json_payloads(spark, tmp_path):
    (tmp_path / "lines.json").write_text('[{"id":1,"name":"a"},{"id":2}]\n{"id":3,"x":0}\n')
    lines = read_json_payload(spark, str(tmp_path / "lines.json"), SCHEMA)
    assert sorted(map(tuple, lines.collect()), key=repr) == [(1, "a"), (2, None), (3, None)]
    (tmp_path / "whole.json").write_text('[\n {"id":1,\n "name":"a"},\n {"id":2}\n]\n')
    whole = read_json_payload(spark, str(tmp_path / "whole.json"), SCHEMA, whole_file=True)
    assert sorted(map(tuple, whole.collect()), key=repr) == [(1, "a"), (2, None)]
    table = store_payload(spark, str(tmp_path / "lines.json"), str(tmp_path / "csv"), SCHEMA)
    assert sorted(r.id for r in table.collect()) == [1, 2, 3]


WIDE = """Unnamed: 0,c1,c2
Code,x,y
Station,FR1,"FR,2"
Unit,ug,ug
Kind,a,b
More,c,d
2025-01-01 00:00:00,1.5,2
2025-01-01 01:00:00,-1,2
2025-01-01 02:00:00,,2
,3,3
2025-01-01 03:00:00,NaN,2
2025-01-01 04:00:00,0,oops
2025-01-01 05:00:00,0,7.25
"""


def test_wide_table(spark, tmp_path):
    path = tmp_path / "wide.csv"
    path.write_text(WIDE)
    table = read_wide_table(spark, str(path))
    assert table.columns == ["time", "FR1", "FR,2"]
    assert table.count() == 6
    cleaned = clean_wide_table(spark, str(path))
    assert sorted(map(tuple, cleaned.collect())) == [
        ("2025-01-01 00:00:00", 1.5, 2.0), ("2025-01-01 05:00:00", 0.0, 7.25),
    ]
    notes = [tuple(r) for r in read_notes(spark, str(path)).orderBy("position").collect()]
    assert notes == [(0, "Code", "x", "y"), (1, "Unit", "ug", "ug"), (2, "Kind", "a", "b"), (3, "More", "c", "d")]


def test_all_numeric_wide_table(spark, tmp_path):
    path = tmp_path / "wide.csv"
    path.write_text("t,a\n2025-01-01 00:00:00,1\nname,S.1\n2025-01-01 01:00:00,-2\n2025-01-01 02:00:00,3\n")
    got = clean_wide_table(spark, str(path))
    assert got.columns == ["time", "S.1"]
    assert sorted(r["S.1"] for r in got.collect()) == [1.0, 3.0]


def png(path, height, width, colour):
    """A one-colour RGB picture."""
    rows = (b"\0" + bytes(colour) * width) * height

    def chunk(kind, body):
        check = zlib.crc32(kind + body)
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", check)

    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(
        b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")
    )


@pytest.fixture
def pictures(tmp_path):
    root = tmp_path / "train"
    png(root / "grass" / "a.png", 6, 4, (10, 200, 30))
    png(root / "grass" / "more" / "b.png", 5, 5, (20, 180, 40))
    png(root / "dandelion flower" / "c.png", 8, 8, (250, 240, 5))
    (root / "grass" / "notes.txt").write_text("no picture")
    return str(root)


def test_labelled_images(spark, pictures):
    from airstrata.functions.pixels import normalize_planes, resize
    from airstrata.operators.learn import class_index

    images = read_labelled_images(spark, pictures)
    assert sorted(r.class_name for r in images.select("class_name").collect()) == [
        "dandelion flower", "grass", "grass",
    ]
    numbered = class_index(images, "class_name").transform(images)
    small = numbered.select("class_index", resize(F.col("image"), 2, 3).alias("planes"))
    got = {r.class_index: r.planes for r in small.where("class_index = 0").collect()}
    assert got == {0.0: [250.0] * 6 + [240.0] * 6 + [5.0] * 6}
    normal = small.where("class_index = 0").select(normalize_planes(F.col("planes")).alias("x")).first().x
    assert abs(normal[0] - (250 / 255 - 0.485) / 0.229) < 1e-12
    assert abs(normal[17] - (5 / 255 - 0.406) / 0.225) < 1e-12


def test_side_tables(spark, tmp_path):
    write_delimited(stations(spark), str(tmp_path / "list"))
    store_stations(spark, str(tmp_path / "list"), str(tmp_path / "stations"))
    table = spark.read.option("header", True).csv(str(tmp_path / "stations"))
    assert table.columns == ["NatlStationCode", "Name", "Latitude", "Longitude", "GPS"]
    assert table.where("Name = 'BASSENS'").first().GPS == "(44.900295, -0.515835)"

    (tmp_path / "wide.csv").write_text(WIDE)
    store_wide_table(spark, str(tmp_path / "wide.csv"), str(tmp_path / "wide"))
    assert spark.read.option("header", True).csv(str(tmp_path / "wide")).columns == ["time", "FR1", "FR,2"]

    rings = [[(0.0, 0.0), (4.0, 0.0), (0.0, 0.0)]]
    fields = "region bigint, rings array<array<struct<x:double,y:double>>>"
    spark.createDataFrame([(1, rings), (2, [])], fields).write.parquet(str(tmp_path / "shapes"))
    store_map(spark, str(tmp_path / "shapes"), str(tmp_path / "map"))
    stored = spark.read.option("header", True).csv(str(tmp_path / "map"))
    assert {r.region: r.geometry for r in stored.collect()} == {
        "1": "POLYGON ((0 0, 4 0, 0 0))", "2": "POLYGON EMPTY",
    }
