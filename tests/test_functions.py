from datetime import datetime

import pytest
from pyspark.sql import functions as F

from airstrata.functions.geo import lat_lon, lat_lon_text, lon_lat, multipolygon_wkt, polygon_wkt
from airstrata.functions.keys import document_key, key_array
from airstrata.functions.paths import media_type, partition_value
from airstrata.functions.text import json_number_map, squeeze_whitespace, utf8_text
from airstrata.functions.times import day_compact, day_text, days_before, iso_text, parse_time, year_text


def one(spark, fields, row, column):
    return spark.createDataFrame([row], fields).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025/03/01 19:00:00", datetime(2025, 3, 1, 19)),
        ("2025-03-01 19:00:00", datetime(2025, 3, 1, 19)),
        ("2025-03-01T19:00:00", datetime(2025, 3, 1, 19)),
        ("2025-03-01 19:00:00.250000", datetime(2025, 3, 1, 19, 0, 0, 250000)),
        ("2025/03/01 19:30", datetime(2025, 3, 1, 19, 30)),
        ("2025/03-01 19:30", None),
        ("2025-02-30 10:00:00", None),
        ("2025", None),
        ("n/a", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_time(spark, text, expected):
    assert one(spark, "t string", (text,), parse_time(F.col("t"))) == expected


def test_parse_time_with_other_format(spark):
    column = parse_time(F.col("t"), ["dd.MM.yyyy HH:mm"])
    assert one(spark, "t string", ("01.03.2025 19:00",), column) == datetime(2025, 3, 1, 19)


def test_time_tokens(spark):
    row = (datetime(2025, 3, 1, 19, 5, 9, 999999),)
    ts = F.col("t")
    assert one(spark, "t timestamp_ntz", row, iso_text(ts)) == "2025-03-01T19:05:09"
    assert one(spark, "t timestamp", row, iso_text(ts)) == "2025-03-01T19:05:09"
    assert one(spark, "t timestamp", row, day_text(ts)) == "2025-03-01"
    assert one(spark, "t timestamp", row, day_compact(ts)) == "20250301"
    assert one(spark, "t timestamp", row, year_text(ts)) == "2025"
    assert one(spark, "t timestamp", row, day_text(days_before(ts, 1))) == "2025-02-28"


def test_coordinates_keep_their_order(spark):
    row, fields = (44.9, -0.5), "lat double, lon double"
    lat, lon = F.col("lat"), F.col("lon")
    assert one(spark, fields, row, lon_lat(lon, lat)) == [-0.5, 44.9]
    assert one(spark, fields, row, lat_lon(lat, lon)).asDict() == {"lat": 44.9, "lon": -0.5}
    assert one(spark, fields, row, lat_lon_text(lat, lon)) == "(44.9, -0.5)"
    assert one(spark, fields, (None, 1.0), lat_lon_text(lat, lon)) is None


RING = "array<struct<x:double,y:double>>"


@pytest.mark.parametrize(
    "rings, expected",
    [
        ([[(0.0, 0.0), (4.0, 0.0), (0.0, 0.0)]], "POLYGON ((0 0, 4 0, 0 0))"),
        (
            [[(0.0, 0.0), (-4.5, 0.0)], [(1.0, 1.25), (1e-7, 123456789.0)]],
            "POLYGON ((0 0, -4.5 0), (1 1.25, 0.0000001 123456789))",
        ),
        ([[(12345678.5, -0.0005)]], "POLYGON ((12345678.5 -0.0005))"),
        ([], "POLYGON EMPTY"),
        (None, None),
    ],
)
def test_polygon_wkt(spark, rings, expected):
    assert one(spark, f"r array<{RING}>", (rings,), polygon_wkt(F.col("r"))) == expected


def test_multipolygon_wkt(spark):
    shapes = [[[(0.0, 0.0), (1.0, 1.0)]], [[(2.0, 2.0), (3.0, 3.0)], [(2.5, 2.5)]]]
    column = multipolygon_wkt(F.col("m"))
    expected = "MULTIPOLYGON (((0 0, 1 1)), ((2 2, 3 3), (2.5 2.5)))"
    assert one(spark, f"m array<array<{RING}>>", (shapes,), column) == expected
    assert one(spark, f"m array<array<{RING}>>", ([],), column) == "MULTIPOLYGON EMPTY"


def test_document_key_needs_every_part(spark):
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    fields = "a string, b string, c string"
    assert one(spark, fields, ("2025-03-01", "FR1", "NO2"), document_key(a, b, c)) == "2025-03-01_FR1_NO2"
    assert one(spark, fields, ("2025-03-01", None, "NO2"), document_key(a, b, c)) is None
    assert one(spark, fields, ("2025-03-01", "FR1", "NO2"), key_array(a, b, c)) == ["2025-03-01", "FR1", "NO2"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"44.9": -0.5}', {44.9: -0.5}),
        ('{"1": 2, "x": 3}', {1.0: 2.0}),
        ('{"1": 2, "3": 4, "1.0": 5}', {1.0: 5.0, 3.0: 4.0}),
        ("{}", {}),
        ("{bad", None),
        (None, None),
    ],
)
def test_json_number_map(spark, text, expected):
    assert one(spark, "t string", (text,), json_number_map(F.col("t"))) == expected


def test_utf8_and_whitespace(spark):
    assert one(spark, "b binary", ("µg".encode(),), utf8_text(F.col("b"))) == "µg"
    text = " a \t\r\n b  c "
    assert one(spark, "t string", (text,), squeeze_whitespace(F.col("t"))) == "a b c"
    kept = squeeze_whitespace(F.col("t"), F.lit(False))
    assert one(spark, "t string", (text,), kept) == text


@pytest.mark.parametrize(
    "path, expected",
    [
        ("file:/L1/Polluant=NO2/part-0.parquet", "NO2"),
        ("file:/L1/Polluant=NOX%20as%20NO2/part-0.parquet", "NOX as NO2"),
        ("file:/L1/Polluant=PM2.5/part-0.parquet", "PM2.5"),
        ("file:/L1/Polluant=a+b/part-0.parquet", "a+b"),
        ("file:/L1/Polluant=a%253Ab/part-0.parquet", "a:b"),
        ("file:/L1/other/part-0.parquet", None),
    ],
)
def test_partition_value(spark, path, expected):
    assert one(spark, "p string", (path,), partition_value(F.col("p"), "Polluant")) == expected


@pytest.mark.parametrize(
    "path, expected",
    [
        ("x/a.csv", "application/csv"),
        ("x/a.JSON", "application/json"),
        ("x/a.zip", "application/zip"),
        ("x/a.xls", "text/plain"),
        ("x/csv", "text/plain"),
    ],
)
def test_media_type(spark, path, expected):
    assert one(spark, "p string", (path,), media_type(F.col("p"))) == expected
