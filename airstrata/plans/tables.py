"""Side tables: each from its landed form to delimited text."""

from pyspark.sql import DataFrame, SparkSession, types as T

from ..functions.geo import polygon_wkt
from ..operators.rows import nonnegative, quoted, require
from ..operators.stations import station_table
from ..schemas import SHAPE_SCHEMA
from ..sinks.layers import write_delimited
from ..sources.tables import read_delimited, read_json_payload, read_parquet, read_stations
from ..sources.wide import read_wide_table


def store_stations(spark: SparkSession, path: str, target: str) -> None:
    """Station list to the station table."""
    write_delimited(station_table(read_stations(spark, path)), target)


def clean_wide_table(spark: SparkSession, path: str) -> DataFrame:
    """Wide station table: rows with a time and no missing or negative value."""
    return nonnegative(require(read_wide_table(spark, path), ["time"]))


def store_wide_table(spark: SparkSession, path: str, target: str) -> None:
    """Wide station table, cleaned."""
    write_delimited(clean_wide_table(spark, path), target)


def store_map(spark: SparkSession, path: str, target: str) -> None:
    """Region outlines, held as rings, to a table with WKT text."""
    shapes = read_parquet(spark, path, schema=SHAPE_SCHEMA)
    text = shapes.withColumn("geometry", polygon_wkt(quoted("rings"))).drop("rings")
    write_delimited(text, target)


def store_payload(spark: SparkSession, path: str, target: str, schema: T.StructType) -> DataFrame:
    """Landed JSON replies to a table; gives that table."""
    write_delimited(read_json_payload(spark, path, schema), target)
    return read_delimited(spark, target, schema, sep=",")
