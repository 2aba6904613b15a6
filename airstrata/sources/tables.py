"""Readers of tabular files."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schemas import STATION_SCHEMA, measurement_schema


# Texts come back as they were written: blanks at the ends, quotes and back-slashes,
# and an empty text (quoted) apart from NULL (nothing between two separators).
TEXT_FORMAT = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "nullValue": "\u0000",
    "emptyValue": "",
}


def header_schema(reader, path, wanted: T.StructType) -> T.StructType:
    """The columns in the order of the header, typed as wanted, others as text.

    Without any file yet, the wanted schema itself.
    """
    header = reader.csv(path).columns
    missing = [name for name in wanted.names if name not in header]
    if missing and header:
        raise ValueError(f"columns missing in {path}: {missing}")
    return T.StructType(
        [wanted[n] if n in wanted.names else T.StructField(n, T.StringType()) for n in header]
    ) if header else wanted


def read_delimited(
    spark: SparkSession,
    path,
    schema: T.StructType | None = None,
    sep: str = ";",
    multiline: bool = False,
) -> DataFrame:
    """Delimited text with a header line.

    With a schema the data is read once and its columns are picked **by name**;
    only the header line is looked at first, so further or reordered columns do
    no harm. All files must share the header, else the read fails. Without a
    schema the types are inferred, which costs a pass over the whole input.
    ``multiline`` is for free text that may hold line ends; such files are not split.
    """
    reader = spark.read.options(**TEXT_FORMAT, sep=sep, header=True, multiLine=multiline)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    stored = header_schema(reader, path, schema)
    rows = reader.schema(stored).option("enforceSchema", False).csv(path)
    return rows.select(*[F.col(f"`{name}`") for name in schema.names])


def read_measurements(spark: SparkSession, path) -> DataFrame:
    """Landed measurement files: the 13 columns, times still as text."""
    return read_delimited(spark, path, measurement_schema())


def read_stations(spark: SparkSession, path) -> DataFrame:
    """The station list, as comma-separated text."""
    return read_delimited(spark, path, STATION_SCHEMA, sep=",")


def read_parquet(spark: SparkSession, *paths: str, root=None, schema=None) -> DataFrame:
    """Parquet from one or many paths.

    ``root`` is the table's top folder: with it, columns held in folder names
    come back even when single partitions or files are named.
    """
    reader = spark.read
    if root is not None:
        reader = reader.option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*paths)


def read_json_payload(
    spark: SparkSession, path, schema: T.StructType, whole_file: bool = False
) -> DataFrame:
    """JSON replies as rows; an array yields one row per element. A broken reply is an error.

    One reply per line is splittable. ``whole_file`` reads replies that span
    lines, one task per file. ``split_json_payload`` gives broken replies apart.
    """
    reader = spark.read.schema(schema).option("multiLine", whole_file)
    return reader.option("mode", "FAILFAST").json(path)


def split_json_payload(
    spark: SparkSession, path, schema: T.StructType, whole_file: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): rows of the readable replies, and the text of the others as ``reply``.

    A reply is an object or an array of objects; blank lines are neither.
    """
    replies = spark.read.text(path, wholetext=whole_file)
    parsed = replies.where(F.trim("value") != "").select(
        F.from_json("value", T.ArrayType(schema)).alias("rows"), F.col("value").alias("reply")
    )
    rows = parsed.select(F.explode("rows").alias("row")).select("row.*")
    return rows, parsed.where(F.col("rows").isNull()).select("reply")
