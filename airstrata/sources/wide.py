"""Wide station tables: column names and text notes stand in the first data rows.

Every file has names of its own, so values are matched to stations file by file. A file
that does not begin with a header goes on with the columns of the file before it in its
folder, as Spark writes one table in several files.
"""

import csv
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.times import parse_time
from ..workspace import workspace

NAME_ROW = 1  # fixed value: data row that holds the column names
NOTE_ROWS = 4  # fixed value: rows taken as notes once the name row is gone
TOP = NOTE_ROWS + 2  # header line, name row and notes
COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'  # not within quotes


def _unquoted(cell: Column) -> Column:
    inner = F.replace(cell.substr(F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))
    return F.when(cell.rlike('^".*"$'), inner).otherwise(cell)


def _cells(line: Column) -> Column:
    return F.transform(F.split(line, COMMA, -1), _unquoted)


def file_columns(spark: SparkSession, path) -> DataFrame:
    """file, names: the columns of every file, the first called ``time``; NULL if no file before it has any.

    A file begins with a header if its first line and the one where names stand have no readable
    time. Where a line stands follows from its number in the file's first block, which one
    task reads in order; a few lines per file are shuffled.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    ).where("block = 0")
    first = lines.groupBy("file").agg(F.min("place").alias("first"))
    untimed = lines.where(parse_time(F.get(_cells(F.col("value")), F.lit(0))).isNull())
    rank = F.row_number().over(Window.partitionBy("file").orderBy("place"))
    top = untimed.withColumn("rank", rank).where(F.col("rank") <= TOP).join(first, "file")
    line = F.col("place") - F.col("first")
    named = top.where(line == NAME_ROW + 1).join(top.where(line == 0).select("file"), "file", "left_semi")
    cells = _cells(F.col("value"))
    names = F.concat(F.array(F.lit("time")), F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0))))
    before = Window.partitionBy(F.regexp_extract("file", "^(.*)/", 1)).orderBy("file")
    return (
        first.select("file")
        .join(named.select("file", names.alias("names")), "file", "left")
        .select("file", F.last("names", ignorenulls=True).over(before).alias("names"))
    )


def _rows(spark: SparkSession, path, width: int, columns: DataFrame) -> DataFrame:
    """names, time and the cells after it, as text, of the rows with a readable time."""
    text = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    rows = spark.read.schema(text).csv(path, header=False)
    rows = rows.where(parse_time(F.col("c0")).isNotNull()).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("c0").alias("time"),
        F.array(*[F.col(f"c{i}") for i in range(1, width)]).cast("array<string>").alias("cells"),
    )
    lost = F.raise_error(F.concat(F.lit("no row of names for "), F.col("file")))
    return rows.join(columns, "file", "left").withColumn("names", F.coalesce("names", lost.cast("array<string>")))


def _layout(spark: SparkSession, path) -> tuple[DataFrame, list[list[str]], int]:
    """The stored columns of the files, one or two of their different lists, and the greatest width."""
    stored = workspace(spark, "columns")
    file_columns(spark, path).write.parquet(stored)
    columns = spark.read.schema("file string, names array<string>").parquet(stored)
    kinds = [r["names"] for r in columns.where("names IS NOT NULL").select("names").distinct().limit(2).collect()]
    return columns, kinds, columns.agg(F.max(F.size("names"))).first()[0] or 1


def read_wide_table(spark: SparkSession, path) -> DataFrame:
    """All rows with a readable ``time``, as ``time`` text and one double per station.

    Header, name and note rows are recognised by their ``time`` and dropped wherever they
    are; text that is no number becomes NULL. Files may name other stations, or the same in another order: a
    row has NULL for the stations its file lacks. If all files agree, the table is one plain scan.
    """
    columns, kinds, width = _layout(spark, path)
    if len(kinds) == 1 and columns.where("names IS NULL").isEmpty():
        names = kinds[0]
        text = T.StructType([T.StructField(name, T.StringType(), True) for name in names])
        quoted = [F.col(f"`{name}`") for name in names]
        rows = spark.read.schema(text).csv(path, header=False).where(parse_time(quoted[0]).isNotNull())
        return rows.select(quoted[0], *[c.try_cast("double").alias(n) for c, n in zip(quoted[1:], names[1:])])
    # One name per column of the result.
    places = columns.select("file", F.posexplode("names").alias("place", "name")).where("place > 0")
    order = places.groupBy("name").agg(F.min(F.struct("file", "place")).alias("at")).orderBy("at").collect()

    def of(name: str) -> Column:
        place = F.array_position("names", F.lit(name)).cast("int")
        return F.get("cells", F.when(place > 0, place - 2)).try_cast("double").alias(name)

    rows = _rows(spark, path, width, columns)
    return rows.select("time", *[of(r["name"]) for r in order])


def read_wide_long(spark: SparkSession, path, complete: bool = False) -> DataFrame:
    """time, station, value: one row per reading, whatever stations each file has.

    With ``complete`` only rows stay whose every value is a number of at least zero, the stations of
    the row's own file counting. Each file is unpivoted by its own names, so no list of all stations is needed.
    """
    columns, _, width = _layout(spark, path)
    rows = _rows(spark, path, width, columns)
    values = F.transform(F.slice("cells", F.lit(1), F.size("names") - 1), lambda c: c.try_cast("double"))
    rows = rows.select("time", F.slice("names", F.lit(2), F.size("names") - 1).alias("stations"), values.alias("values"))
    if complete:
        rows = rows.where(F.forall("values", lambda v: v.isNotNull() & ~F.isnan(v) & (v >= 0)))
    readings = rows.select("time", F.explode(F.arrays_zip("stations", "values")).alias("reading"))
    return readings.select("time", F.col("reading.stations").alias("station"), F.col("reading.values").alias("value"))


def _top_rows(spark: SparkSession, path: str) -> list[list[str]]:
    """The few lines at the top of the first file by name: header line, name row, notes."""
    first = min(spark.read.text(path).inputFiles())
    lines = spark.read.text(unquote(first)).take(TOP)
    return list(csv.reader(line.value for line in lines))


def read_notes(spark: SparkSession, path: str) -> DataFrame:
    """The first four rows without the name row, with their position, as text."""
    top = _top_rows(spark, path)
    names = ["time"] + top[1 + NAME_ROW][1:]
    rows = [row for i, row in enumerate(top[1:]) if i != NAME_ROW][:NOTE_ROWS]
    schema = T.StructType(
        [T.StructField("position", T.IntegerType(), False)]
        + [T.StructField(name, T.StringType(), True) for name in names]
    )
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], schema)
