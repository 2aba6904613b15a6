"""Layer files: Parquet in one folder per value, and delimited text."""

from pyspark.sql import DataFrame

from ..operators.rows import quoted
from ..schemas import POLLUTANT, ZONE


def write_layer(
    df: DataFrame,
    path: str,
    folders=(POLLUTANT,),
    cluster=(ZONE,),
    touched_only: bool = False,
) -> None:
    """Overwrite a Parquet layer, one folder per value, rows of a cluster together.

    Rows are rebalanced by folder rather than hash-partitioned to a fixed
    number of tasks: adaptive execution cuts the partition of a hot folder into
    tasks of the advisory size and merges small ones, so no folder is written by
    a single task and no task writes crumbs to every folder. Sorting by cluster
    gives the row groups narrow ranges to skip by.

    ``touched_only`` replaces just the folders present in ``df``; otherwise the
    whole layer is replaced.
    """
    (
        df.hint("rebalance", *[quoted(c) for c in folders])
        .sortWithinPartitions(*[quoted(c) for c in [*folders, *cluster]])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if touched_only else "static")
        .option("compression", "snappy")
        .partitionBy(*folders)
        .parquet(path)
    )


def write_delimited(df: DataFrame, path: str, sep: str = ",", folders=()) -> None:
    """Replace delimited text, with a header line in each file.

    Texts are kept as they are: blanks at their ends, quotes (doubled) and line ends;
    an empty text is written in quotes, NULL as nothing. Times keep their microseconds.
    """
    writer = df.write.mode("overwrite").options(
        header=True, sep=sep, quote='"', escape='"', nullValue="", emptyValue='""',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        timestampFormat="yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
        timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    )
    if folders:
        writer = writer.partitionBy(*folders)
    writer.csv(path)


def write_bucketed(df: DataFrame, table: str, path: str, column: str, buckets: int) -> None:
    """Replace a table whose files are dealt by a hash of ``column`` and sorted by it.

    Tables of the same number of buckets are joined on that column without moving their rows. The rows are
    dealt once, when they are written; so the number should suit the largest table, some hundred
    megabytes a bucket. The session's catalog holds the layout under ``table``; files are below ``path``.
    """
    (
        df.repartition(buckets, quoted(column))
        .write.mode("overwrite")
        .option("path", path)
        .option("compression", "snappy")
        .bucketBy(buckets, column)
        .sortBy(column)
        .saveAsTable(table)
    )
