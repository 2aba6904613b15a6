"""Consecutive numbers in a given order, for tables that no single task could hold."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored


def numbered(rows: DataFrame, order: list[Column], group: str | None = None) -> DataFrame:
    """``rows`` with ``position`` (0, 1, 2... in ``order``) and ``size`` (the number of rows), both within
    each ``group`` if that column is named.

    ``group`` may not be NULL. Rows are dealt to tasks by ranges, so a group of any size is
    spread; its numbers follow from the counts of each range, one row per range and group.
    Rows that tie are told apart by where they are stored, so even a table of one
    repeated row is spread. The columns ``tie``, ``place`` and ``range`` are used here.
    """
    marked = stored(rows.withColumn("tie", F.monotonically_increasing_id()), "numbered")
    by = [*([F.col(group)] if group else []), *order, F.col("tie")]
    kept = stored(
        marked.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("place", F.monotonically_increasing_id()),
        "ranges",
    ).withColumn("range", F.shiftright("place", 33))
    keys = [group, "range"] if group else ["range"]
    whole = Window.partitionBy(F.col(group) if group else F.lit(0)).orderBy("range")
    ranges = kept.groupBy(*keys).agg(F.count("*").alias("n"), F.min("place").alias("first"))
    ahead = F.coalesce(F.sum("n").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    every = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = ranges.select(*keys, (ahead - F.col("first")).alias("shift"), F.sum("n").over(every).alias("size"))
    return kept.join(starts, keys).withColumn("position", F.col("place") + F.col("shift")).drop(
        "tie", "place", "range", "shift"
    )
