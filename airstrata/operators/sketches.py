"""Profiles that merge: one small row per day, any range of days at the price of its rows."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sinks.layers import write_layer
from .rows import quoted

ACCURACY = 400  # of the KLL sketches: ranks are off by less than 1 % (two-sided, 99 % of the time)
BUCKETS_LOG2 = 12  # of the HLL sketches: counts are off by 1.6 % (one standard deviation)
FIELDS = "day string, rows long, present long, total double, lowest double, highest double, spread binary, members binary"


def day_profiles(df: DataFrame, day: str, value: str, member: str) -> DataFrame:
    """Per day: rows, and of ``value`` the present ones, total, extremes and a KLL sketch; of ``member`` an HLL sketch.

    NULL and NaN values are not present. Every task reduces its rows to one per day, so a hot day
    sends as many rows as there are tasks.
    """
    number = quoted(value).cast("double")
    some = F.when(~F.isnan(number), number)
    return df.groupBy(quoted(day).cast("string").alias("day")).agg(
        F.count("*").alias("rows"),
        F.count(some).alias("present"),
        F.sum(some).alias("total"),
        F.min(some).alias("lowest"),
        F.max(some).alias("highest"),
        F.kll_sketch_agg_double(some, ACCURACY).alias("spread"),
        F.hll_sketch_agg(quoted(member), BUCKETS_LOG2).alias("members"),
    )


def store_profiles(profiles: DataFrame, path: str) -> None:
    """A folder per day; days that are profiled again replace theirs, others stay."""
    write_layer(profiles.withColumn("doc_day", F.col("day")), path, ("doc_day",), (), touched_only=True)


def merged_profile(
    spark: SparkSession, path: str, first: str | None = None, last: str | None = None, quantiles=(0.25, 0.5, 0.75)
) -> DataFrame:
    """One row for the days from ``first`` to ``last`` (both included): exact rows, present, total, lowest and highest;
    ``quantiles`` and ``members`` within the sketches' error. Only the folders of these days are read, never the data."""
    days = spark.read.schema(f"{FIELDS}, doc_day string").parquet(path)
    if first is not None:
        days = days.where(F.col("doc_day") >= first)
    if last is not None:
        days = days.where(F.col("doc_day") <= last)
    whole = days.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("present"), F.lit(0)).alias("present"),
        F.sum("total").alias("total"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
        F.kll_merge_agg_double(F.when(F.col("present") > 0, F.col("spread"))).alias("spread"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("members")), F.lit(0)).alias("members"),
    )
    levels = F.array(*[F.lit(float(q)) for q in quantiles])
    found = F.when(F.col("present") > 0, F.kll_sketch_get_quantile_double("spread", levels))
    return whole.withColumn("quantiles", found).drop("spread")
