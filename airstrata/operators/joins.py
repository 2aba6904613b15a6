"""Measurements with their stations."""

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import SITE, STATION_CODE
from .rows import backticked, quoted


def _on(left: DataFrame, right: DataFrame, site: str, code: str):
    return left[backticked(site)] == right[backticked(code)]


def join_stations(
    measurements: DataFrame, stations: DataFrame, how="inner", site=SITE, code=STATION_CODE
) -> DataFrame:
    """Equi-join on the station code; both keys stay, NULL sites match nothing.

    No broadcast is forced. Spark broadcasts the stations when their size is
    within ``spark.sql.autoBroadcastJoinThreshold`` (checked on the scan, and
    again by adaptive execution on the real size), else it sort-merges and
    splits sites that fill a partition.
    """
    return measurements.join(stations, _on(measurements, stations, site, code), how)


def join_stations_salted(
    measurements: DataFrame,
    stations: DataFrame,
    site: str = SITE,
    code: str = STATION_CODE,
    share: float = 0.001,
    slices: int = 64,
) -> DataFrame:
    """The inner join for a station table too large to broadcast and skewed sites.

    Sites with more than ``share`` of all rows - at most ``1 / share`` of them,
    whatever the data - are spread over ``slices`` sub-keys and only their
    station rows are repeated. All other sites keep one sub-key. Unlike the
    adaptive split this also holds when the result is grouped by site next,
    where adaptive execution leaves a hot partition whole. The rows per site are
    counted once, when this is called.
    """
    key = quoted(site)
    # With the sum over all sites as one row more, which has no site.
    counts = measurements.where(key.isNotNull()).rollup(key.alias("_site")).count()
    most = counts.orderBy(F.desc("count")).limit(math.ceil(1 / share) + 1).collect()
    total = max((r["count"] for r in most), default=0)
    hot = [r["_site"] for r in most if r["_site"] is not None and r["count"] > share * total]

    # Any spread is right; a hash of the row's content keeps retried tasks alike.
    spread = F.pmod(F.xxhash64(*[quoted(c) for c in measurements.columns]), F.lit(slices)).cast("int")
    salted = measurements.withColumn("_slice", F.when(key.isin(hot), spread).otherwise(F.lit(0)))
    every = F.sequence(F.lit(0), F.lit(slices - 1))
    copies = stations.withColumn(
        "_copy", F.explode(F.when(quoted(code).isin(hot), every).otherwise(F.array(F.lit(0))))
    )
    return salted.join(
        copies.hint("merge"), (key == quoted(code)) & (F.col("_slice") == F.col("_copy")), "inner"
    ).drop("_slice", "_copy")


def unmatched(
    measurements: DataFrame, stations: DataFrame, site=SITE, code=STATION_CODE
) -> DataFrame:
    """Sites without a station, with their number of readings.

    Readings are counted per site first, so the join sees one row per site. It
    is a left join with a NULL test: an anti join would be moved below the count.
    """
    counts = measurements.groupBy(quoted(site)).agg(F.count("*").alias("readings"))
    known = stations.select(quoted(code).alias("_known"))
    joined = counts.join(known, counts[backticked(site)] == F.col("_known"), "left")
    return joined.where(F.col("_known").isNull()).drop("_known")


def join_stations_colocated(
    spark: SparkSession, measurements: str, stations: str, how="inner", site=SITE, code=STATION_CODE
) -> DataFrame:
    """The station join of two tables written by ``write_bucketed`` on site and code: no row crosses the network.

    For a station table too large to broadcast that is joined again and again. A hot site is
    one bucket, which one task reads; ``join_stations_salted`` is the way for that.
    """
    left, right = spark.table(measurements), spark.table(stations)
    return left.join(right.hint("merge"), _on(left, right, site, code), how)
