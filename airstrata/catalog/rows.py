"""Projection, cleaning, times, keys, joins and profiles."""

from pyspark.sql import functions as F

from ..functions.casting import as_double, as_integer
from ..functions.geo import lon_lat
from ..functions.keys import document_key, key_array
from ..functions.times import (
    day_compact, day_text, days_before, iso_text, landed_name, parse_time, year_text,
)
from ..operators import joins, profile, rows, sketches
from ..operators.rows import quoted
from ..operators.stations import station_table
from ..plans import layers
from ..plans.layers import entry_rules
from ..schemas import (
    DATE, END, GPS, LATITUDE, LONGITUDE, MEASUREMENT_COLUMNS, POLLUTANT, POLLUTANT_COPY, RAW_VALUE,
    SITE, START, STATION_CODE, VALUE,
)
from ..sinks.layers import write_bucketed
from ..workspace import workspace
from .registry import query
from .tables import (
    FEW_STATIONS, ISO_TIMES, MEASUREMENTS, OTHER_COLUMNS, STATIONS,
    few_stations, landed, measurements, stations, table,
)


def iso(df):
    """Show both times as text."""
    return df.withColumns({c: iso_text(quoted(c)) for c in (START, END)})


@query(
    "project_measurements",
    f"WITH m AS ({MEASUREMENTS}) SELECT {ISO_TIMES}, {OTHER_COLUMNS} FROM m",
)
def project_measurements(spark, folder):
    return iso(rows.project(measurements(spark, folder)))


@query(
    "stamp_and_copy",
    f"""WITH m AS ({MEASUREMENTS})
    SELECT event_id, "Polluant", "Polluant" AS "Polluant_copy",
        strftime("Date de début", '%Y-%m-%d') AS date, '2024-01-31' AS run_date
    FROM m""",
)
def stamp_and_copy(spark, folder):
    readings = rows.copy_column(measurements(spark, folder).select("event_id", START, POLLUTANT))
    by_reading = rows.stamp_date(readings)
    by_run = rows.stamp_date(by_reading.withColumnRenamed(DATE, "day"), "2024-01-31")
    return by_run.withColumnRenamed(DATE, "run_date").withColumnRenamed("day", DATE).drop(START)


@query(
    "run_date_tokens",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y%m%d') AS folder,
        strftime(ts, '%Y') AS year, strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') AS day_before,
        'FR_E2_' || strftime(ts, '%Y-%m-%d') || '.csv' AS file
    FROM events""",
)
def run_date_tokens(spark, folder):
    ts = F.col("ts")
    return table(spark, folder, "events").select(
        "event_id",
        day_text(ts).alias("day"),
        day_compact(ts).alias("folder"),
        year_text(ts).alias("year"),
        day_text(days_before(ts, 1)).alias("day_before"),
        landed_name(ts).alias("file"),
    )


@query(
    "clean_required",
    f"""WITH m AS ({MEASUREMENTS}) SELECT event_id, {ISO_TIMES}, {OTHER_COLUMNS} FROM m
    WHERE "valeur" IS NOT NULL AND "valeur brute" IS NOT NULL""",
)
def clean_required(spark, folder):
    return iso(rows.require(measurements(spark, folder)))


@query(
    "clean_complete",
    """SELECT event_id, 0.5::DOUBLE AS pair_second,
        CASE WHEN event_id % 5 <> 0 THEN value END AS pair_first
    FROM events WHERE event_id % 7 <> 0 AND event_id % 3 <> 0""",
)
def clean_complete(spark, folder):
    """A NULL and a NaN drop the row, a NULL inside an array does not."""
    event, value = F.col("event_id"), F.col("value")
    gaps = table(spark, folder, "events").select(
        "event_id",
        F.when(event % 7 != 0, value).alias("maybe_null"),
        F.when(event % 3 != 0, value).otherwise(F.lit(float("nan"))).alias("maybe_nan"),
        F.array(F.when(event % 5 != 0, value), F.lit(0.5)).alias("pair"),
    )
    return rows.complete(gaps).select(
        "event_id", F.get("pair", F.lit(0)).alias("pair_first"),
        F.get("pair", F.lit(1)).alias("pair_second"),
    )


@query(
    "reject_split",
    f"""WITH m AS ({MEASUREMENTS})
    SELECT event_id, CASE WHEN "valeur" IS NULL THEN 'no valeur'
        WHEN "valeur brute" IS NULL THEN 'no valeur brute'
        WHEN event_id % 19 = 0 THEN 'unreadable Date de début' ELSE 'accepted' END AS outcome
    FROM m""",
)
def reject_split(spark, folder):
    """Every landed row with its outcome, in one pass."""
    raw = landed(spark, folder)
    marked = rows.with_reason(raw, entry_rules(raw), "outcome")
    return marked.select("event_id", F.coalesce("outcome", F.lit(rows.ACCEPTED)).alias("outcome"))


@query(
    "cast_tolerant",
    """SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value END AS as_double,
        event_id::VARCHAR AS as_text,
        CASE WHEN event_id % 4 <> 0 THEN event_id::INTEGER END AS as_integer,
        CASE WHEN event_id % 3 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS as_time
    FROM events""",
)
def cast_tolerant(spark, folder):
    event = F.col("event_id")
    dirty = table(spark, folder, "events").select(
        "event_id",
        F.when(event % 5 != 0, F.col("value").cast("string")).otherwise("n/a").alias("number"),
        F.when(event % 3 != 0, F.col("ts").cast("string")).otherwise("soon").alias("time"),
        F.when(event % 4 != 0, event.cast("string")).otherwise("12a").alias("digits"),
    )
    return dirty.select(
        "event_id",
        as_double(F.col("number")).alias("as_double"),
        event.cast("string").alias("as_text"),
        as_integer(F.col("digits")).alias("as_integer"),
        iso_text(F.col("time").try_cast("timestamp")).alias("as_time"),
    )


@query(
    "filter_all_nonnegative",
    "SELECT * FROM customer WHERE c_custkey >= 0 AND c_nationkey >= 0 AND c_acctbal >= 0",
)
def filter_all_nonnegative(spark, folder):
    return rows.nonnegative(table(spark, folder, "customer"))


@query(
    "station_dim",
    f"""WITH s AS ({STATIONS})
    SELECT "NatlStationCode", "Name", "Latitude", "Longitude",
        '(' || "Latitude" || ', ' || "Longitude" || ')' AS "GPS"
    FROM s""",
)
def station_dim(spark, folder):
    return station_table(stations(spark, folder))


JOINED = """
    SELECT m.event_id, m."code site", s."NatlStationCode", s."Name", s."Latitude", s."Longitude"
    FROM m {how} JOIN s ON m."code site" = s."NatlStationCode"
"""
JOINED_COLUMNS = ["event_id", SITE, STATION_CODE, "Name", LATITUDE, LONGITUDE]


def _join_sql(how):
    return f"WITH m AS ({MEASUREMENTS}), s AS ({FEW_STATIONS}) " + JOINED.format(how=how)


@query("join_station_inner", _join_sql("INNER"))
def join_station_inner(spark, folder):
    joined = joins.join_stations(measurements(spark, folder), few_stations(spark, folder))
    return rows.project(joined, JOINED_COLUMNS)


@query("join_station_colocated", _join_sql("INNER"))
def join_station_colocated(spark, folder):
    """Both tables bucketed by the station's code beforehand; the join moves nothing."""
    path = workspace(spark, "colocated")
    names = [f"{kind}_{path.rsplit('-', 1)[1]}" for kind in ("readings", "stations")]
    for name, df, column in zip(names, (measurements(spark, folder), few_stations(spark, folder)), (SITE, STATION_CODE)):
        write_bucketed(df, name, f"{path}/{name}", column, 8)
    return rows.project(joins.join_stations_colocated(spark, *names), JOINED_COLUMNS)


@query("join_station_left", _join_sql("LEFT"))
def join_station_left(spark, folder):
    joined = joins.join_stations(measurements(spark, folder), few_stations(spark, folder), "left")
    return rows.project(joined, JOINED_COLUMNS)


@query("join_station_salted", _join_sql("INNER"))
def join_station_salted(spark, folder):
    readings = measurements(spark, folder).select("event_id", quoted(SITE))
    joined = joins.join_stations_salted(readings, few_stations(spark, folder))
    return rows.project(joined, JOINED_COLUMNS)


@query(
    "unmatched_sites",
    f"""WITH m AS ({MEASUREMENTS}), s AS ({FEW_STATIONS})
    SELECT "code site", count(*) AS readings FROM m
    WHERE "code site" NOT IN (SELECT "NatlStationCode" FROM s) GROUP BY 1""",
)
def unmatched_sites(spark, folder):
    return joins.unmatched(measurements(spark, folder), few_stations(spark, folder))


@query(
    "count_by_zone_pollutant",
    f"""WITH m AS ({MEASUREMENTS}) SELECT "Zas", "Polluant", count(*) AS count FROM m
    WHERE "valeur" IS NOT NULL AND "valeur brute" IS NOT NULL GROUP BY 1, 2""",
)
def count_by_zone_pollutant(spark, folder):
    return profile.count_by(rows.require(measurements(spark, folder)))


@query("distinct_pollutants", f'WITH m AS ({MEASUREMENTS}) SELECT DISTINCT "Polluant" FROM m')
def distinct_pollutants(spark, folder):
    return profile.distinct_values(measurements(spark, folder))


@query(
    "row_count_audit",
    f"""WITH m AS ({MEASUREMENTS}) SELECT count(*) AS rows_before,
        count(*) FILTER ("valeur" IS NOT NULL AND "valeur brute" IS NOT NULL) AS rows_after
    FROM m""",
)
def row_count_audit(spark, folder):
    readings = measurements(spark, folder)
    good = rows.is_present(readings, VALUE) & rows.is_present(readings, RAW_VALUE)
    return profile.count_audit(readings, good)


def _profile_sql(*columns):
    one = """SELECT '{c}' AS "column", count("{c}") AS count, round(avg("{c}"), 4) AS mean,
        round(stddev_samp("{c}"), 4) AS stddev, min("{c}")::DOUBLE AS min,
        max("{c}")::DOUBLE AS max FROM m"""
    return f"WITH m AS ({MEASUREMENTS}) " + " UNION ALL ".join(one.format(c=c) for c in columns)


@query("profile_numeric", _profile_sql("event_id", "valeur", "valeur brute", "validité"))
def profile_numeric(spark, folder):
    return profile.profile(measurements(spark, folder)).withColumns(
        {c: F.round(c, 4) for c in ("mean", "stddev")}
    )


def _gaps_sql():
    names = ["event_id", *(c.replace("'", "''") for c in MEASUREMENT_COLUMNS)]
    counts = [f"""SELECT '{c}' AS "column", count(*) - count("{c.replace("''", "'")}") AS missing FROM m""" for c in names]
    return f"WITH m AS ({MEASUREMENTS}) " + " UNION ALL ".join(counts)


@query("gap_counts", _gaps_sql())
def gap_counts(spark, folder):
    return profile.gap_counts(measurements(spark, folder))


@query(
    "reject_counts",
    f"""WITH m AS ({MEASUREMENTS})
    SELECT CASE WHEN "valeur" IS NULL THEN 'no valeur'
        WHEN "valeur brute" IS NULL THEN 'no valeur brute'
        WHEN event_id % 19 = 0 THEN 'unreadable Date de début'
        WHEN "validité" <= 0 THEN 'not valid' END AS reason, count(*) AS rows
    FROM m GROUP BY 1""",
)
def reject_counts(spark, folder):
    raw = landed(spark, folder)
    return profile.reject_counts(raw, entry_rules(raw, only_valid=True))


@query(
    "audit_observed",
    f"""WITH m AS ({MEASUREMENTS}), r AS (SELECT CASE WHEN "valeur" IS NULL THEN 'no valeur'
        WHEN "valeur brute" IS NULL THEN 'no valeur brute'
        WHEN event_id % 19 = 0 THEN 'unreadable Date de début'
        WHEN "validité" <= 0 THEN 'not valid' ELSE 'accepted' END AS reason FROM m)
    SELECT reason, count(*) AS rows, count(*) FILTER (reason = 'accepted') AS stored FROM r GROUP BY 1""",
)
def audit_observed(spark, folder):
    """Rows per reject reason as the write of the cleaned layer counted them, and what that layer holds."""
    path, raw = workspace(spark, "audited"), landed(spark, folder)
    counts = layers.store_cleaned_audited(raw, path, only_valid=True)
    some = [(reason, n) for reason, n in counts.items() if n]
    held = spark.read.parquet(path).agg(F.count(quoted(POLLUTANT_COPY))).scalar()
    told = spark.createDataFrame(some, "reason string, rows long")
    return told.withColumn("stored", F.when(F.col("reason") == rows.ACCEPTED, held).otherwise(F.lit(0)))


@query(
    "merged_profiles",
    f"""WITH m AS ({MEASUREMENTS}), d AS (SELECT *, strftime("Date de début", '%Y-%m-%d') AS day FROM m),
    f AS (SELECT '' AS label, * FROM d UNION ALL SELECT 'January', * FROM d WHERE day < '2024-02-01')
    SELECT label, count(*) AS rows, count("valeur") AS present, round(sum("valeur"), 2) AS total,
        min("valeur") AS lowest, max("valeur") AS highest, TRUE AS quantiles_near, TRUE AS members_near
    FROM f GROUP BY label""",
)
def merged_profiles(spark, folder):
    """All days and those of a month, merged from day folders; whether sketches are within their stated errors."""
    path = workspace(spark, "profiles")
    dated = rows.stamp_date(measurements(spark, folder)).select(DATE, quoted(VALUE), quoted(SITE))
    sketches.store_profiles(sketches.day_profiles(dated, DATE, VALUE, SITE), path)
    parts = []
    for label, last in (("", None), ("January", "2024-01-31")):
        merged = sketches.merged_profile(spark, path, last=last, quantiles=(0.25, 0.5, 0.75))
        known = dated if last is None else dated.where(F.col(DATE) <= last)
        found = known.withColumns({c: merged.select(c).scalar() for c in ("quantiles", "members")})
        value = quoted(VALUE)
        # How far each quantile's own rank is from what was asked for.
        ranks = [F.abs(F.avg((value <= F.get("quantiles", F.lit(i))).cast("int")) - q) for i, q in enumerate((0.25, 0.5, 0.75))]
        near = found.agg(
            (F.greatest(*ranks) < 0.01 + 2 / F.count(value)).alias("quantiles_near"),
            (F.abs(F.first("members") / F.count_distinct(quoted(SITE)) - 1) < 0.05).alias("members_near"),
        )
        told = {c: near.select(c).scalar() for c in near.columns}
        parts.append(merged.drop("quantiles", "members").withColumns(told).withColumn("label", F.lit(label)))
    return parts[0].unionByName(parts[1]).withColumn("total", F.round("total", 2))


@query(
    "parse_timestamps",
    """SELECT event_id, CASE WHEN event_id % 19 <> 0
            THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS "Date de début",
        strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S') AS "Date de fin"
    FROM events""",
)
def parse_timestamps(spark, folder):
    raw = landed(spark, folder).select("event_id", START, END)
    return iso(raw.withColumns({c: parse_time(quoted(c)) for c in (START, END)}))


@query(
    "iso_timestamps",
    f"WITH m AS ({MEASUREMENTS}) SELECT event_id, {ISO_TIMES} FROM m",
)
def iso_timestamps(spark, folder):
    return iso(measurements(spark, folder).select("event_id", START, END))


@query(
    "geo_point",
    f"""WITH s AS ({STATIONS})
    SELECT "NatlStationCode", "Longitude" AS first, "Latitude" AS second, 2 AS length FROM s""",
)
def geo_point(spark, folder):
    points = stations(spark, folder).withColumn(GPS, lon_lat(F.col(LONGITUDE), F.col(LATITUDE)))
    return points.select(
        STATION_CODE,
        F.get(GPS, F.lit(0)).alias("first"),
        F.get(GPS, F.lit(1)).alias("second"),
        F.size(GPS).alias("length"),
    )


@query(
    "document_key",
    """SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN
            strftime(ts, '%Y-%m-%d') || '_FR' || user_id || '_' || event_type END AS doc_id,
        concat_ws('|', strftime(ts, '%Y-%m-%d'), 'FR' || user_id, event_type) AS key_parts
    FROM events""",
)
def document_keys(spark, folder):
    readings = measurements(spark, folder)
    day, site, kind = day_text(quoted(START)), quoted(SITE), quoted(POLLUTANT)
    known = F.when(F.col("event_id") % 7 != 0, kind)
    return readings.select(
        "event_id",
        document_key(day, site, known).alias("doc_id"),
        F.array_join(key_array(day, site, kind), "|").alias("key_parts"),
    )
