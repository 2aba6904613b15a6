"""The driver's tables seen as measurements, stations and documents.

``events`` plays the measurements: the user is the site, the event type the
pollutant. ``customer`` (or, so that some sites have no station, the smaller
``supplier``) plays the station list. The tables have no gaps, so NULLs and bad
text are put in by rule, in the same way here and in the SQL.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import (
    DATE, DOC_ID, END, INFLUENCE, LATITUDE, LONGITUDE, POLLUTANT, RAW_VALUE, SETTING, SITE,
    SITE_NAME, START, STATION_CODE, STATION_NAME, UNIT, VALIDITY, VALUE, ZONE, ZONE_CODE,
)
from ..functions.keys import document_key
from ..operators.rows import quoted

SETTINGS = ("Urbaine", "Périurbaine", "Rurale")
INFLUENCES = ("Fond", "Trafic", "Industrielle")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _nth(names, index):
    return F.element_at(F.array(*map(F.lit, names)), (index + 1).cast("int"))


def as_measurements(events: DataFrame) -> DataFrame:
    """Typed measurements with gaps in both values; ``event_id`` is a further column."""
    event, user = F.col("event_id"), F.col("user_id")
    return events.select(
        event,
        F.col("ts").alias(START),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias(END),
        F.concat(F.lit("Z"), user % 18).alias(ZONE_CODE),
        F.concat(F.lit("ZAG "), user % 18).alias(ZONE),
        F.concat(F.lit("FR"), user).alias(SITE),
        F.concat(F.lit("SITE "), user).alias(SITE_NAME),
        _nth(SETTINGS, user % 3).alias(SETTING),
        F.col("event_type").alias(POLLUTANT),
        _nth(INFLUENCES, user % 3).alias(INFLUENCE),
        F.when(event % 7 != 0, F.col("value")).alias(VALUE),
        F.when(event % 11 != 0, F.col("value")).alias(RAW_VALUE),
        F.lit("µg-m3").alias(UNIT),
        F.when(event % 13 == 0, -1).otherwise(1).alias(VALIDITY),
    )


MEASUREMENTS = """
    SELECT event_id, ts AS "Date de début", ts + INTERVAL 1 HOUR AS "Date de fin",
        'Z' || (user_id % 18) AS "code zas", 'ZAG ' || (user_id % 18) AS "Zas",
        'FR' || user_id AS "code site", 'SITE ' || user_id AS "nom site",
        CASE user_id % 3 WHEN 0 THEN 'Urbaine' WHEN 1 THEN 'Périurbaine' ELSE 'Rurale' END
            AS "type d'implantation",
        event_type AS "Polluant",
        CASE user_id % 3 WHEN 0 THEN 'Fond' WHEN 1 THEN 'Trafic' ELSE 'Industrielle' END
            AS "type d'influence",
        CASE WHEN event_id % 7 <> 0 THEN value END AS "valeur",
        CASE WHEN event_id % 11 <> 0 THEN value END AS "valeur brute",
        'µg-m3' AS "unité de mesure",
        CAST(CASE WHEN event_id % 13 = 0 THEN -1 ELSE 1 END AS INTEGER) AS "validité"
    FROM events
"""

# Start and end as ISO text, as the queries below give them.
ISO_TIMES = """
    strftime("Date de début", '%Y-%m-%dT%H:%M:%S') AS "Date de début",
    strftime("Date de fin", '%Y-%m-%dT%H:%M:%S') AS "Date de fin"
"""
OTHER_COLUMNS = """
    "code zas", "Zas", "code site", "nom site", "type d'implantation", "Polluant",
    "type d'influence", "valeur", "valeur brute", "unité de mesure", "validité"
"""


def measurements(spark: SparkSession, folder: str) -> DataFrame:
    return as_measurements(table(spark, folder, "events"))


def landed(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements as landed: times are text, in two formats, some unreadable."""
    slashes = F.date_format(quoted(START), "yyyy/MM/dd HH:mm:ss")
    dashes = F.date_format(quoted(START), "yyyy-MM-dd'T'HH:mm:ss")
    return measurements(spark, folder).withColumns(
        {
            START: F.when(F.col("event_id") % 19 == 0, F.lit("n/a"))
            .when(F.col("event_id") % 2 == 0, slashes)
            .otherwise(dashes),
            END: F.date_format(quoted(END), "yyyy-MM-dd HH:mm:ss"),
        }
    )


def _as_stations(df: DataFrame, code: str, name: str, nation: str, number: str) -> DataFrame:
    return df.select(
        F.concat(F.lit("N"), F.col(nation)).alias("nuts3"),
        F.lit("N").alias("nuts2"),
        F.concat(F.lit("FR"), F.col(code)).alias(STATION_CODE),
        F.col(name).alias(STATION_NAME),
        F.when(F.col(code) % 17 != 0, F.lit(40.0) + F.col(nation) / F.lit(2.0)).alias(LATITUDE),
        F.col(number).alias(LONGITUDE),
    )


def stations(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as stations, some without a latitude."""
    customer = table(spark, folder, "customer")
    return _as_stations(customer, "c_custkey", "c_name", "c_nationkey", "c_acctbal")


def few_stations(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as stations: many sites are missing among them."""
    supplier = table(spark, folder, "supplier")
    return _as_stations(supplier, "s_suppkey", "s_name", "s_nationkey", "s_acctbal")


def _stations_sql(source, code, name, nation, number):
    return f"""
    SELECT 'N' || {nation} AS nuts3, 'N' AS nuts2, 'FR' || {code} AS "NatlStationCode",
        {name} AS "Name",
        CASE WHEN {code} % 17 <> 0 THEN 40.0::DOUBLE + {nation} / 2.0::DOUBLE END AS "Latitude",
        {number} AS "Longitude"
    FROM {source}
"""


STATIONS = _stations_sql("customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal")
FEW_STATIONS = _stations_sql("supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")


def as_documents(events: DataFrame) -> DataFrame:
    """Readings as keyed documents, one key per day, site and pollutant."""
    day, site = F.date_format("ts", "yyyy-MM-dd"), F.concat(F.lit("FR"), F.col("user_id"))
    return events.select(
        document_key(day, site, F.col("event_type")).alias(DOC_ID),
        day.alias(DATE),
        F.col("ts").alias(START),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias(END),
        site.alias(SITE),
        F.col("event_type").alias(POLLUTANT),
        F.col("value").alias(VALUE),
        "event_id",
    )


LATEST_DOCUMENTS = """
    WITH docs AS (
        SELECT strftime(ts, '%Y-%m-%d') || '_FR' || user_id || '_' || event_type AS doc_id,
            strftime(ts, '%Y-%m-%d') AS date, ts, event_id, value,
            'FR' || user_id AS site, event_type
        FROM events)
    SELECT doc_id, date, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "Date de début",
        site AS "code site", event_type AS "Polluant", value AS "valeur", event_id
    FROM docs
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY ts DESC, value DESC, event_id DESC) = 1
"""
