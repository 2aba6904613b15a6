"""Files: scans, layers, partitions, wide tables and the whole chain."""

from pyspark.sql import functions as F, types as T

from ..functions.paths import partition_value
from ..operators.rows import quoted
from ..operators.stations import station_table
from ..plans import layers, tables
from ..schemas import (
    DATE, GPS, POLLUTANT, POLLUTANT_COPY, START, VALUE, measurement_schema,
)
from ..sinks import versions
from ..sinks.documents import read_documents
from ..sinks.layers import write_delimited, write_layer
from ..sources.listing import has_files, list_files
from ..sources.payloads import read_payload
from ..sources.tables import read_delimited, read_parquet, split_json_payload
from ..sources.wide import read_notes, read_wide_long
from ..streaming.landing import landed_files, stream_upsert
from ..workspace import workspace
from .registry import query
from .rows import iso
from .tables import (
    ISO_TIMES, MEASUREMENTS, OTHER_COLUMNS, STATIONS,
    landed, measurements, stations, table,
)

LANDED_START = """CASE WHEN event_id % 19 = 0 THEN 'n/a'
    WHEN event_id % 2 = 0 THEN strftime("Date de début", '%Y/%m/%d %H:%M:%S')
    ELSE strftime("Date de début", '%Y-%m-%dT%H:%M:%S') END AS "Date de début" """
CLEAN = '"valeur" IS NOT NULL AND "valeur brute" IS NOT NULL'


@query(
    "scan_delimited",
    f"""WITH m AS ({MEASUREMENTS}) SELECT {LANDED_START},
        strftime("Date de fin", '%Y-%m-%d %H:%M:%S') AS "Date de fin", {OTHER_COLUMNS} FROM m""",
)
def scan_delimited(spark, folder):
    """The file has one column more than is asked for."""
    path = workspace(spark, "landed")
    write_delimited(landed(spark, folder), path, sep=";")
    return read_delimited(spark, path, measurement_schema())


@query(
    "csv_roundtrip",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, user_id, event_type, value, props
    FROM events""",
)
def csv_roundtrip(spark, folder):
    events = table(spark, folder, "events")
    path = workspace(spark, "events")
    write_delimited(events, path)
    read = read_delimited(spark, path, events.schema, sep=",")
    return read.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


@query(
    "documents_csv_roundtrip",
    r"""SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN '  ' || text || ' ' WHEN 1 THEN '' WHEN 2 THEN NULL
        WHEN 3 THEN '"' || text || '", x' WHEN 4 THEN '\' || text || '\"'
        ELSE text || chr(10) || 'next' END AS text FROM documents""",
)
def documents_csv_roundtrip(spark, folder):
    """Free text: padded, empty, NULL, quoted, back-slashed and of several lines."""
    text, rest = F.col("text"), F.pmod("doc_id", F.lit(6))
    changed = (
        F.when(rest == 0, F.concat(F.lit("  "), text, F.lit(" ")))
        .when(rest == 1, "")
        .when(rest == 3, F.concat(F.lit('"'), text, F.lit('", x')))
        .when(rest == 4, F.concat(F.lit("\\"), text, F.lit('\\"')))
        .when(rest == 5, F.concat(text, F.lit("\nnext")))
    )
    documents = table(spark, folder, "documents").select("doc_id", changed.alias("text"))
    path = workspace(spark, "texts")
    write_delimited(documents, path)
    return read_delimited(spark, path, documents.schema, sep=",", multiline=True)


@query(
    "json_to_table",
    """SELECT event_id, 'reading' AS kind, value::VARCHAR AS content FROM events WHERE event_id % 50 <> 0
    UNION ALL SELECT event_id, 'site', user_id::VARCHAR FROM events WHERE event_id % 50 <> 0
    UNION ALL SELECT NULL, 'reject', '[{"event_i' FROM events WHERE event_id % 50 = 0""",
)
def json_to_table(spark, folder):
    """Each landed reply is an array of two records; some are broken off, and are rejects."""
    event = F.col("event_id")

    def record(kind, content):
        return F.struct(event, F.lit(kind).alias("kind"), content.cast("string").alias("content"))

    reply = F.to_json(
        F.array(record("reading", F.col("value")), record("site", F.col("user_id")))
    )
    broken = F.when(event % 50 == 0, F.left(reply, F.lit(10))).otherwise(reply)
    path, target = workspace(spark, "replies"), workspace(spark, "table")
    table(spark, folder, "events").select(broken).write.text(path)
    schema = T.DataType.fromDDL("event_id bigint, kind string, content string")
    rows, rejects = split_json_payload(spark, path, schema)
    write_delimited(rows, target)
    return read_delimited(spark, target, schema, sep=",", multiline=True).unionByName(
        rejects.select(
            F.lit(None).cast("bigint").alias("event_id"),
            F.lit("reject").alias("kind"),
            F.col("reply").alias("content"),
        )
    )


@query(
    "json_shapes",
    """SELECT event_id, CASE WHEN event_id % 6 <> 5 THEN value END AS value,
        CASE WHEN event_id % 6 = 1 THEN 'late' END AS note, NULL AS reason FROM events
    WHERE event_id % 6 IN (0, 1, 2, 5)
    UNION ALL SELECT NULL, NULL, CASE event_id % 6 WHEN 3 THEN 'object' ELSE '{"event_i' END,
        CASE event_id % 6 WHEN 3 THEN 'value is no double' ELSE 'no JSON' END
    FROM events WHERE event_id % 6 IN (3, 4)""",
)
def json_shapes(spark, folder):
    """Replies of shapes that are not told beforehand: arrays and single objects, a further field, a number as
    text, an object in place of a number, a broken reply, a field that is null."""
    event, value, rest = F.col("event_id"), F.col("value"), F.col("event_id") % 6

    def reply(*fields):
        return F.to_json(F.struct(event, *fields))

    text = (
        F.when(rest == 0, F.concat(F.lit("["), reply(value), F.lit("]")))
        .when(rest == 1, reply(value, F.lit("late").alias("note")))
        .when(rest == 2, reply(value.cast("string").alias("value")))
        .when(rest == 3, reply(F.struct(value.alias("amount")).alias("value")))
        .when(rest == 4, F.left(reply(value), F.lit(9)))
        .otherwise(F.concat(F.lit('{"event_id":'), event, F.lit(',"value":null}')))
    )
    path = workspace(spark, "replies")
    table(spark, folder, "events").select(text).write.text(path)
    rows, rejects = read_payload(spark, path)
    kind = F.when(F.col("reason") == "no JSON", F.col("text")).otherwise(
        F.when(F.col("text").contains('"amount"'), "object")
    )
    return rows.select("event_id", "value", "note", F.lit(None).cast("string").alias("reason")).unionByName(
        rejects.select(
            F.lit(None).cast("bigint").alias("event_id"), F.lit(None).cast("double").alias("value"),
            kind.alias("note"), "reason",
        )
    )


@query(
    "scan_with_schema",
    """SELECT o_orderkey, o_totalprice, o_orderpriority, NULL::VARCHAR AS o_note
    FROM orders WHERE o_totalprice > 100000""",
)
def scan_with_schema(spark, folder):
    """The caller's schema rules: a column that the file lacks reads as NULL."""
    schema = T.DataType.fromDDL(
        "o_orderkey bigint, o_totalprice double, o_orderpriority string, o_note string"
    )
    orders = read_parquet(spark, f"{folder}/orders.parquet", schema=schema)
    return orders.where(F.col("o_totalprice") > 100000)


@query(
    "file_manifest",
    """SELECT DISTINCT event_type AS "Polluant", media_type, true AS has_bytes, true AS has_csv,
        false AS has_zip, false AS elsewhere
    FROM events, (VALUES ('application/csv'), ('application/json'), ('text/plain')) f(media_type)""",
)
def file_manifest(spark, folder):
    """Delimited, JSON and Parquet files, and whether there are files of a kind or at all."""
    path, events = workspace(spark, "manifest"), table(spark, folder, "events")
    write_delimited(events, f"{path}/delimited", folders=("event_type",))
    events.write.partitionBy("event_type").json(f"{path}/json")
    events.write.partitionBy("event_type").parquet(f"{path}/parquet")
    return (
        list_files(spark, path)
        .groupBy(partition_value(F.col("path"), "event_type").alias(POLLUTANT), "media_type")
        .agg((F.sum("length") > 0).alias("has_bytes"))
        .withColumn("has_csv", F.lit(has_files(spark, path, ".csv")))
        .withColumn("has_zip", F.lit(has_files(spark, path, ".zip")))
        .withColumn("elsewhere", F.lit(has_files(spark, f"{path}/none")))
    )


def _write_cleaned(spark, folder):
    path = workspace(spark, "L1")
    layers.store_cleaned(layers.clean(measurements(spark, folder)), path)
    return path


LAYER = f"""WITH m AS ({MEASUREMENTS})
    SELECT {ISO_TIMES}, {OTHER_COLUMNS}, "Polluant" AS "Polluant_copy" FROM m WHERE {CLEAN}"""


@query("l1_roundtrip", LAYER)
def l1_roundtrip(spark, folder):
    return iso(read_parquet(spark, _write_cleaned(spark, folder)))


@query("l1_prune_one", LAYER + """ AND "Polluant" IN ('click', 'view')""")
def l1_prune_one(spark, folder):
    """Two folders read by path; the root brings the folder column back."""
    root = _write_cleaned(spark, folder)
    paths = [f"{root}/{POLLUTANT}={kind}" for kind in ("click", "view")]
    return iso(read_parquet(spark, *paths, root=root))


@query(
    "partition_from_path",
    f"""WITH m AS ({MEASUREMENTS}) SELECT "Polluant", "Polluant" AS "Polluant_copy",
        count(*) AS rows FROM m WHERE {CLEAN} GROUP BY ALL""",
)
def partition_from_path(spark, folder):
    cleaned = spark.read.option("recursiveFileLookup", True).parquet(_write_cleaned(spark, folder))
    pollutant = partition_value(F.col("_metadata.file_path"), POLLUTANT)
    return cleaned.groupBy(pollutant.alias(POLLUTANT), POLLUTANT_COPY).agg(
        F.count("*").alias("rows")
    )


@query(
    "partition_overwrite",
    f"""WITH m AS ({MEASUREMENTS}), d AS (SELECT strftime("Date de début", '%Y-%m-%d') AS date,
            event_id, "Polluant", "valeur" FROM m)
    SELECT date, event_id, "Polluant",
        CASE WHEN date = '2024-01-10' THEN "valeur" * 2 ELSE "valeur" END AS "valeur" FROM d""",
)
def partition_overwrite(spark, folder):
    """A day is written again with other values; the other days stay."""
    path = workspace(spark, "L2")
    day = F.date_format(quoted(START), "yyyy-MM-dd")
    readings = measurements(spark, folder).select(
        day.alias(DATE), "event_id", quoted(POLLUTANT), quoted(VALUE)
    )
    write_layer(readings, path, (DATE, POLLUTANT), ("event_id",), touched_only=True)
    again = readings.where(F.col(DATE) == "2024-01-10").withColumn(VALUE, F.col(VALUE) * 2)
    write_layer(again, path, (DATE, POLLUTANT), ("event_id",), touched_only=True)
    return read_parquet(spark, path, schema=readings.schema)


DOCUMENT_COLUMNS = """doc_id, strftime(start, '%Y-%m-%dT%H:%M:%S') AS "Date de début",
    strftime(start + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S') AS "Date de fin",
    "Zas", "code site", "Polluant", "valeur", "valeur brute", "validité", "Name", "Latitude",
    "Longitude", date, "Longitude" AS gps_first, "Latitude" AS gps_second"""


def _documents_sql(start, extra="", period="%Y-%m-%d"):
    return f"""WITH m AS ({MEASUREMENTS}), s AS ({STATIONS}),
    clean AS (SELECT {start} AS start, m.* FROM m WHERE {CLEAN} {extra}),
    joined AS (
        SELECT strftime(start, '%Y-%m-%d') AS date,
            strftime(start, '{period}') || '_' || "code site" || '_' || "Polluant" AS doc_id, *
        FROM clean JOIN s ON "code site" = "NatlStationCode" WHERE "Latitude" IS NOT NULL)
    SELECT {DOCUMENT_COLUMNS} FROM joined
    QUALIFY row_number() OVER (PARTITION BY doc_id
        ORDER BY start DESC, "valeur" DESC, "valeur brute" DESC, "validité" DESC) = 1"""


def _show_documents(docs):
    plain = [
        "doc_id", START, "Date de fin", "Zas", "code site", POLLUTANT, VALUE, "valeur brute",
        "validité", "Name", "Latitude", "Longitude", DATE,
    ]
    return docs.select(
        *[quoted(c) for c in plain],
        F.get(GPS, F.lit(0)).alias("gps_first"),
        F.get(GPS, F.lit(1)).alias("gps_second"),
    )


@query("latest_station_documents", _documents_sql('"Date de début"'))
def latest_station_documents(spark, folder):
    """The flagship: cleaned readings to the current document per key, in one plan."""
    cleaned = layers.clean(measurements(spark, folder))
    docs = layers.latest_documents(cleaned, station_table(stations(spark, folder)))
    return _show_documents(docs)


@query("hourly_station_documents", _documents_sql('"Date de début"', period="%Y-%m-%dT%H"))
def hourly_station_documents(spark, folder):
    """One document per hour instead of per day."""
    cleaned = layers.clean(measurements(spark, folder))
    known = station_table(stations(spark, folder))
    return _show_documents(layers.latest_documents(cleaned, known, grain="hour"))


@query(
    "raw_to_documents",
    _documents_sql("date_trunc('second', \"Date de début\")", "AND event_id % 19 <> 0"),
)
def raw_to_documents(spark, folder):
    """Every layer as files: landed text, cleaned, combined, document store."""
    work = workspace(spark, "chain")
    write_delimited(landed(spark, folder), f"{work}/raw", sep=";")
    write_delimited(stations(spark, folder), f"{work}/stations")
    docs = layers.raw_to_documents(spark, f"{work}/raw", f"{work}/stations", work)
    return _show_documents(docs)


def _landings_sql():
    """The documents of three landings, of which the third replaces a file of the first."""
    start = "date_trunc('second', \"Date de début\")"
    landings = f"""WITH m0 AS ({MEASUREMENTS}), m AS (
        SELECT *, event_id % 2 AS batch FROM m0
        UNION ALL SELECT * REPLACE ("valeur" + 1000 AS "valeur"), 2 FROM m0 WHERE event_id % 4 = 0)"""
    plain = _documents_sql(start, "AND event_id % 19 <> 0")
    return plain.replace(f"WITH m AS ({MEASUREMENTS})", landings).replace(
        "ORDER BY start DESC,", "ORDER BY start DESC, batch DESC,"
    )


@query("landing_increments", _landings_sql())
def landing_increments(spark, folder):
    """Three runs over a landing folder: each reads only what landed or changed; a fourth finds nothing."""
    work, raw = workspace(spark, "landings"), landed(spark, folder)
    write_delimited(stations(spark, folder), f"{work}/stations")
    event = F.col("event_id")
    changed = raw.where(event % 4 == 0).withColumn(VALUE, quoted(VALUE) + 1000)
    for name, rows in (("even", raw.where(event % 2 == 0)), ("odd", raw.where(event % 2 == 1)), ("even", changed)):
        write_delimited(rows, f"{work}/raw/{name}", sep=";")
        layers.new_files_to_documents(spark, f"{work}/raw", f"{work}/stations", work)
    if layers.new_files_to_documents(spark, f"{work}/raw", f"{work}/stations", work) is not None:
        raise ValueError("nothing new had landed")
    return _show_documents(versions.read_documents(spark, f"{work}/documents"))


@query(
    "stream_landed_documents",
    _documents_sql("date_trunc('second', \"Date de début\")", "AND event_id % 19 <> 0"),
)
def stream_landed_documents(spark, folder):
    """Landed text as a stream: each micro-batch is cleaned, joined and upserted.

    The files have a column more than is asked for, and another order of columns.
    """
    work = workspace(spark, "landing")
    raw = landed(spark, folder)
    write_delimited(raw.select(*[quoted(c) for c in reversed(raw.columns)]), f"{work}/raw", sep=";")
    known = station_table(stations(spark, folder))

    def prepare(batch):
        return layers.to_documents(layers.combine(layers.clean(batch), known))

    files = landed_files(spark, f"{work}/raw")
    stream_upsert(files, f"{work}/store", f"{work}/checkpoint", prepare).awaitTermination()
    return _show_documents(read_documents(spark, f"{work}/store"))


def _write_wide(spark, folder, some="true", names=None, path=None):
    """Hourly minimum per event type, below a block of header, name and note rows."""
    events = table(spark, folder, "events").where(some).withColumn(
        "value", F.when(F.col("event_id") % 97 == 0, -F.col("value")).otherwise(F.col("value"))
    )
    hourly = (
        events.groupBy(F.date_format("ts", "yyyy-MM-dd HH':00:00'").alias("time"))
        .pivot("event_type", names)
        .agg(F.min("value"))
    )
    names = hourly.columns[1:]

    body = hourly.select(
        F.lit(6).alias("line"), "time", *[quoted(n).cast("string").alias(n) for n in names]
    )

    def line(number, time, cells):
        return spark.createDataFrame([(number, time, *cells)], body.schema)

    def note(number, time, figure):
        return (
            events.groupBy().pivot("event_type", names).agg(figure)
            .select(F.lit(number).alias("line"), F.lit(time).alias("time"),
                    *[quoted(n).cast("string").alias(n) for n in names])
        )

    lines = (
        body.unionByName(line(0, "station", [f"column {i}" for i, _ in enumerate(names)]))
        .unionByName(note(1, "readings", F.count("value")))
        .unionByName(line(2, "name", names))
        .unionByName(note(3, "lowest", F.min("value")))
        .unionByName(note(4, "highest", F.max("value")))
        .unionByName(line(5, "unit", ["µg-m3"] * len(names)))
    )
    # All lines above the body share one range key, so they stay in one file, the first.
    path = path or workspace(spark, "wide")
    (
        lines.repartitionByRange(F.when(F.col("line") == 6, F.col("time")))
        .sortWithinPartitions("line", "time")
        .drop("line")
        .write.csv(path)
    )
    return path


SIGNED = """WITH e AS (SELECT ts, event_type,
    CASE WHEN event_id % 97 = 0 THEN -value ELSE value END AS value FROM events)"""
KINDS = ("click", "error", "purchase", "signup", "view")


def _per_kind(figure, text=False):
    cast = "::VARCHAR" if text else ""
    return ", ".join(
        f"({figure}(value) FILTER (event_type = '{k}')){cast} AS \"{k}\"" for k in KINDS
    )


@query(
    "promote_header",
    f"""{SIGNED}, w AS (SELECT strftime(ts, '%Y-%m-%d %H:00:00') AS time, {_per_kind('min')}
        FROM e GROUP BY 1)
    SELECT * FROM w WHERE {' AND '.join(f'"{k}" >= 0' for k in KINDS)}""",
)
def promote_header(spark, folder):
    return tables.clean_wide_table(spark, _write_wide(spark, folder))


@query(
    "wide_layer",
    f"""{SIGNED}, w AS (SELECT strftime(ts, '%Y-%m-%d %H:00:00') AS time, {_per_kind('min')}
        FROM e GROUP BY 1)
    SELECT * FROM w WHERE {' AND '.join(f'"{k}" >= 0' for k in KINDS)}""",
)
def wide_layer(spark, folder):
    """The cleaned wide table as a file, read back by its new header."""
    target = workspace(spark, "wide-clean")
    tables.store_wide_table(spark, _write_wide(spark, folder), target)
    doubles = [T.StructField(k, T.DoubleType()) for k in KINDS]
    schema = T.StructType([T.StructField("time", T.StringType()), *doubles])
    return read_delimited(spark, target, schema, sep=",")


# Deliveries by day, with the event types in the order of their columns.
WIDE_FILES = {0: list(KINDS), 1: ["view", "signup", "click", "purchase", "error"], 2: ["purchase", "click", "view"]}


def _write_wide_files(spark, folder, deliveries=WIDE_FILES):
    """A folder of wide files per delivery; gives a pattern for all of them."""
    path = workspace(spark, "wide-files")
    for rest, names in deliveries.items():
        some = (F.dayofyear("ts") % len(deliveries) == rest) & F.col("event_type").isin(names)
        _write_wide(spark, folder, some, names, f"{path}/delivery{rest}")
    return f"{path}/*"


@query(
    "wide_many_files",
    f"""{SIGNED}, w AS (SELECT strftime(ts, '%Y-%m-%d %H:00:00') AS time, {_per_kind('min')}
        FROM e GROUP BY 1)
    SELECT * FROM w WHERE {' AND '.join(f'"{k}" >= 0' for k in KINDS)}""",
)
def wide_many_files(spark, folder):
    """Two deliveries with the stations in different orders, each in several files."""
    both = {0: WIDE_FILES[0], 1: WIDE_FILES[1]}
    return tables.clean_wide_table(spark, _write_wide_files(spark, folder, both)).select("time", *KINDS)


def _long_sql():
    parts = []
    for rest, names in WIDE_FILES.items():
        listed = ", ".join(f"'{n}'" for n in names)
        parts.append(
            f"""SELECT strftime(ts, '%Y-%m-%d %H:00:00') AS time, event_type AS station, min(value) AS value
            FROM e WHERE dayofyear(ts) % {len(WIDE_FILES)} = {rest} AND event_type IN ({listed}) GROUP BY 1, 2
            QUALIFY count(*) OVER (PARTITION BY time) = {len(names)} AND min(min(value)) OVER (PARTITION BY time) >= 0"""
        )
    return f"{SIGNED} " + " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


@query("wide_to_long", _long_sql())
def wide_to_long(spark, folder):
    """Three deliveries, the third without two of the stations, unpivoted by the names of each file."""
    return read_wide_long(spark, _write_wide_files(spark, folder), complete=True)


@query(
    "station_layer",
    f"""WITH s AS ({STATIONS})
    SELECT "NatlStationCode", "Name", "Latitude", "Longitude",
        '(' || "Latitude" || ', ' || "Longitude" || ')' AS "GPS" FROM s""",
)
def station_layer(spark, folder):
    """The station list as landed, then the station table as a file."""
    path, target = workspace(spark, "station-list"), workspace(spark, "stations")
    write_delimited(stations(spark, folder), path)
    tables.store_stations(spark, path, target)
    schema = station_table(stations(spark, folder)).schema
    return read_delimited(spark, target, schema, sep=",")


@query(
    "map_layer",
    """SELECT c_custkey AS region, 'POLYGON ((' || c_nationkey || ' ' || c_custkey || ', '
        || (c_nationkey + 4) || ' ' || c_custkey || '.5, ' || c_nationkey || ' ' || c_custkey
        || '))' AS geometry FROM customer""",
)
def map_layer(spark, folder):
    """Region outlines as rings in Parquet, then as WKT in delimited text."""
    path, target = workspace(spark, "shapes"), workspace(spark, "map")
    x, y = F.col("c_nationkey").cast("double"), F.col("c_custkey").cast("double")
    corners = [(x, y), (x + 4, y + 0.5), (x, y)]
    ring = F.array(*[F.struct(a.alias("x"), b.alias("y")) for a, b in corners])
    table(spark, folder, "customer").select(
        F.col("c_custkey").alias("region"), F.array(ring).alias("rings")
    ).write.parquet(path)
    tables.store_map(spark, path, target)
    schema = T.DataType.fromDDL("region bigint, geometry string")
    return read_delimited(spark, target, schema, sep=",")


@query(
    "metadata_rows",
    f"""{SIGNED}
    SELECT 0::INTEGER AS position, 'readings' AS time, {_per_kind('count', True)} FROM e
    UNION ALL SELECT 1, 'lowest', {_per_kind('min', True)} FROM e
    UNION ALL SELECT 2, 'highest', {_per_kind('max', True)} FROM e
    UNION ALL SELECT 3, 'unit', {', '.join("'µg-m3'" for _ in KINDS)}""",
)
def metadata_rows(spark, folder):
    return read_notes(spark, _write_wide(spark, folder))
