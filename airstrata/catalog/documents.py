"""Document store, bulk records and the streaming upsert."""

from pyspark.sql import functions as F

from ..functions.times import iso_text
from ..operators.latest import latest_per_key
from ..operators.rows import quoted, split_rejects
from ..schemas import DATE, DOC_ID, END, POLLUTANT, SITE, START, VALUE
from ..sinks import documents
from ..streaming.landing import landed_files, stream_upsert
from ..workspace import workspace
from .registry import query
from .tables import LATEST_DOCUMENTS, as_documents, table


def _readings(spark, folder):
    return as_documents(table(spark, folder, "events"))


def _show(docs):
    return docs.withColumn(START, iso_text(quoted(START))).select(
        *[quoted(c) for c in (DOC_ID, DATE, START, SITE, POLLUTANT, VALUE, "event_id")]
    )


def _deliveries(docs):
    """The readings in two deliveries that share most of their keys."""
    first = F.col("event_id") % 2 == 0
    return docs.where(first), docs.where(~first)


@query("upsert_latest", LATEST_DOCUMENTS)
def upsert_latest(spark, folder):
    return _show(latest_per_key(_readings(spark, folder), [DOC_ID], [START, END]))


@query("merge_index", LATEST_DOCUMENTS)
def merge_index(spark, folder):
    """Two deliveries, the newer first and one of them twice, leave the latest rows."""
    root = workspace(spark, "store")
    first, second = _deliveries(_readings(spark, folder))
    documents.upsert(second, root, "second")
    documents.upsert(first, root, "first")
    documents.upsert(second, root, "second")
    return _show(documents.read_documents(spark, root))


@query(
    "merge_corrections",
    """WITH r AS (SELECT *, 0 AS batch FROM events
        UNION ALL SELECT * REPLACE (value - 1000 AS value), 1 FROM events WHERE event_id % 3 = 0)
    SELECT strftime(ts, '%Y-%m-%d') || '_FR' || user_id || '_' || event_type AS doc_id,
        strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "Date de début",
        'FR' || user_id AS "code site", event_type AS "Polluant", value AS "valeur", event_id FROM r
    QUALIFY row_number() OVER (PARTITION BY doc_id
        ORDER BY ts DESC, batch DESC, value DESC, event_id DESC) = 1""",
)
def merge_corrections(spark, folder):
    """A second delivery lowers some readings; the first, sent again, does not undo that."""
    root = workspace(spark, "store")
    first = _readings(spark, folder)
    second = first.where(F.col("event_id") % 3 == 0).withColumn(VALUE, F.col(VALUE) - 1000)
    for name, delivery in (("first", first), ("second", second), ("first", first)):
        documents.upsert(delivery, root, name)
    return _show(documents.read_documents(spark, root))


@query("compact_index", LATEST_DOCUMENTS)
def compact_index(spark, folder):
    root, target = workspace(spark, "store"), workspace(spark, "compacted")
    for name, delivery in zip(("first", "second"), _deliveries(_readings(spark, folder))):
        documents.upsert(delivery, root, name)
    documents.compact(spark, root, target)
    return _show(documents.read_documents(spark, target))


@query(
    "append_documents",
    """SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "Date de début", 'FR' || user_id AS "code site",
        event_type AS "Polluant", value AS "valeur", event_id, 36 AS id_length FROM events""",
)
def append_documents(spark, folder):
    path = workspace(spark, "appended")
    for delivery in _deliveries(_readings(spark, folder)):
        documents.append(delivery, path)
    stored = spark.read.parquet(path).withColumn("id_length", F.length(DOC_ID))
    return stored.withColumn(START, iso_text(quoted(START))).drop(DOC_ID, DATE, END)


BULK = f"""WITH latest AS ({LATEST_DOCUMENTS}), lines AS (
    SELECT doc_id, '{{"index":{{"_index":"readings","_id":"' || doc_id || '"}}}}' AS action,
        '{{"date":"' || date || '","Date de début":"' || "Date de début" || '","code site":"'
        || "code site" || '","Polluant":"' || "Polluant" || '","valeur":' || "valeur"
        || ',"event_id":' || event_id || '}}' AS body
    FROM latest)
    SELECT doc_id, 0::INTEGER AS part, action AS line FROM lines
    UNION ALL SELECT doc_id, 1, body FROM lines"""


@query("bulk_actions", BULK)
def bulk_actions(spark, folder):
    return documents.bulk_lines(upsert_latest(spark, folder), "readings")


@query(
    "publish_refused",
    f"""SELECT doc_id, 'too high' AS error FROM ({LATEST_DOCUMENTS}) WHERE "valeur" > 100""",
)
def publish_refused(spark, folder):
    """What an index that takes no value above 100 would refuse, told before it is sent."""
    _, refused = split_rejects(upsert_latest(spark, folder), {"too high": F.col(VALUE) <= 100})
    return refused.select(DOC_ID, F.col("reason").alias("error"))


@query("stream_upsert", LATEST_DOCUMENTS)
def stream_events(spark, folder):
    """The event files as a stream into the store, then the store's current rows."""
    root, checkpoint = workspace(spark, "store"), workspace(spark, "stream")
    schema = table(spark, folder, "events").schema
    # A pattern, because the table may be a file or a folder of files.
    rows = landed_files(spark, f"{folder}/events.parque[t]", schema, "parquet")
    stream_upsert(rows, root, checkpoint, as_documents).awaitTermination()
    return _show(documents.read_documents(spark, root))
