"""Versions of the document store, replays in a stream, the index of words, and commits to an index."""

from pyspark.sql import functions as F

from ..functions.times import iso_text
from ..operators import postings
from ..schemas import DOC_ID, VALUE
from ..sinks import index_source, versions
from ..streaming.landing import landed_files, stream_upsert, without_replays
from ..workspace import workspace
from .documents import BULK, _deliveries, _readings, _show, upsert_latest
from .registry import query
from .tables import LATEST_DOCUMENTS, as_documents, table
from .text import SEARCHED, _bm25_sql


@query("versions_compacted", LATEST_DOCUMENTS)
def versions_compacted(spark, folder):
    """Two deliveries, compaction between them and after; the first delivery, sent again, undoes nothing."""
    root = workspace(spark, "versions")
    first, second = _deliveries(_readings(spark, folder))
    versions.upsert(first.where("event_id % 4 = 0"), root, "first")
    versions.upsert(first.where("event_id % 4 = 2"), root, "second")
    versions.compact(spark, root)
    versions.upsert(second, root, "third")
    versions.upsert(first.where("event_id % 4 = 0"), root, "first")
    versions.compact(spark, root)
    return _show(versions.read_documents(spark, root))


@query("version_pinned", LATEST_DOCUMENTS.replace("FROM events", "FROM events WHERE event_id % 2 = 0"))
def version_pinned(spark, folder):
    """The version after the first delivery, read after a second one, a correction and compaction."""
    root = workspace(spark, "versions")
    first, second = _deliveries(_readings(spark, folder))
    version = versions.upsert(first, root, "first")
    versions.upsert(second, root, "second")
    versions.upsert(first.withColumn(VALUE, F.col(VALUE) - 1000), root, "third")
    versions.compact(spark, root)
    return _show(versions.read_documents(spark, root, version))


@query("stream_replays", LATEST_DOCUMENTS)
def stream_replays(spark, folder):
    """Events that land twice, in two files each: replays leave the stream before the store with versions."""
    work, events = workspace(spark, "replays"), table(spark, folder, "events")
    for _ in range(2):
        events.repartition(2, "event_id").write.mode("append").parquet(f"{work}/landed")
    rows = without_replays(landed_files(spark, f"{work}/landed", events.schema, "parquet", files_per_batch=2))
    stream_upsert(rows, f"{work}/store", f"{work}/checkpoint", as_documents, store=versions.upsert).awaitTermination()
    return _show(versions.read_documents(spark, f"{work}/store"))


@query(
    "stream_replays_rows",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS time, user_id, event_type, value, 1::BIGINT AS times
    FROM events""",
)
def stream_replays_rows(spark, folder):
    """How often each event that landed twice passes: once."""
    work, events = workspace(spark, "replays"), table(spark, folder, "events")
    for _ in range(2):
        events.write.mode("append").parquet(f"{work}/landed")
    rows = without_replays(landed_files(spark, f"{work}/landed", events.schema, "parquet", files_per_batch=1))
    passed = rows.writeStream.format("parquet").option("path", f"{work}/passed")
    passed = passed.option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True)
    passed.start().awaitTermination()
    stored = spark.read.schema(events.schema).parquet(f"{work}/passed")
    return stored.groupBy("event_id", iso_text(F.col("ts")).alias("time"), "user_id", "event_type", "value").agg(
        F.count("*").alias("times")
    )


QUESTIONS = {"first": SEARCHED, "second": "der la, und", "third": "licensed under gnu"}


def _question_sql(name: str) -> str:
    return f"SELECT '{name}' AS query, doc_id, score FROM ({_bm25_sql(*postings.query_words(QUESTIONS[name]))})"


@query("search_postings", " UNION ALL ".join(_question_sql(name) for name in QUESTIONS))
def search_postings(spark, folder):
    """Three searches in the kept index; a third of the documents came first with another text."""
    root, documents = workspace(spark, "postings"), table(spark, folder, "documents")
    late = F.col("doc_id") % 3 == 0
    draft = F.when(late, F.concat(F.lit("draft of "), F.left("text", F.lit(50)))).otherwise(F.col("text"))
    postings.add_documents(documents.withColumn("text", draft), root, 1, "doc_id", ["text", "source"])
    postings.add_documents(documents.where(late), root, 2, "doc_id", ["text", "source"])
    # Ties go by the id as text there, by number here; scores are told apart to six digits.
    found = postings.search(spark, root, QUESTIONS, k=10)
    return found.select("query", F.col("id").cast("bigint").alias("doc_id"), F.round("score", 6).alias("score"))


@query("index_write", f"SELECT doc_id, line AS body FROM ({BULK}) WHERE part = 1")
def index_write(spark, folder):
    """Every current document written by four tasks as one commit, and read as it was published."""
    path = workspace(spark, "index")
    index_source.write_documents(upsert_latest(spark, folder), path, writers=4)
    return index_source.read_published(spark, path).select(F.col("id").alias(DOC_ID), "body")
