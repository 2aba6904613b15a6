"""Documents: a keyed store, bulk records and an external index.

The store is a Parquet folder ``doc_day=.../batch=.../``. An upsert writes only
the latest rows of its own batch, so its cost is that of the batch, never of the
store. Readers take the latest row per key over all batches: by time, then by the
sequence of the batches. Late rows cannot replace newer ones, a correction for the
same time replaces what it corrects, and a batch that is written again under its
name changes nothing. ``compact`` writes the merged view as a new store, to
bound the read cost.
"""

import re
import time
from collections.abc import Callable, Iterator
from itertools import islice
from urllib.parse import unquote

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.latest import latest_per_key
from ..operators.rows import quoted
from ..schemas import DATE, DOC_ID, END, START
from ..workspace import workspace
from .layers import write_layer

DAY_FOLDER = "doc_day"
BATCH_FOLDER = "batch"
SEQUENCE = "_sequence"  # of the batch a stored row came with
NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name for a NULL day
FOLDER_FIELDS = [T.StructField(DAY_FOLDER, T.StringType()), T.StructField(BATCH_FOLDER, T.StringType())]
NEWEST = (START, END)


def _write(rows: DataFrame, root: str, batch: str) -> None:
    folders = {DAY_FOLDER: F.col(DATE), BATCH_FOLDER: F.lit(batch)}
    write_layer(rows.withColumns(folders), root, tuple(folders), (DOC_ID,), touched_only=True)


def _sequence_of(spark: SparkSession, root: str, batch: str) -> int:
    """The sequence that a batch was first written with; a new one is later than all before."""
    try:
        stored = spark.read.option("mergeSchema", True).parquet(root)
    except AnalysisException:  # nothing is stored yet
        return time.time_ns() // 1000
    if SEQUENCE not in stored.columns:
        return time.time_ns() // 1000
    own = F.min(F.when(F.col(BATCH_FOLDER).cast("string") == batch, F.col(SEQUENCE)))
    first, last = stored.agg(own, F.max(SEQUENCE)).first()
    return first if first is not None else max((last or 0) + 1, time.time_ns() // 1000)


def upsert(docs: DataFrame, root: str, batch: str, order=NEWEST, sequence: int | None = None) -> None:
    """Insert or replace whole documents by ``doc_id``.

    Of rows with the same time the one of the later batch counts, so a corrected
    value replaces the old one whichever is greater. ``sequence`` orders the
    batches; without it a batch keeps the sequence it was first written with, and a
    new one comes last, so a batch that is replayed does not undo a later one.
    """
    number = sequence if sequence is not None else _sequence_of(docs.sparkSession, root, batch)
    rows = latest_per_key(docs, [DOC_ID], list(order))
    _write(rows.withColumn(SEQUENCE, F.lit(number).cast("long")), root, batch)


def _stored(spark: SparkSession, root: str, order, days, schema: T.StructType | None) -> DataFrame:
    """The current row per key, with its sequence.

    A day with one batch has one row per key already; it passes without a shuffle.
    """
    reader = spark.read.option("mergeSchema", True)
    if schema is not None:
        fields = [*schema.fields, T.StructField(SEQUENCE, T.LongType()), *FOLDER_FIELDS]
        reader = spark.read.schema(T.StructType(fields))
    rows = reader.parquet(root)
    if days is not None:
        rows = rows.where(F.col(DAY_FOLDER).cast("string").isin([str(d) for d in days]))
    batches: dict[str, set[str]] = {}
    for path in rows.inputFiles():
        day, batch = re.search(rf"/{DAY_FOLDER}=([^/]*)/{BATCH_FOLDER}=([^/]*)/", path).groups()
        batches.setdefault(unquote(day), set()).add(batch)
    several = [day for day, found in batches.items() if len(found) > 1]
    merged = F.coalesce(F.col(DAY_FOLDER).cast("string"), F.lit(NO_DAY)).isin(several)
    plain = [c for c in rows.columns if c not in (DAY_FOLDER, BATCH_FOLDER)]
    alone = rows.where(~merged).select(*[quoted(c) for c in plain])
    if not several:
        return alone
    together = rows.where(merged).select(*[quoted(c) for c in plain])
    return alone.unionByName(latest_per_key(together, [DOC_ID], [*order, SEQUENCE]))


def read_documents(
    spark: SparkSession, root: str, order=NEWEST, days=None, schema: T.StructType | None = None
) -> DataFrame:
    """The current document per key; with ``days`` only those folders are read.

    A key's day is part of the document, so a key lives in one day folder. Columns
    that a later batch added are NULL in earlier rows. Give the ``schema`` of the
    documents where the store may still be empty.
    """
    return _stored(spark, root, order, days, schema).drop(SEQUENCE)


def compact(spark: SparkSession, root: str, target: str, order=NEWEST) -> None:
    """Write the merged view of ``root`` as a new store of one batch; rows keep their sequence."""
    _write(_stored(spark, root, order, None, None), target, "compacted")


def append(docs: DataFrame, path: str) -> None:
    """Add documents under ids of their own: no key, nothing replaced."""
    docs.withColumn(DOC_ID, F.uuid()).write.mode("append").parquet(path)


def body_json(df: DataFrame) -> Column:
    """The row as a JSON document, without its id."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != DOC_ID]))


def bulk_lines(docs: DataFrame, index: str, id_column: str = DOC_ID) -> DataFrame:
    """Bulk payload: for each document an action line (0) and the document line (1)."""
    action = F.to_json(
        F.struct(
            F.struct(F.lit(index).alias("_index"), F.col(id_column).alias("_id")).alias("index")
        )
    )
    lines = F.posexplode(F.array(action, body_json(docs))).alias("part", "line")
    return docs.select(F.col(id_column), lines)


def write_bulk(docs: DataFrame, path: str, index: str) -> None:
    """Write the bulk payload as text; the two lines of a document stay adjacent."""
    bulk_lines(docs, index).select("line").write.mode("overwrite").text(path)


def publish(
    docs: DataFrame,
    send: Callable[[list[tuple[str, str]]], list[str | None]],
    chunk: int = 500,
    writers: int | None = None,
) -> DataFrame:
    """Send every document to an external index from the tasks that hold them.

    ``send`` takes ``(id, json)`` pairs and returns an error text or None for
    each. All is sent when this is called, once, whatever is done with the result,
    which lists what the index refused, read from the shared folder. Index
    operations replace by id, so a retried task does no harm. ``writers`` bounds
    how many tasks send at once.
    """
    pairs = docs.select(F.col(DOC_ID), body_json(docs).alias("body"))
    if writers is not None:
        pairs = pairs.repartition(writers)

    def send_all(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = zip(frame[DOC_ID], frame["body"])
            while some := list(islice(rows, chunk)):
                errors = send(some)
                refused = [(key, e) for (key, _), e in zip(some, errors) if e is not None]
                yield pd.DataFrame(refused, columns=[DOC_ID, "error"], dtype=object)

    refused = pairs.mapInPandas(send_all, f"{DOC_ID} string, error string")
    path = workspace(docs.sparkSession, "refused")
    refused.write.parquet(path)
    return docs.sparkSession.read.schema(refused.schema).parquet(path)


def write_index(docs: DataFrame, format: str, **options: str) -> None:
    """Write through an index connector present on the session's class path."""
    docs.write.format(format).options(**options).mode("append").save()
