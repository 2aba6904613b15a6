"""Incremental ingest of landed files into the document store."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.rows import quoted
from ..schemas import measurement_schema
from ..sinks.documents import NEWEST, upsert
from ..sources.tables import TEXT_FORMAT, header_schema


ARRIVED = "_arrived"


def landed_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    format: str = "csv",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream of files as they land; each file is read once per checkpoint.

    Columns of delimited files are picked by name: the header of the files that are
    there when the stream starts says where they stand (without any, they stand
    as in the schema), and a file with another header fails the stream.
    """
    wanted = schema or measurement_schema()
    reader = spark.readStream.format(format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if format != "csv":
        return reader.schema(wanted).load(path)
    stored = header_schema(spark.read.options(**TEXT_FORMAT, sep=";", header=True), path, wanted)
    rows = reader.options(**TEXT_FORMAT, sep=";", header=True, enforceSchema=False)
    return rows.schema(stored).load(path).select(*[quoted(name) for name in wanted.names])


def without_replays(rows: DataFrame, within: str = "2 days") -> DataFrame:
    """The stream's rows without those that already arrived ``within`` this time, whole rows compared.

    The watermark follows the time of arrival, not that of the reading: however late a reading
    is, it is never dropped for its age, and corrections differ from what they correct. State holds
    the rows that arrived within the time, whatever the length of the stream; a replay that
    comes later passes, and the store, which is idempotent, makes nothing of it. Use a state
    store on disk (RocksDB) where the rows of that time exceed the memory of the executors.
    """
    arrived = rows.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, within)
    return arrived.dropDuplicatesWithinWatermark(rows.columns).drop(ARRIVED)


def stream_upsert(
    rows: DataFrame,
    root: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    order=NEWEST,
    store: Callable = upsert,
) -> StreamingQuery:
    """Upsert every micro-batch into the store, then stop when the input is used up.

    ``prepare`` turns landed rows into documents. The stream's id, which lives in
    its checkpoint, and the micro-batch number name the batch in the store: one
    that is replayed after a failure overwrites its own folders and no others,
    so each file takes effect exactly once. ``store`` is the upsert of the plain store or of
    the one with versions.
    """

    def write(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        store(prepare(batch), root, f"{stream}-{number}", order)

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
