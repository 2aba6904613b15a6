"""A document store with versions: snapshots, atomic commits, compaction while in use.

Below the store's folder, ``data/attempt=.../doc_day=.../`` holds files that never change,
``manifests/...`` one small table per version that lists the live folders, and ``log/N``
the name of version N's manifest. A version comes into being when its log file is renamed into place, which
fails if another writer was first; that writer's change is then taken over and the
commit tried again. So readers see a whole version or the one before, what a
failed job wrote is never listed, and a reader that holds a version is not disturbed by later ones.

The rename must be atomic and must not replace: so it is in HDFS and local folders, not in bare object stores.
"""

import json
import threading
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.latest import latest_per_key
from ..operators.rows import quoted
from ..schemas import DATE, DOC_ID
from .documents import DAY_FOLDER, NEWEST, NO_DAY, SEQUENCE
from .layers import write_layer

ATTEMPT = "attempt"
ENTRY = f"batch string, sequence long, {ATTEMPT} string, {DAY_FOLDER} string, rows long, fields string"
COMPACTED = "compacted-"
TRIES = 20
LOCK = threading.Lock()  # a local folder's rename looks before it moves


class Conflict(RuntimeError):
    """Another writer changed what this commit builds on."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of all versions, the last one the current."""
    files = _file_system(spark, root)
    log = _path(spark, f"{root}/log")
    if not files.exists(log):
        return []
    names = [status.getPath().getName() for status in files.listStatus(log)]
    return sorted(int(name) for name in names if name.isdigit())


def _claimed(spark: SparkSession, root: str, version: int, manifest: str) -> bool:
    """Make ``manifest`` the given version, unless another one is."""
    jvm, files = spark._jvm, _file_system(spark, root)
    draft = files.makeQualified(_path(spark, f"{root}/log/.{manifest}"))
    target = files.makeQualified(_path(spark, f"{root}/log/{version:012d}"))
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(manifest.encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    keep = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        with LOCK:
            context.rename(draft, target, keep)
    except Py4JJavaError as failed:
        if failed.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


def entries(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The manifest of a version, by default the current one: a row per batch and day.

    ``attempt`` is the folder of the rows, NULL for a batch whose rows compaction took over.
    """
    known = versions(spark, root)
    if version is None and not known:
        return spark.createDataFrame([], ENTRY)
    number = known[-1] if version is None else version
    if number not in known:
        raise ValueError(f"no version {number} of {root}")
    name = spark.read.text(f"{root}/log/{number:012d}").first()[0]
    return spark.read.schema(ENTRY).parquet(f"{root}/manifests/{name}")


def _commit(spark: SparkSession, root: str, change: Callable[[DataFrame], DataFrame]) -> int:
    """Apply ``change`` to the current entries as the next version; gives its number."""
    for _ in range(TRIES):
        known = versions(spark, root)
        base = known[-1] if known else 0
        name = uuid.uuid4().hex
        current = entries(spark, root, base) if base else entries(spark, root)
        change(current).hint("rebalance").write.parquet(f"{root}/manifests/{name}")
        if _claimed(spark, root, base + 1, name):
            return base + 1
    raise Conflict(f"{root} was changed by others {TRIES} times")


def _written(rows: DataFrame, root: str) -> DataFrame:
    """Write documents (with SEQUENCE) to a new folder; its entries: attempt, doc_day, rows, fields."""
    spark, attempt = rows.sparkSession, uuid.uuid4().hex
    folder = f"{root}/data/{ATTEMPT}={attempt}"
    write_layer(rows.withColumn(DAY_FOLDER, F.col(DATE)), folder, (DAY_FOLDER,), (DOC_ID,))
    day = T.StructField(DAY_FOLDER, T.StringType())
    stored = spark.read.schema(T.StructType([*rows.schema.fields, day])).parquet(folder)
    fields = T.StructType([f for f in rows.schema.fields if f.name != SEQUENCE]).json()
    return stored.groupBy(DAY_FOLDER).agg(F.count("*").alias("rows")).select(
        F.lit(attempt).alias(ATTEMPT), DAY_FOLDER, "rows", F.lit(fields).alias("fields")
    )


def upsert(docs: DataFrame, root: str, batch: str, order=NEWEST) -> int | None:
    """Insert or replace whole documents by ``doc_id``; gives the new version (None if ``docs`` is empty).

    Batches are ordered by the sequence that the manifest gives them: a new one comes last, one that is
    written again keeps its place, so a replay undoes nothing, also after its rows were compacted. Cost follows the batch and the
    manifest: nothing that is stored is read.
    """
    spark = docs.sparkSession
    rows = latest_per_key(docs, [DOC_ID], list(order)).withColumn(SEQUENCE, F.lit(None).cast("long"))
    added = _written(rows, root).collect()  # one row per day of the batch
    if not added:
        return None
    added = spark.createDataFrame([tuple(r) for r in added], f"{ATTEMPT} string, {DAY_FOLDER} string, rows long, fields string")

    def change(current: DataFrame) -> DataFrame:
        own = F.min(F.when(F.col("batch") == batch, F.col("sequence")))
        first, last = current.agg(own, F.max("sequence")).first()
        number = first if first is not None else (last or 0) + 1
        mine = added.select(F.lit(batch).alias("batch"), F.lit(number).cast("long").alias("sequence"), *added.columns)
        # A batch is replaced whole; what compaction took over of it stays where it is.
        return current.where((F.col("batch") != batch) | F.col(ATTEMPT).isNull()).unionByName(mine)

    return _commit(spark, root, change)


def _fields(live: list) -> list[T.StructField]:
    """The columns of all entries, in the order of the batches."""
    known: dict[str, T.StructField] = {}
    for text in dict.fromkeys(e["fields"] for e in sorted(live, key=lambda e: e["sequence"])):
        for field in T.StructType.fromJson(json.loads(text)).fields:
            if known.setdefault(field.name, field).dataType != field.dataType:
                raise ValueError(f"{field.name} is {known[field.name].dataType} and {field.dataType}")
    return [T.StructField(f.name, f.dataType, True) for f in known.values()]


def _merged(spark: SparkSession, root: str, listed: DataFrame, live: list, order, every: bool) -> DataFrame:
    """The current row per key of the ``live`` entries, with its sequence.

    Days with one entry have one row per key already and pass without a shuffle (with
    ``every`` unset they are left out).
    """
    fields = [*_fields(live), T.StructField(SEQUENCE, T.LongType())]
    folders = [T.StructField(c, T.StringType()) for c in (ATTEMPT, DAY_FOLDER)]
    reader = spark.read.schema(T.StructType([*fields, *folders])).option("basePath", f"{root}/data")
    days: dict[str | None, list] = {}
    for entry in live:
        days.setdefault(entry[DAY_FOLDER], []).append(entry)

    def paths(some: list) -> list[str]:
        return [f"{root}/data/{ATTEMPT}={e[ATTEMPT]}/{_day_folder(e[DAY_FOLDER])}" for e in some]

    plain = [quoted(f.name) for f in fields]
    alone = [e for found in days.values() if len(found) == 1 for e in found]
    several = [e for found in days.values() if len(found) > 1 for e in found]
    parts = []
    if alone and every:
        parts.append(reader.parquet(*paths(alone)).select(*plain))
    if several:
        known = listed.where(F.col(ATTEMPT).isNotNull()).select(ATTEMPT, F.col("sequence").alias("_own")).distinct()
        rows = reader.parquet(*paths(several)).join(known, ATTEMPT)
        rows = rows.withColumn(SEQUENCE, F.coalesce(SEQUENCE, "_own")).select(*plain)
        parts.append(latest_per_key(rows, [DOC_ID], [*order, SEQUENCE]))
    if not parts:
        return spark.createDataFrame([], T.StructType(fields))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _day_folder(day: str | None) -> str:
    """The folder's name as Spark writes it."""
    special = "\"#%'*/:=?\\\x7f{[]^"  # fixed value: what Spark escapes in folder names, besides control characters
    escaped = "".join(f"%{ord(c):02X}" if c in special or c < " " else c for c in day or "")
    return f"{DAY_FOLDER}={escaped or NO_DAY}"


def read_documents(
    spark: SparkSession, root: str, version: int | None = None, order=NEWEST, days=None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """The document per key as of a version, by default the current one.

    The version is settled when this is called: upserts and compaction that follow do not
    change the result. Only the folders of the version (of the given ``days``) are listed, and the list comes to the
    driver, one row per batch and day. Columns that a later batch added are NULL in
    earlier rows. Give the ``schema`` of the documents where the store may still be empty.
    """
    listed = entries(spark, root, version)
    live = listed.where(F.col(ATTEMPT).isNotNull())
    if days is not None:
        live = live.where(F.col(DAY_FOLDER).isin([str(d) for d in days]))
    live = live.collect()
    if not live:
        if schema is None:
            raise ValueError(f"{root} holds no documents")
        return spark.createDataFrame([], schema)
    return _merged(spark, root, listed, live, order, True).drop(SEQUENCE)


def compact(spark: SparkSession, root: str, order=NEWEST) -> int | None:
    """Fold the batches of every day that has several into one; gives the new version, None if there are none.

    Readers and upserts go on meanwhile: what was committed since is kept. Rows keep the sequence
    of their batch, and the manifest keeps the batches' names and sequences, so later corrections and replays
    work as before. If a batch that is being folded was itself written again meanwhile, ``Conflict`` is raised
    and nothing has changed.
    """
    listed = entries(spark, root)
    live = listed.where(F.col(ATTEMPT).isNotNull()).collect()
    days: dict[str | None, list] = {}
    for entry in live:
        days.setdefault(entry[DAY_FOLDER], []).append(entry)
    folded = [e for found in days.values() if len(found) > 1 for e in found]
    if not folded:
        return None
    rows = _merged(spark, root, listed, folded, order, False)
    added = _written(rows, root)
    old = spark.createDataFrame([(e[ATTEMPT], e[DAY_FOLDER]) for e in folded], f"{ATTEMPT} string, {DAY_FOLDER} string")
    same = F.col(f"now.{ATTEMPT}") == F.col(f"old.{ATTEMPT}")
    same &= F.col(f"now.{DAY_FOLDER}").eqNullSafe(F.col(f"old.{DAY_FOLDER}"))

    def change(current: DataFrame) -> DataFrame:
        now = current.alias("now")
        if now.join(old.alias("old"), same, "left_semi").count() != len(folded):
            raise Conflict(f"a batch of {root} was written again during compaction")
        kept = now.join(old.alias("old"), same, "left_anti")
        gone = now.join(old.alias("old"), same, "left_semi").where(~F.col("batch").startswith(COMPACTED))
        names = gone.select(
            "batch", "sequence", *[F.lit(None).cast(t).alias(c) for c, t in _types(ATTEMPT, DAY_FOLDER, "rows", "fields")]
        )
        last = current.agg(F.max("sequence")).first()[0]
        mine = added.select(
            F.concat(F.lit(COMPACTED), ATTEMPT).alias("batch"), F.lit(last).alias("sequence"), *added.columns
        )
        return kept.unionByName(names).unionByName(mine).dropDuplicates(["batch", ATTEMPT, DAY_FOLDER])

    return _commit(spark, root, change)


def _types(*names: str) -> list[tuple[str, str]]:
    kinds = dict(part.split() for part in ENTRY.split(", "))
    return [(name, kinds[name]) for name in names]
