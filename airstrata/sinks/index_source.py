"""Writing documents into an index as one commit, through a Python data source.

Every task stages its documents with a transport and reports what it staged; when all tasks are done
the driver publishes what the successful attempts reported, or else discards it. So the failure
of a task, a lost executor or a second attempt leaves nothing behind that readers see.
"""

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from importlib import import_module
from itertools import islice
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..schemas import DOC_ID
from .documents import body_json

FORMAT = "document_index"
CHUNK = 500


def local_path(path: str) -> str:
    """The path of a folder that driver and executors mount alike."""
    parts = urlsplit(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"a folder transport needs a mounted folder, not {path}")
    return parts.path


class FolderIndex:
    """A transport into a folder: files of one JSON object per document, listed by commits.

    An index server's transport has the same four methods; ``send`` is asked for each
    chunk and tells what the index refuses.
    """

    def __init__(self, options: dict):
        self.root = local_path(options["path"])

    def begin(self, job: str) -> str:
        """A new file for one attempt of a task; gives its name."""
        name = f"{job}-{uuid.uuid4().hex}.json"
        os.makedirs(f"{self.root}/staged", exist_ok=True)
        return name

    def send(self, staged: str, pairs: list[tuple[str, str]]) -> list[str | None]:
        """Stage documents; an error text or None for each."""
        with open(f"{self.root}/staged/{staged}", "a", encoding="utf-8") as file:
            for key, body in pairs:
                file.write(json.dumps({"id": key, "body": body}, ensure_ascii=False) + "\n")
        return [None] * len(pairs)

    def publish(self, job: str, staged: list[str]) -> None:
        """Make the staged documents visible at once: the list is renamed into place."""
        for folder in ("staged", "published"):
            os.makedirs(f"{self.root}/{folder}", exist_ok=True)
        draft = f"{self.root}/published/.{job}"
        with open(draft, "w", encoding="utf-8") as file:
            file.writelines(json.dumps({"file": name}) + "\n" for name in staged)
        os.replace(draft, f"{self.root}/published/{job}.json")

    def discard(self, staged: list[str]) -> None:
        for name in staged:
            if os.path.exists(f"{self.root}/staged/{name}"):
                os.remove(f"{self.root}/staged/{name}")


def transport_of(options: dict):
    """The transport that the option ``transport`` names as ``module:class``."""
    module, name = options.get("transport", f"{__name__}:FolderIndex").split(":")
    return getattr(import_module(module), name)(dict(options))


@dataclass
class Staged(WriterCommitMessage):
    name: str | None
    sent: int
    refused: int


class IndexWriter(DataSourceWriter):
    """Documents are rows of (id, json)."""

    def __init__(self, options: dict):
        self.options = options
        self.job = uuid.uuid4().hex

    def write(self, rows: Iterator) -> Staged:
        transport, name, sent, refused = transport_of(self.options), None, 0, 0
        limit = int(self.options.get("refusals", 0))
        pairs = ((row[0], row[1]) for row in rows)
        try:
            while some := list(islice(pairs, CHUNK)):
                name = name or transport.begin(self.job)
                errors = transport.send(name, some)
                sent += len(some)
                refused += sum(e is not None for e in errors)
                if refused > limit:
                    raise RuntimeError(f"{refused} documents refused, the first because: {next(e for e in errors if e)}")
        except BaseException:
            if name:
                transport.discard([name])
            raise
        return Staged(name, sent, refused)

    def commit(self, messages: list) -> None:
        transport_of(self.options).publish(self.job, [m.name for m in messages if m is not None and m.name])

    def abort(self, messages: list) -> None:
        transport_of(self.options).discard([m.name for m in messages if m is not None and m.name])


class IndexSource(DataSource):
    """``df.write.format("document_index")``: options path, transport, refusals (how many a task tolerates)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "id string, body string"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return IndexWriter(dict(self.options))


def write_documents(docs: DataFrame, path: str, writers: int | None = None, **options) -> None:
    """Write all documents, by ``doc_id``, as one commit. ``writers`` bounds how many tasks send at once."""
    spark = docs.sparkSession
    spark.dataSource.register(IndexSource)
    pairs = docs.select(F.col(DOC_ID).cast("string").alias("id"), body_json(docs).alias("body"))
    if writers is not None:
        pairs = pairs.repartition(writers)
    pairs.write.format(FORMAT).options(path=path, **options).mode("append").save()


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """id, body and commit of all documents that commits made visible; staged files of others are not read."""
    root = f"file://{local_path(path)}"
    listed = f"{local_path(path)}/published"
    if not os.path.isdir(listed) or not any(name.endswith(".json") for name in os.listdir(listed)):
        return spark.createDataFrame([], "id string, body string, commit string")
    names = spark.read.schema("file string").json(f"{root}/published").select("file")
    name = F.regexp_extract("_metadata.file_path", "/([^/]+)$", 1)
    rows = spark.read.schema("id string, body string").json(f"{root}/staged").select("id", "body", name.alias("file"))
    return rows.join(names, "file", "left_semi").select("id", "body", F.regexp_extract("file", "^([^-]+)-", 1).alias("commit"))
