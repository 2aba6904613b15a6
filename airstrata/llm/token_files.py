"""Token ids in Arrow files of fixed-size lists, for access by row without copying."""

import posixpath
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from ..workspace import workspace
from .common import texts
from .tokens import encoder

ROW = 1024  # ids in a row
BATCH_ROWS = 1024


def file_schema(width: int, row: int) -> pa.Schema:
    ids = pa.uint16() if width == 2 else pa.uint32()
    return pa.schema([("ids", pa.list_(ids, row)), ("mask", pa.list_(pa.bool_(), row))])


def batch_of(ids: np.ndarray, schema: pa.Schema, row: int) -> pa.RecordBatch:
    """Rows of ``row`` ids; the last is filled with zeros that the mask leaves out."""
    filled = np.zeros(-(-len(ids) // row) * row, ids.dtype)
    filled[: len(ids)] = ids
    mask = np.arange(len(filled)) < len(ids)
    lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), row) for x in (filled, mask)]
    return pa.record_batch(lists, schema=schema)


class FileOfRows:
    """One Arrow file, open for appending ids; at most one batch is held."""

    def __init__(self, sink, width: int, row: int):
        self.row, self.schema = row, file_schema(width, row)
        self.dtype = np.dtype(f"<u{width}")
        self.sink, self.writer = sink, pa.ipc.new_file(sink, self.schema)
        self.waiting: list[np.ndarray] = []
        self.held, self.total = 0, 0

    def append(self, ids: np.ndarray) -> int:
        """Add ids; the place of the first one in this file."""
        start = self.total
        self.waiting.append(ids.astype(self.dtype))
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= BATCH_ROWS * self.row:
            self.flush(BATCH_ROWS * self.row)
        return start

    def flush(self, size: int) -> None:
        """Write what is held, up to a whole number of batches of ``size`` ids, or all (0)."""
        ids = np.concatenate([np.zeros(0, self.dtype), *self.waiting])
        step = size or max(len(ids), 1)
        end = len(ids) // step * step
        for at in range(0, end, step):
            self.writer.write_batch(batch_of(ids[at : at + step], self.schema, self.row))
        self.waiting, self.held = [ids[end:]], len(ids) - end

    def close(self) -> None:
        self.flush(0)
        self.writer.close()
        self.sink.close()


class RowReader:
    """Reads id ranges of one file; a batch is mapped, or read once, not copied."""

    def __init__(self, path: str):
        where, inside = fs.FileSystem.from_uri(path)
        local = isinstance(where, fs.LocalFileSystem)
        self.source = pa.memory_map(inside) if local else where.open_input_file(inside)
        self.reader = pa.ipc.open_file(self.source)
        self.row = self.reader.schema.field("ids").type.list_size
        self.at, self.batch = -1, None

    def flat(self, number: int) -> np.ndarray:
        if number != self.at:
            column = self.reader.get_batch(number).column("ids")
            self.at, self.batch = number, column.flatten().to_numpy(zero_copy_only=True)
        return self.batch

    def ids(self, start: int, length: int) -> np.ndarray:
        """``length`` ids from place ``start`` on; every batch but the last is full."""
        size, parts = BATCH_ROWS * self.row, []
        while length > 0:
            part = self.flat(start // size)[start % size :][:length]
            parts.append(part)
            start, length = start + len(part), length - len(part)
        return np.concatenate(parts) if len(parts) != 1 else parts[0]

    def close(self) -> None:
        self.source.close()


def part_path(folder: str, part: int) -> str:
    return posixpath.join(folder, f"part-{part:06d}.arrow")


def as_uri(path: str) -> str:
    """A path as a URI that Arrow and Spark both take; one without a scheme is local."""
    return path if "://" in path else "file://" + path.removeprefix("file:")


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int | None = 2,
    row: int = ROW,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Write the ids of all texts in ascending id order and return their index.

    The texts are dealt into ranges of ids, one file each: a stream of ids in
    rows of ``row``, only the last row of a file padded and masked. Ids take two
    bytes where the vocabulary allows. The index - doc_id, part, place (in the
    file), n_tokens - is kept beside them as Parquet. A task writes under a name
    of its own attempt and then moves the file, so a repeated task does no harm. NULL
    texts are empty; NULL ids come first; equal ids follow in order of text.
    Texts are shuffled once.
    """
    rows = texts(docs, id_column, text_column)
    key = rows.schema["doc_id"].dataType.simpleString()
    uri = as_uri(folder)

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, context = encoder(tokenizer_path), TaskContext.get()
        end = np.array([] if end_id is None else [end_id], "<u4")
        largest = max(own.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id or 0)
        part = context.partitionId()
        where, inside = fs.FileSystem.from_uri(uri)
        attempt = posixpath.join(inside, f".{part}-{context.taskAttemptId()}")
        target = None
        for frame in frames:
            if target is None:
                where.create_dir(inside, recursive=True)
                target = FileOfRows(where.open_output_stream(attempt), 2 if largest < 65536 else 4, row)
            places, sizes = [], []
            for ids in own.encode_many(frame["text"]):
                ids = np.concatenate([ids, end])
                places.append(target.append(ids))
                sizes.append(len(ids))
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"], "part": part, "place": places, "n_tokens": sizes}
            )
        if target is not None:
            target.close()
            where.move(attempt, part_path(inside, part))

    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    index = ordered.mapInPandas(write, f"doc_id {key}, part int, place long, n_tokens long")
    index.write.parquet(f"{folder}/index")
    return docs.sparkSession.read.schema(index.schema).parquet(f"{folder}/index")


def read_token_files(index: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` is the number of ids in all documents before it: the place in the file
    plus the ids of the files before, a table of one row per file.
    """
    key = index.schema["doc_id"].dataType.simpleString()
    uri = as_uri(folder)
    sizes = index.groupBy("part").agg(F.sum("n_tokens").alias("ids"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, part = None, None
        for frame in frames:
            sums = []
            for number, place, size in zip(frame["part"], frame["place"], frame["n_tokens"]):
                if number != part:
                    if reader is not None:
                        reader.close()
                    reader, part = RowReader(part_path(uri, number)), number
                sums.append(zlib.crc32(reader.ids(place, size).astype("<u4").tobytes()))
            yield frame.drop(columns=["place"]).assign(place=frame["place"], ids_crc32=sums)

    found = index.mapInPandas(
        read, f"doc_id {key}, part int, n_tokens long, place long, ids_crc32 long"
    )
    return found.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, tokenizer_path: str, folder: str | None = None, **options) -> DataFrame:
    """Write the files to ``folder`` (else a new shared one) and read them back."""
    folder = folder or workspace(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, folder, tokenizer_path, **options), folder)
