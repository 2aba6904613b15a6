"""Sequences of bounded length from whole documents, neighbours by BM25 side by side.

Documents are dealt into shards of similar texts: they are ordered by MinHash - of each of a few hashes, the
id of a text for which it is least - so texts that share most of their ids probably begin alike, one
that differs in a few ids included, and lie together. Each shard is an inverted
index over its own documents with weights from the whole corpus. A seed document
opens a window, and the index gives the unused documents most like the seed,
which fill the window; the last one is cut at the window's end, and its rest is
the next seed.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import stored, texts
from .tokens import encoder

LENGTH = 1024
SHARD = 1024  # documents in a shard
SHARD_IDS = 4_000_000  # and ids, if they are long
END = 0
QUERY = 48  # rarest terms of a seed that are looked up
K1, B = 1.2, 0.75
SIGNS = 4  # hashes that place a document
COMMON = 512  # the first ids of a vocabulary, single bytes and the earliest merges, do not place
FIRST = 32  # neighbours that are ranked before the others


def tokenised(docs: DataFrame, tokenizer_path: str, id_column="doc_id", text_column="text", end_id=END):
    """Per row: doc_id, ids (little-endian bytes, 2 each where they fit, else 4), their width, the place.

    Beside them each task gives one row with ``counts`` alone: its documents, their ids
    in all, and in how many of them each id occurs.
    """
    rows = texts(docs, id_column, text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, end = encoder(tokenizer_path), np.array([end_id], "<u4")
        size = max(own.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        placed, counts = Places(size), np.zeros(size + 2, "<i8")
        width = 2 if size <= 65536 else 4
        for frame in frames:
            out, places = [], []
            for ids in own.encode_many(frame["text"]):
                ids = np.concatenate([ids, end]).astype(f"<u{width}")
                present = different(ids)
                counts[present + 2] += 1
                counts[:2] += 1, len(ids)
                out.append(ids.tobytes())
                places.append(placed(present))
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"], "ids": out, "width": width, "place": places, "counts": None}
            )
        yield pd.DataFrame(
            {"doc_id": [None], "ids": [None], "width": [0], "place": [None], "counts": [counts.tobytes()]}
        )

    return rows.mapInPandas(encode, f"doc_id {kind}, ids binary, width int, place binary, counts binary")


def id_frequencies(encoded: DataFrame) -> tuple[np.ndarray, int, float]:
    """In how many documents each id occurs, the documents, and their mean length.

    The tasks' counts are added up; the sums are at most one row per id of the vocabulary.
    """

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1, np.int64)
        for frame in frames:
            for raw in frame["counts"]:
                total = total + np.frombuffer(raw, "<i8")
        used = np.flatnonzero(total)
        yield pd.DataFrame({"at": used, "n": total[used]})

    counts = encoded.where(F.col("counts").isNotNull()).select("counts")
    found = dict(counts.mapInPandas(add, "at long, n long").groupBy("at").agg(F.sum("n")).collect())
    documents, length = found.pop(0, 0), found.pop(1, 0)
    frequency = np.zeros(max(found, default=2) - 1, np.int64)
    for at, n in found.items():
        frequency[at - 2] = n
    return frequency, documents, length / max(documents, 1)


def weights(frequency: np.ndarray, documents: int) -> np.ndarray:
    """Okapi weight of each id; those in more than half the documents get nothing."""
    return np.maximum(np.log((documents - frequency + 0.5) / (frequency + 0.5)), 0).astype(np.float32)


class Places:
    """A key by which texts with much the same ids are ordered together."""

    def __init__(self, size: int):
        draws = np.random.Generator(np.random.Philox(SIGNS)).integers(0, 1 << 32, (SIGNS, size), dtype=np.uint32)
        draws[:, :COMMON] = np.iinfo(np.uint32).max
        self.draws = list(draws)

    def __call__(self, present: np.ndarray) -> bytes:
        if not len(present):
            return b""
        return np.array([present[draw.take(present).argmin()] for draw in self.draws], ">u4").tobytes()


def different(ids: np.ndarray) -> np.ndarray:
    """The different ids of a text in ascending order; a stable sort of short numbers is a radix sort."""
    ids = np.sort(ids, kind="stable")
    new = np.ones(len(ids), bool)
    np.not_equal(ids[1:], ids[:-1], out=new[1:])
    return ids[new].astype(np.int64)


class Shard:
    """An inverted index over some documents, whose postings carry BM25 weights."""

    def __init__(self, documents: list[np.ndarray], idf: np.ndarray, mean: float):
        self.n, self.idf = len(documents), idf
        sizes = np.array([len(d) for d in documents], np.int64)
        # Postings in the order of their ids, then documents, from one sort.
        keys = np.concatenate([*documents, np.zeros(0, np.int64)]).astype(np.int64) << 24
        keys += np.repeat(np.arange(self.n), sizes)
        keys.sort()
        new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
        counts = np.diff(np.r_[new, len(keys)])
        terms, self.owners = keys[new] >> 24, keys[new] & 0xFFFFFF
        norm = K1 * (1 - B + B * sizes / max(mean, 1e-9))
        self.scores = idf[terms] * counts * (K1 + 1) / (counts + norm[self.owners])
        self.ends = np.cumsum(np.bincount(terms, minlength=len(idf)))
        self.firsts = np.r_[0, self.ends[:-1]]
        # The same postings by document, for the terms of a seed.
        self.present = terms[np.argsort(self.owners.astype(np.uint16 if self.n <= 65536 else np.int64), kind="stable")]
        self.bounds = np.r_[0, np.cumsum(np.bincount(self.owners, minlength=self.n))].tolist()

    def terms(self, one: int) -> np.ndarray:
        """The rarest terms of a document, those without a weight left out."""
        present = self.present[self.bounds[one] : self.bounds[one + 1]]
        present = present[self.idf[present] > 0]
        if len(present) <= QUERY:
            return present
        return np.sort(present[np.argpartition(-self.idf[present], QUERY)[:QUERY]])

    def neighbours(self, one: int) -> np.ndarray:
        """BM25 of every document of the shard for the rarest terms of one of them."""
        query = self.terms(one)
        if not len(query):
            return np.zeros(self.n)
        first, ends = self.firsts[query], self.ends[query]
        after = np.cumsum(ends - first)
        at = np.arange(after[-1]) + np.repeat(ends - after, ends - first)
        return np.bincount(self.owners.take(at), self.scores.take(at), self.n)

    def ranked(self, one: int, free: np.ndarray) -> Iterator[int]:
        """The ``free`` documents that share such a term, the likest first, equal ones in their order."""
        score = self.neighbours(one)
        found = np.flatnonzero((score > 0) & free)
        likest = found
        if len(found) > FIRST:
            # All that reach the score of the last of the first.
            least = -np.partition(-score[found], FIRST - 1)[FIRST - 1]
            likest, found = found[score[found] >= least], found[score[found] < least]
        else:
            found = found[:0]
        yield from likest[np.argsort(-score[likest], kind="stable")].tolist()
        yield from found[np.argsort(-score[found], kind="stable")].tolist()


def fill(documents: list[np.ndarray], idf: np.ndarray, mean: float, length: int, room: int):
    """Yield (document, start, size, opens a new window) until all ids are placed.

    ``room`` is what the window that is open still takes. Full windows are cut from
    a long document first; what remains of it is the seed that the window is filled for. Where no
    unused document is like the seed, the next one in order goes on.
    """
    index = Shard(documents, idf, mean)
    free = np.ones(len(documents), bool)
    room = room or length
    fresh = room == length
    seed, start, following = None, 0, 0
    while True:
        if seed is None:
            while following < len(documents) and not free[following]:
                following += 1
            if following == len(documents):
                return
            seed, start = following, 0
            free[seed] = False
        size = len(documents[seed])
        while start < size:
            part = min(room, size - start)
            yield seed, start, part, fresh
            start, room = start + part, room - part
            fresh = room == 0
            room = room or length
        rest = None
        if not fresh:
            for one in index.ranked(seed, free):
                free[one] = False
                part = min(room, len(documents[one]))
                yield one, 0, part, False
                room -= part
                if not room:
                    fresh, room = True, length
                    rest = (one, part) if part < len(documents[one]) else None
                    break
        seed, start = rest or (None, 0)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    length: int = LENGTH,
    end_id: int = END,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document (its text's, then ``end_id``; NULL text is empty) lies
    in exactly one piece; the pieces of a sequence follow each other from offset 0.
    A sequence is full but for the last of a task, so the padding is at most one
    sequence a task. Texts are encoded once and their ids shuffled once, into ranges
    of (place, doc_id): copies and a hot place are cut by id. A task holds one shard, in which it looks for neighbours;
    those that lie in other shards are not found, and no document is left out for that.
    Rows that repeat are packed each; an empty table gives no pieces.
    """
    encoded = stored(tokenised(docs, tokenizer_path, id_column, text_column, end_id), "ids")
    frequency, documents, mean = id_frequencies(encoded)
    idf = docs.sparkSession.sparkContext.broadcast(weights(frequency, documents))
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def shard(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sequence, used = (TaskContext.get().partitionId() << 40) - 1, 0
        names, held, size = [], [], 0

        def placed_pieces() -> pd.DataFrame:
            nonlocal sequence, used
            out = []
            for one, start, part, fresh in fill(held, idf.value, mean, length, (length - used) % length):
                if fresh:
                    sequence, used = sequence + 1, 0
                ids = held[one]
                crc = zlib.crc32(ids[start : start + part].astype("<u4").tobytes())
                out.append((names[one], start, part, crc, len(ids), sequence, used))
                used += part
            frame = pd.DataFrame(out, columns=COLUMNS, dtype=object)
            names.clear()
            held.clear()
            return frame

        for frame in frames:
            for doc_id, raw, width in zip(frame["doc_id"], frame["ids"], frame["width"]):
                names.append(doc_id)
                held.append(np.frombuffer(raw, f"<u{width}"))
                size += len(held[-1])
                if len(held) >= SHARD or size >= SHARD_IDS:
                    yield placed_pieces()
                    size = 0
        if held:
            yield placed_pieces()

    schema = (
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long"
    )
    rows = encoded.where(F.col("counts").isNull()).drop("counts")
    ordered = rows.repartitionByRange("place", "doc_id").sortWithinPartitions("place", "doc_id", "ids")
    return ordered.select("doc_id", "ids", "width").mapInPandas(shard, schema)


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
