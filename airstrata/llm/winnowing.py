"""Document fingerprints by winnowing, and how alike two of them are.

Every window of WINDOW successive k-grams keeps its smallest hash, the rightmost of
equal ones. Any passage of at least ``GRAM + WINDOW - 1`` characters that two texts
share is therefore kept at the same place of the passage in both, and nothing
shorter than ``GRAM`` characters can match.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import stored, texts

GRAM = 16
WINDOW = 32
BASE = 0x9E3779B97F4A7C15


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")


def gram_hashes(points: np.ndarray, k: int = GRAM) -> np.ndarray:
    """Rolling hash of every k-gram, well mixed; one of all characters if fewer than ``k``.

    The polynomial hash of a longer run is that of its halves, so ``k`` characters
    take about log2(k) steps over the whole text.
    """
    k = min(k, len(points))
    if k == 0:
        return np.zeros(0, np.uint64)
    run, size = points.astype(np.uint64) + np.uint64(1), 1
    total, done = None, 0
    with np.errstate(over="ignore"):
        while True:
            if k & size:
                if total is None:
                    total, done = run, size
                else:
                    n = len(points) - done - size + 1
                    power = np.uint64(pow(BASE, size, 1 << 64))
                    total, done = total[:n] * power + run[done : done + n], done + size
            if size * 2 > k:
                break
            n = len(run) - size
            run = run[:n] * np.uint64(pow(BASE, size, 1 << 64)) + run[size : size + n]
            size *= 2
        mixed = (total ^ (total >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        mixed = (mixed ^ (mixed >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return mixed ^ (mixed >> np.uint64(33))


def rightmost_minima(values: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions kept: per window the smallest value, the rightmost of equal ones, once each."""
    if len(values) == 0:
        return np.zeros(0, np.int64)
    window = min(window, len(values))
    best, size = np.arange(len(values)), 1
    while size < window:
        step = min(size, window - size)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(values[right] <= values[left], right, left)
        size += step
    return best[np.r_[True, best[1:] != best[:-1]]]


def winnow(text: str, k: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The kept hashes and their positions (code points) in the whole text."""
    hashes = gram_hashes(code_points(text), k)
    places = rightmost_minima(hashes, window)
    return hashes[places], places


def digest(hashes: np.ndarray, places: np.ndarray) -> str:
    """A short name of a fingerprint; equal texts have equal ones."""
    both = np.concatenate([hashes.astype("<u8"), places.astype("<u8")])
    return xxhash.xxh3_128_hexdigest(both.tobytes())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Kept hashes in both over kept hashes in either; 1 if neither has any."""
    a, b = np.unique(a), np.unique(b)
    shared = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - shared
    return shared / union if union else 1.0


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """Per row: doc_id, hashes and positions kept. NULL and empty texts keep none.

    One narrow pass over whole texts; rows that repeat are each given.
    """
    rows = texts(docs, id_column, text_column)
    key = rows.schema["doc_id"].dataType.simpleString()

    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            kept = [winnow(text or "", k, window) for text in frame["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "hashes": [h.view(np.int64) for h, _ in kept],
                    "positions": [p for _, p in kept],
                }
            )

    return rows.mapInPandas(keep, f"doc_id {key}, hashes array<long>, positions array<long>")


def edited(text: str, other: str) -> str:
    """``text`` with its last quarter replaced by as much of the start of ``other``."""
    n = len(text) // 4
    return text[: len(text) - n] + other[:n]


def compared(text: str, own: tuple, other: str, following: tuple) -> dict:
    """The result columns of a text whose next document is ``other``; both with their winnowing."""
    changed = edited(text, other)
    new = winnow(changed)
    return {
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(),
        "fingerprint": digest(*own),
        "edited_fingerprint": digest(*new),
        "n_kept": len(own[0]),
        "near_edited": likeness(own[0], new[0]),
        "near_next": likeness(own[0], following[0]),
    }


RESULT = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "n_kept long, near_edited double, near_next double"
)


def frame_of(rows: list[dict], columns: list[str]) -> pd.DataFrame:
    """Rows with gaps as a frame of plain objects, gaps as None."""
    return pd.DataFrame([[row.get(c) for c in columns] for row in rows], columns=columns, dtype=object)


def with_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprint each text, its edited text and the next document's, by ascending id.

    Texts are dealt into ranges of ids and sorted there: one shuffle. A task holds
    two texts at a time. Each range gives its first and last text apart, and
    these, two rows per range, are paired afterwards; the very last document is
    followed by the first. NULL text is empty; NULL ids come first; equal ids follow
    in order of text; an empty table gives no rows.
    """
    rows = texts(docs, id_column, text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def pair(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        held = None
        for frame in frames:
            out = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                text = text or ""
                kept = winnow(text)
                if held is None:
                    out.append({"doc_id": doc_id, "part": part, "head": text})
                else:
                    out.append({"doc_id": held[0], **compared(*held[1:], text, kept)})
                held = (doc_id, text, kept)
            yield frame_of(out, columns)
        if held is not None:
            yield frame_of([{"doc_id": held[0], "part": part, "tail": held[1]}], columns)

    schema = f"doc_id {kind}, {RESULT}, part int, head string, tail string"
    columns = [x.split(" ")[0] for x in schema.split(", ")]
    dealt = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    made = stored(dealt.mapInPandas(pair, schema), "winnowed")

    heads = made.where(F.col("head").isNotNull()).select("part", "head")
    tails = made.where(F.col("tail").isNotNull()).select("part", "doc_id", "tail")
    # A row per range: the next range that has texts, or the first one.
    order = W.orderBy("part")
    following = heads.select("part").select(
        "part",
        F.coalesce(F.lead("part").over(order), F.min("part").over(W.partitionBy())).alias("after"),
    )
    ends = (
        tails.join(following, "part")
        .join(heads.select(F.col("part").alias("after"), "head"), "after")
        .select("doc_id", "tail", "head")
    )

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = zip(frame["doc_id"], frame["tail"], frame["head"])
            out = [
                {"doc_id": d, **compared(tail, winnow(tail), head, winnow(head))}
                for d, tail, head in rows
            ]
            yield frame_of(out, columns[: len(RESULT.split(", ")) + 1])

    inner = made.where(F.col("fingerprint").isNotNull()).drop("part", "head", "tail")
    return inner.unionByName(ends.mapInPandas(finish, f"doc_id {kind}, {RESULT}"))
