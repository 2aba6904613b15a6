"""Repeated byte strings within and across documents, from minima of rolling hashes.

In every run of ``reach`` successive string starts the position with the smallest hash of GRAM bytes,
the rightmost of equal ones, is chosen; the choice depends on the bytes around it only, so equal strings
of ``length`` bytes choose alike. A stretch of at least CORE bytes from there on (less for
short strings), which all strings of the run hold, brings candidates together by its hash, and
hulls and single strings then decide, as told in ``repeats``. So hashes of stretches take the place of
a dictionary of phrases, its parse and their suffix arrays: removal asks whether a string
has an equal, not which comes first, and no order of all suffixes is made.
"""

from collections.abc import Iterator
from itertools import repeat as always

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import stored
from .repeats import (
    NO_ID, RANDOM, Sequence, copied, finer, in_places, joined, keyed, once, ranges_of, repeated_ranges,
    with_places,
)

LENGTH = 400
GRAM = 16
REACH = 256
CORE = 145
STEP = 16
CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<long>, kept binary"


def smallest(values: np.ndarray, window: int) -> np.ndarray:
    """Per window of successive values the position of the smallest, the rightmost of equal ones.

    Values are compared by their upper 32 bits. Running minima forwards and
    backwards within blocks of one window give the minimum of any window.
    """
    n = len(values)
    low = np.uint64(0xFFFFFFFF)
    packed = (values & ~low) | (low - np.arange(n, dtype=np.uint64))
    padded = np.full(-(-n // window) * window, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = packed
    blocks = padded.reshape(-1, window)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(backward[: n - window + 1], forward[window - 1 : n])
    return (low - (least & low)).astype(np.int64)


class Bytes(Sequence):
    """A text as bytes. An anchor is the trigger chosen for a run of string starts."""

    def __init__(self, text: bytes, length: int = LENGTH):
        units = np.frombuffer(text, np.uint8)
        super().__init__(lambda which: RANDOM[which].take(units), len(units), length)

    def anchors(self):
        starts = self.n - self.window + 1
        if starts <= 0:
            return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
        # Shorter strings leave less room for a choice and for what follows it.
        gram = min(GRAM, self.window)
        reach = max(1, min(REACH, max(self.window - CORE + 1, self.window // 2), self.window - gram + 1))
        every = np.arange(self.n - gram + 1)
        chosen = smallest(self.hashes(0)(every, every + gram), reach)[:starts]
        new = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
        first, last, at = new, np.r_[new[1:] - 1, starts - 1], chosen[new]
        core = self.hashes(0)(at, at + self.window - reach + 1)
        return core, first, last, at


def covered(n: int, ranges: np.ndarray, length: int) -> np.ndarray:
    """The maximal runs (start, end) of units that windows starting in ``ranges`` cover."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, ranges[:, 0], 1)
    np.add.at(change, np.minimum(ranges[:, 1] + length, n), -1)
    inside = np.concatenate([[0], (np.cumsum(change[:-1]) > 0).astype(np.int8), [0]])
    edges = np.flatnonzero(np.diff(inside))
    return edges.reshape(-1, 2)


def whole_characters(text: bytes, spans: np.ndarray) -> np.ndarray:
    """The spans widened to whole UTF-8 characters, those that then meet as one."""
    wide: list[list[int]] = []
    for start, end in spans.tolist():
        while 0 < start < len(text) and text[start] & 0xC0 == 0x80:
            start -= 1
        while end < len(text) and text[end] & 0xC0 == 0x80:
            end += 1
        if wide and start <= wide[-1][1]:
            wide[-1][1] = end
        else:
            wide.append([start, end])
    return np.array(wide, np.int64).reshape(-1, 2)


def repeats(units: DataFrame, read, steps: tuple, earlier: bool) -> DataFrame:
    """doc, mark and the ranges of starts of repeated windows, as a list of binaries; ``units`` of ``once``."""
    level = stored(repeated_ranges(units, read, earlier), "repeats")
    found = level.where("settled")
    for step in steps:
        level = finer(level, units, read, step, earlier)
        if step > 1:  # single windows are read once
            level = stored(level, "repeats")
        found = found.unionAll(level.where("settled"))

    def fewer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            few = [[joined(in_places(places)).astype("<i4").tobytes()] for places in frame["places"]]
            yield frame.assign(places=few)

    places = found.groupBy("doc", "mark").agg(F.collect_list("places").alias("places"))
    return stored(places.mapInPandas(fewer, "doc long, mark long, places array<binary>"), "places")


def without_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    id_column: str = "doc_id",
    text_column: str = "text",
    carried: tuple[str, ...] = (),
    characters: bool = False,
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, spans, kept (the bytes left).

    A byte is removed if a string of ``length`` bytes that covers it also starts
    anywhere else, in the same document or another; all is judged on the given texts.
    Matches never cross documents. ``spans`` are the maximal removed runs (start,
    end). NULL and empty texts have no bytes; rows that repeat count as documents of
    their own, so those of at least ``length`` bytes lose all; NULL ids are kept.
    ``carried`` columns follow, each row with its own. With ``characters`` a run also
    takes the rest of a character that it cuts, so that ``kept`` stays valid text.
    """
    units = keyed(docs, id_column, text_column)
    copies = copied(units)

    def read(text: bytes) -> Bytes:
        return Bytes(text, length)

    places = repeats(once(units, copies), read, (STEP, 1), earlier=False)
    names = [column.split()[0] for column in CUT.split(", ")]

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            others = zip(*(frame[f"carried {c}"] for c in carried)) if carried else always(())
            for doc, text, held, own in zip(frame["doc"], frame["text"], frame["places"], others):
                spans = covered(len(text), ranges_of(held), length)
                if characters:
                    spans = whole_characters(text, spans)
                edges = [0, *spans.ravel().tolist(), len(text)]
                left = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                name, runs = None if doc == NO_ID else doc, spans.ravel().tolist()
                out.append((name, len(text), len(text) - len(left), len(spans), runs, left, *own))
            yield pd.DataFrame(out, columns=[*names, *carried])

    rows = with_places(keyed(docs, id_column, text_column, carried), places, copies)
    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carried]
    return rows.mapInPandas(cut, ", ".join([CUT, *kinds]))


def digest(docs: DataFrame, **options) -> DataFrame:
    """``without_repeats`` with the kept bytes as their SHA-256."""
    return without_repeats(docs, **options).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
