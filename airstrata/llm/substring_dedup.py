"""Repeated passages of words, found from anchors at a difference cover.

COVER is a set of residues modulo PERIOD in which every difference modulo PERIOD occurs.
For any two positions there is thus a shift below PERIOD that brings both to a
covered position. Two equal windows of ``window`` words therefore share a
covered position at the same place, at which a stretch of ``window - PERIOD + 1``
words is hashed in either; from there the match is extended to the whole window.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .repeats import NO_ID, RANDOM, Hashes, Sequence, copied, keyed, once, ranges_of, with_places
from .suffix_dedup import covered, repeats

WINDOW = 50
# A perfect difference set; the 30 differences of its members are all residues.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
STEP = 8
VISIBLE = np.ones(256, bool)
VISIBLE[[0x20, *range(0x09, 0x0E)]] = False
COVERED = np.zeros(0, np.int64)  # the covered positions, as far as they were needed


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (bytes) of every word: a maximal run without blank or control space."""
    inside = np.zeros(len(text) + 2, bool)
    inside[1:-1] = VISIBLE.take(np.frombuffer(text, np.uint8))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def covered_positions(n: int) -> np.ndarray:
    """Those below ``n``."""
    global COVERED
    if not len(COVERED) or COVERED[-1] < n:
        periods = np.arange(max(1 << 12, 2 * n // PERIOD)) + 1
        COVERED = np.concatenate([COVER, np.add.outer(periods * PERIOD, COVER).ravel()]).astype(np.int64)
    return COVERED[: COVERED.searchsorted(n)]


class Words(Sequence):
    """A text as words. Anchors are the covered positions, each for the windows around it."""

    def __init__(self, text: bytes, window: int = WINDOW):
        if not PERIOD <= window:
            raise ValueError(f"windows need at least {PERIOD} words")
        units, (starts, ends) = np.frombuffer(text, np.uint8), word_spans(text)
        super().__init__(lambda which: Hashes(RANDOM[which].take(units), which)(starts, ends), len(starts), window)

    def anchors(self):
        stretch = self.window - PERIOD + 1
        at = covered_positions(max(0, self.n - stretch + 1))
        first, last = np.maximum(at - PERIOD + 1, 0), np.minimum(at, self.n - self.window)
        some = first <= last
        at, first, last = at[some], first[some], last[some]
        return self.hashes(0)(at, at + stretch), first, last, at


def without_repeats(
    docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, spans, kept (the words left, one blank between).

    A word is removed if it lies in ``window`` successive words that also start in a
    document with a smaller id; all is judged on the given texts. Documents of
    one id do not remove each other's words; a NULL id counts as smaller than all.
    NULL, empty and short texts lose nothing. ``spans`` are the maximal removed runs of
    words (start, end).
    """
    units = keyed(docs, id_column, text_column)
    copies = copied(units)

    def read(text: bytes) -> Words:
        return Words(text, window)

    places = repeats(once(units, copies), read, (STEP, 1), earlier=True)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc, text, held in zip(frame["doc"], frame["text"], frame["places"]):
                words = [text[a:b] for a, b in zip(*map(np.ndarray.tolist, word_spans(text)))]
                spans = covered(len(words), ranges_of(held), window).ravel().tolist()
                edges = [0, *spans, len(words)]
                left = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
                name = None if doc == NO_ID else doc
                out.append((name, len(words), len(words) - len(left), spans, b" ".join(left)))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "spans", "kept"])

    rows = with_places(units, places, copies)
    return rows.mapInPandas(
        cut, "doc_id long, n_words long, n_removed long, spans array<long>, kept binary"
    )


def digest(docs: DataFrame, **options) -> DataFrame:
    """``without_repeats`` with the kept words as their SHA-256."""
    return without_repeats(docs, **options).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
