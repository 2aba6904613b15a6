"""Passages of benchmark items in documents, allowing for edits.

CGK embedding: a walk reads a text and writes a sign at every step; random bits, the
same for all texts, decide for each step and sign whether the walk moves on.
Texts at a small edit distance fall into step again soon after each edit, so
their walks differ in few places. Sampled steps of several walks are the keys of hash
tables that hold every item from every place in it; windows of a document that
share a key with one propose that item there, and the exact edit distance decides.

Windows are embedded only where they can count. A window within ``k`` edits of an
item of ``n`` signs holds at least ``n - GRAM + 1 - GRAM * k`` of its grams, a bound
that drops no match; and within such a window a walk starts wherever a run of shared
grams does, so that one starts behind every edit and meets the next only later, and
at every EVERY signs of a long run, whose beginning may lie before the passage.

Unedited items do not depend on keys: the hash of an item's first LEAST signs is looked
up at every place that can begin one, and the signs are compared.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..operators.rows import quoted
from .common import stored

RATE = 0.08  # edits allowed, as a share of the item's length
GRAM = 10
LEAST = 40  # signs; shorter items are found unedited only
WALKS = 4  # embeddings per window
TABLES = 4  # hash tables per embedding
SAMPLED = 12  # steps that make a key
READ = 48  # signs a walk can read
CLASS = 1.25  # items whose lengths differ by less share a bound
COARSE = 16
EVERY = 16  # signs between walks within a run of shared grams
LOAD = 16  # places in the bit table per gram of the items, at least
TOGETHER = 500  # texts whose windows are embedded at once
ITEMS = 1 << 20  # bytes of items that every task holds at once; a sign takes 256 bytes of keys
PAD = 256
LIKE = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))


def signs(text: str | bytes | None) -> np.ndarray:
    """The bytes that are compared: lower case (A-Z), any white space as a blank."""
    raw = text.encode("utf-8", "replace") if isinstance(text, str) else text or b""
    return np.frombuffer(raw.translate(LIKE), np.uint8)


def gram_codes(units: np.ndarray) -> np.ndarray:
    """A hash of the GRAM signs at each position."""
    if len(units) < GRAM:
        return np.zeros(0, np.uint64)
    two = units[:-1].astype(np.uint64) << np.uint64(8) | units[1:]
    four = two[:-2] << np.uint64(16) | two[2:]
    eight = four[:-4] << np.uint64(32) | four[4:]
    return eight[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + two[8:]


def slots(codes: np.ndarray, bits: int = 22) -> np.ndarray:
    """A place in a table of 2 ** ``bits`` flags."""
    return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def head_codes(codes: np.ndarray) -> np.ndarray:
    """A hash of the LEAST signs at each position, from the codes of their grams."""
    n = max(0, len(codes) - LEAST + GRAM)
    out = np.zeros(n, np.uint64)
    for at in range(0, LEAST, GRAM):
        out = (out ^ codes[at : at + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out


def edits(length: int, rate: float) -> int:
    return int(length * rate)


def embed(windows: np.ndarray, steps: int, seed: int) -> np.ndarray:
    """CGK walks over rows of signs: for every step the sign read, PAD past the end."""
    rng = np.random.default_rng(seed)
    moves = rng.integers(0, 2, (steps, PAD + 1), dtype=np.uint8)
    rows, width = windows.shape
    padded = np.concatenate([windows, np.full((rows, 1), PAD, np.int16)], axis=1)
    at, every = np.zeros(rows, np.int64), np.arange(rows)
    out = np.empty((rows, steps), np.int16)
    for step in range(steps):
        sign = padded[every, at]
        out[:, step] = sign
        at = np.minimum(at + moves[step][sign], width)
    return out


def keys(windows: np.ndarray, walk: int) -> np.ndarray:
    """Bit-sampling keys of one walk: a number per window and table."""
    steps = 2 * READ
    walked = embed(windows, steps, 1000 + walk).astype(np.uint64)
    rng = np.random.default_rng(5000 + walk)
    out = np.empty((len(windows), TABLES), np.uint64)
    for table in range(TABLES):
        key = np.full(len(windows), walk * TABLES + table + 1, np.uint64)
        for i in rng.choice(steps, SAMPLED, replace=False):
            key = (key ^ walked[:, i]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(32)
        out[:, table] = key
    return out


def windows_at(units: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """READ signs from each start on, PAD past the end."""
    padded = np.concatenate([units.astype(np.int16), np.full(READ, PAD, np.int16)])
    return padded[starts[:, None] + np.arange(READ)]


def best_match(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end): the stretch of ``text`` nearest to the whole item.

    Edit distance with free ends in the text, by anti-chains of whole columns: a
    row of the table is updated at once, insertions by a running minimum.
    """
    n = len(text)
    across = np.arange(n + 1)
    cost, origin = np.zeros(n + 1, np.int64), across.copy()
    for i, sign in enumerate(item, 1):
        replace = cost[:-1] + (text != sign)
        drop = cost[1:] + 1
        take = drop < replace
        row = np.concatenate([[i], np.where(take, drop, replace)])
        start = np.concatenate([[0], np.where(take, origin[1:], origin[:-1])])
        # An inserted sign of the text costs one: the least of row - position, so far.
        least = np.minimum.accumulate(row - across)
        source = np.maximum.accumulate(np.where(row - across == least, across, 0))
        cost, origin = least + across, start[source]
    end = int(cost.argmin())
    return int(cost[end]), int(origin[end]), end


class Items:
    """The items: their grams, bounds by class of length, and one sorted table of keys."""

    def __init__(self, rows: list[tuple], rate: float = RATE):
        self.rate = rate
        every = [(name, signs(text)) for name, text in rows]
        self.short = [(name, s.tobytes()) for name, s in every if 0 < len(s) < LEAST]
        self.items = [(name, s) for name, s in every if len(s) >= LEAST]
        self.grams = [np.unique(gram_codes(s)) for _, s in self.items]
        total = sum(len(g) for g in self.grams)
        self.bits = max(22, (LOAD * total).bit_length())
        self.seen = np.zeros(1 << self.bits, bool)
        # By the hash of their first signs: per length the items of those signs.
        self.heads: dict[int, dict[int, dict[bytes, list[int]]]] = {}
        classes: dict[int, tuple[int, int]] = {}
        found, owner, offset = [], [], []
        for i, (_, s) in enumerate(self.items):
            codes = gram_codes(s)
            self.seen[slots(codes, self.bits)] = True
            head = self.heads.setdefault(int(head_codes(codes)[0]), {})
            head.setdefault(len(s), {}).setdefault(s.tobytes(), []).append(i)
            n, k = len(s), edits(len(s), rate)
            kind = int(math.log(n) / math.log(CLASS))
            reach, least = classes.get(kind, (0, n))
            classes[kind] = max(reach, n + k), min(least, max(1, n - GRAM + 1 - GRAM * k))
            starts = np.arange(max(1, n - READ + 1))
            made = np.concatenate([keys(windows_at(s, starts), w) for w in range(WALKS)], axis=1)
            found.append(made.ravel())
            owner.append(np.full(made.size, i, np.int32))
            offset.append(np.repeat(starts, made.shape[1]).astype(np.int32))
        self.classes = list(classes.values())
        self.beginnings = np.sort(np.array([*self.heads], np.uint64))
        owner, offset = (np.concatenate([np.zeros(0, np.int32), *x]) for x in (owner, offset))
        keys_ = np.concatenate([np.zeros(0, np.uint64), *found])
        order = np.argsort(keys_, kind="stable")
        self.keys, self.owner, self.offset = keys_[order], owner[order], offset[order]

    def starts(self, units: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Where walks start: in runs of shared grams, in windows that hold enough of them.

        Beside them (item, start) of the items that are there unedited.
        """
        codes = gram_codes(units)
        none = np.zeros(0, np.int64)
        if not len(codes) or not self.classes:
            return none, []
        hit = self.seen[slots(codes, self.bits)]
        sums = np.concatenate([[0], np.cumsum(hit, dtype=np.int32)])
        coarse = np.arange(0, len(codes), COARSE)
        near = np.zeros(len(codes) + 1, np.int32)
        for reach, least in self.classes:
            end = np.minimum(coarse + COARSE + reach, len(codes))
            some = np.flatnonzero(sums[end] - sums[coarse] >= least)
            if len(some):
                np.add.at(near, coarse[some], 1)
                np.add.at(near, end[some], -1)
        if not near.any():
            return none, []
        hit &= np.cumsum(near[:-1]) > 0
        at = np.flatnonzero(hit)
        new = np.concatenate([[True], at[1:] != at[:-1] + 1])
        since = at - np.maximum.accumulate(np.where(new, at, 0)) if len(at) else at
        return at[since % EVERY == 0], self.unedited(units, codes, at)

    def unedited(self, units: np.ndarray, codes: np.ndarray, at: np.ndarray) -> list[tuple[int, int]]:
        """(item, start) of items that begin at one of the places ``at``, sign by sign."""
        # All grams of the first LEAST signs are shared, so the last of them is too.
        last = LEAST - GRAM
        at = at[:-last][at[last:] - at[:-last] == last] if len(at) > last else at[:0]
        if not len(at):
            return []
        first = head_codes(codes)[at]
        place = np.minimum(np.searchsorted(self.beginnings, first), len(self.beginnings) - 1)
        known = self.beginnings[place] == first
        out = []
        for start, head in zip(at[known].tolist(), first[known].tolist()):
            for n, signed in self.heads[head].items():
                out += [(i, start) for i in signed.get(units[start : start + n].tobytes(), ())]
        return out

    def candidates(self, texts: list[np.ndarray]) -> list[list[tuple[int, int]]]:
        """Per text the different (item, where in it that would start) whose keys meet, or that are there unedited.

        The windows of all texts are embedded together.
        """
        starts, exact = zip(*map(self.starts, texts)) if texts else ((), ())
        owner = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
        some = np.concatenate([np.zeros(0, np.int64), *starts])
        rows = [windows_at(u, s) for u, s in zip(texts, starts) if len(s)]
        found = [np.array([(t, i, a) for t, own in enumerate(exact) for i, a in own], np.int64).reshape(-1, 3)]
        windows = np.concatenate(rows) if rows else np.zeros((0, READ), np.int16)
        for at in range(0, len(windows), 1 << 15):
            part = slice(at, at + (1 << 15))
            for walk in range(WALKS):
                made = keys(windows[part], walk)
                first = np.searchsorted(self.keys, made, "left").ravel()
                sizes = np.searchsorted(self.keys, made, "right").ravel() - first
                total = int(sizes.sum())
                if total:
                    place = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(total)
                    row = np.repeat(np.repeat(np.arange(len(made)), TABLES), sizes) + at
                    begin = some[row] - self.offset[place]
                    found.append(np.stack([owner[row], self.owner[place], begin], axis=1))
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        for text, item, begin in np.unique(np.concatenate(found), axis=0).tolist():
            out[text].append((item, begin))
        return out

    def enough(self, i: int, units: np.ndarray) -> bool:
        """Whether a stretch holds as many grams of the item as any match must."""
        n = len(self.items[i][1])
        place = np.searchsorted(self.grams[i], codes := gram_codes(units))
        held = self.grams[i][np.minimum(place, len(self.grams[i]) - 1)] == codes
        return np.count_nonzero(held) >= n - GRAM + 1 - GRAM * edits(n, self.rate)

    def matches(self, texts: list[bytes | None]) -> list[list[tuple]]:
        """Per text (item id, edits, start, end), in bytes; overlapping finds of an item once."""
        every = [signs(text) for text in texts]
        return [self.verified(u, c) for u, c in zip(every, self.candidates(every))]

    def verified(self, units: np.ndarray, candidates: list[tuple[int, int]]) -> list[tuple]:
        spans: dict[int, list[tuple[int, int]]] = {}
        for i, begin in candidates:
            n = len(self.items[i][1])
            slack = 2 * edits(n, self.rate) + 2
            low, high = max(0, begin - slack), min(len(units), begin + n + slack)
            held = spans.setdefault(i, [])
            if held and held[-1][1] >= low:
                held[-1] = (held[-1][0], max(held[-1][1], high))
            else:
                held.append((low, high))
        out = []
        for i, held in spans.items():
            name, item = self.items[i]
            most = edits(len(item), self.rate)
            todo = list(held)
            while todo:
                a, b = todo.pop()
                if b - a < len(item) - most or not self.enough(i, units[a:b]):
                    continue
                cost, start, end = best_match(item, units[a:b])
                if cost <= most:
                    out.append((name, cost, a + start, a + end))
                    todo += [(a, a + start), (a + end, b)]
        raw = units.tobytes() if self.short else b""
        for name, item in self.short:
            at = raw.find(item)
            while at >= 0:
                out.append((name, 0, at, at + len(item)))
                at = raw.find(item, at + len(item))
        return sorted(out, key=lambda m: (m[2], m[3], str(m[0])))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = RATE,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Every passage of an item: doc_id, item_id, edits, start, end (bytes of the text).

    A passage is a stretch within ``rate`` times the item's length in edits of the
    whole item, case (A-Z) and kind of white space aside; items below LEAST signs
    are found unedited. A stretch that two finds share is given once. NULL and empty texts and
    items match nothing; rows that repeat are each searched. Every task holds at most
    about ITEMS bytes of items; more are searched in parts, one narrow pass each, whose finds are stored.
    """
    rows = benchmark.select(quoted(item_id).alias("item_id"), quoted(item_text).alias("text")).where(
        F.col("text").isNotNull()
    )
    parts, size = [[]], 0
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        size += (more := len(r["text"].encode("utf-8", "replace")))
        if size > ITEMS and parts[-1]:
            parts.append([])
            size = more
        parts[-1].append((r["item_id"], r["text"]))
    texts = docs.select(quoted(id_column).alias("doc_id"), quoted(text_column).cast("binary").alias("text"))
    kinds = [s.schema[c].dataType.simpleString() for s, c in ((texts, "doc_id"), (rows, "item_id"))]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, edits long, start long, end long"
    found = None
    for part in parts:
        items = docs.sparkSession.sparkContext.broadcast(Items(part, rate))
        own = texts.mapInPandas(searcher(items), schema)
        if len(parts) > 1:
            own = stored(own, "passages")
            items.destroy()
        found = own if found is None else found.unionAll(own)
    return found


def searcher(items):
    """The pass over texts that finds the items of a broadcast."""

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for at in range(0, len(frame), TOGETHER):
                found += items.value.matches(frame["text"].iloc[at : at + TOGETHER].tolist())
            out = [(doc, *match) for doc, own in zip(frame["doc_id"], found) for match in own]
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "edits", "start", "end"], dtype=object)

    return search
