"""Windows of a fixed length that occur more than once, found from anchors, exactly.

The two operators on repeated passages share this outline; they differ in their
units (bytes or words), their anchors, and in what counts as a repeat.

An anchor stands for a range of window starts. Its *core* is a stretch that all
those windows hold, its *hull* the stretch that they cover together. Two equal windows
have anchors with the same core. So, in this order:

1. Cores are counted. A small bit table of those met twice (it may let others
   pass, never drops one) thins out the anchors, and only what passes is kept.
2. Anchors whose whole hull is repeated are settled: all their windows are repeats.
3. What is left has a repeated core in different surroundings, as at the ends of a
   shared passage. Parts of the ranges go through the same two tests, at last
   single windows, whose core and hull are the window itself.

Hulls and windows are compared by two 64-bit hashes each.

Rows that repeat (one id, one text) are searched once, with their number, so work and
output grow with the rows, never with the square of a group.

Texts are shuffled only where they may meet ranges: a second bit table, of the documents that
have some (it lets others pass too, never drops one), holds the rest back where it was read.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..operators.rows import quoted
from .common import stored

NO_ID = -(1 << 63)  # stands for a NULL id
SPLIT = 1024  # copies of a row that get their ranges in one group
TABLE_BITS = 28  # the bit table of cores has 2 ** TABLE_BITS bits at most: 32 MB, whatever the input
SPARE = 16  # bits for each core, up to there: with two of them set, 1 in 70 others passes
LISTED_BITS = 25  # the bit table of documents: at most 2 ** LISTED_BITS / 64 rows
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
RANDOM = np.random.Generator(np.random.Philox(20)).integers(0, 1 << 64, (2, 256), dtype=np.uint64)
POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Arrays of whole numbers wrap around without a warning, here and below."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2 ** 64, at least ``n`` of them."""
    known = POWERS.get(which)
    if known is None or len(known[0]) < n:
        size = max(1 << 16, 1 << int(n).bit_length())
        made = []
        for base in (BASES[which], pow(BASES[which], -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        known = POWERS[which] = (made[0], made[1])
    return known


class Hashes:
    """Hashes of any stretch of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, which: int):
        up, self.down = powers(which, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = self.sums.take(end)
        raw -= self.sums.take(start)
        raw *= self.down.take(start)
        raw += (end - start).astype(np.uint64) * np.uint64(BASES[1])
        return mixed(raw)


class Sequence:
    """The units of one text with their hashes, and its anchors: ranges of window starts.

    ``values`` gives the units' 64-bit values of the first or second kind; each is hashed when
    first needed. ``anchors()`` gives arrays: core (hashes), first and last start, anchor.
    """

    def __init__(self, values: Callable[[int], np.ndarray], n: int, window: int):
        self.values, self.n, self.window = values, n, window
        self.made: dict[int, Hashes] = {}

    def hashes(self, which: int) -> Hashes:
        if which not in self.made:
            self.made[which] = Hashes(self.values(which), which)
        return self.made[which]

    def hulls(self, first: np.ndarray, last: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of ranges whose anchor is at ``at``; where it lies in the hull counts."""
        return mixed(
            self.hashes(1)(first, last + self.window)
            + (at - first).astype(np.uint64) * np.uint64(BASES[0])
            + (last - first).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)
        )


def different(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers in ascending order, and how often each occurs."""
    x = np.sort(x)
    other = np.ones(len(x) + 1, bool)
    np.not_equal(x[1:], x[:-1], out=other[1:-1])
    if not len(x):
        return x, np.zeros(0, np.int64)
    bounds = np.flatnonzero(other)
    return x[bounds[:-1]], np.diff(bounds)


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def keyed(docs: DataFrame, id_column: str, text_column: str, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc (the id, or NO_ID), mark (a hash of the text), the text's bytes, and the carried columns."""
    text = F.coalesce(quoted(text_column).cast("binary"), F.lit(b""))
    return docs.select(
        F.coalesce(quoted(id_column).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(text).alias("mark"),
        text.alias("text"),
        *[quoted(c).alias(f"carried {c}") for c in carried],
    )


def copied(units: DataFrame) -> DataFrame:
    """doc, mark, copies of the rows that repeat."""
    return stored(units.groupBy("doc", "mark").agg(F.count("*").alias("copies")).where("copies > 1"), "copies")


def once(units: DataFrame, copies: DataFrame) -> DataFrame:
    """One row per document and text: doc, mark, text, copies.

    Every task reduces the rows that repeat to one of each before they are shuffled; the others stay.
    """
    alone = units.join(copies, ["doc", "mark"], "left_anti")
    several = units.join(copies, ["doc", "mark"]).groupBy("doc", "mark")
    several = several.agg(F.first("text").alias("text"), F.first("copies").alias("copies"))
    return alone.select("doc", "mark", "text", F.lit(1).cast("long").alias("copies")).unionByName(several)


def listed(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` with ``listed``: true if doc and mark are among the ``keys``, seldom otherwise.

    The table is joined by broadcast, so no row moves. With 3 million different keys a
    tenth of the other rows pass, with many more most: that costs a shuffle, never a row.
    """
    slot = F.xxhash64("doc", "mark").bitwiseAND(F.lit((1 << LISTED_BITS) - 1))
    words = bit_words(keys.select(slot.alias("slot")))
    marked = rows.withColumn("slot", slot).withColumn("word", F.shiftright("slot", 6))
    known = marked.join(F.broadcast(words), "word", "left")
    bit = F.expr("coalesce(shiftright(bits, cast(slot & 63 AS int)) & 1, 0) = 1")
    return known.withColumn("listed", bit).drop("slot", "word", "bits")


def with_places(rows: DataFrame, places: DataFrame, copies: DataFrame) -> DataFrame:
    """Every row with the ``places`` of its document and text; many copies are dealt over several groups."""
    rows = listed(rows, places)
    others = rows.where("not listed").drop("listed")
    parts = F.ceil(F.coalesce("copies", F.lit(1)) / SPLIT)
    dealt = rows.where("listed").drop("listed").join(copies, ["doc", "mark"], "left").withColumn(
        "part", F.pmod(F.monotonically_increasing_id(), parts)
    ).drop("copies")
    spread = places.join(copies, ["doc", "mark"], "left").select(
        "doc", "mark", "places", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part")
    )
    placed = dealt.join(spread, ["doc", "mark", "part"], "left").drop("part")
    return placed.unionByName(others, allowMissingColumns=True)


def bit_words(slots: DataFrame) -> DataFrame:
    """word, bits: the bits that are set by the numbers in ``slot``, 64 in a row."""
    return slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS int)))").alias("bits")
    )


def bit_table(cores: DataFrame) -> np.ndarray:
    """A table of bits, two set for each core, larger for more of them; at most 2 ** TABLE_BITS / 64 rows come back."""
    cores = stored(cores, "cores")
    bits = min(TABLE_BITS, max(16, (SPARE * cores.count()).bit_length()))
    upper = F.shiftrightunsigned("core", 64 - bits)
    lower = F.shiftrightunsigned("core", 64 - 2 * bits).bitwiseAND(F.lit((1 << bits) - 1))
    found = bit_words(cores.select(F.explode(F.array(upper, lower)).alias("slot"))).toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[found["word"].to_numpy()] = found["bits"].to_numpy()
    return table.view(np.uint64)


def in_table(table: np.ndarray, cores: np.ndarray) -> np.ndarray:
    bits = len(table).bit_length() + 5

    def is_set(slot: np.ndarray) -> np.ndarray:
        return (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)) > 0

    found = is_set(cores >> np.uint64(64 - bits))
    left = np.flatnonzero(found)
    found[left] = is_set(cores[left] >> np.uint64(64 - 2 * bits) & np.uint64((1 << bits) - 1))
    return found


def grouped(core, hull, first, last, at, doc: int, mark: int, copies: int) -> tuple:
    """Per different (core, hull) of a document a row with their number, in all copies, and their ranges.

    ``places`` holds 32-bit numbers, three for each range: first, last, anchor.
    """
    order = np.lexsort((first, hull, core))
    core, hull = core[order], hull[order]
    ranges = np.stack([first, last, at], axis=1)[order].astype("<i4")
    other = np.ones(len(core) + 1, bool)
    other[1:-1] = (core[1:] != core[:-1]) | (hull[1:] != hull[:-1])
    bounds = np.flatnonzero(other)
    new, ends = bounds[:-1], bounds[1:]
    raw, size = ranges.tobytes(), ranges.itemsize * 3
    places = [raw[a * size : b * size] for a, b in zip(new.tolist(), ends.tolist())]
    same = np.full(len(new), doc), np.full(len(new), mark)
    return signed(core[new]), signed(hull[new]), *same, (ends - new) * copies, places


def together(rows: list[tuple]) -> Iterator[pd.DataFrame]:
    """The rows of many documents as one frame."""
    if rows:
        columns = list(zip(*rows))
        made = [np.concatenate(c) for c in columns[:-1]] + [[p for c in columns[-1] for p in c]]
        yield pd.DataFrame(dict(zip(NAMES, made)))


def in_places(places) -> np.ndarray:
    """All (first, last, anchor) in a list of ``places``."""
    return np.frombuffer(b"".join(places), "<i4").reshape(-1, 3).astype(np.int64)


def ranges_of(places) -> np.ndarray:
    """The different (first, last, anchor) in a list of ``places``."""
    if places is None or not len(places):
        return np.zeros((0, 3), np.int64)
    return np.unique(in_places(places), axis=0)


def joined(ranges: np.ndarray) -> np.ndarray:
    """The same starts in as few ranges as can be, in order; a range's first start becomes its anchor."""
    if not len(ranges):
        return ranges
    ranges = ranges[np.argsort(ranges[:, 0])]
    first, end = ranges[:, 0], np.maximum.accumulate(ranges[:, 1])
    new = np.flatnonzero(np.r_[True, first[1:] > end[:-1] + 1])
    return np.stack([first[new], end[np.r_[new[1:], len(end)] - 1], first[new]], axis=1)


ROW = "core long, hull long, doc long, mark long, n long, places binary"
NAMES = ["core", "hull", "doc", "mark", "n", "places"]


def decided(rows: DataFrame, earlier: bool, single: bool = False) -> DataFrame:
    """Rows with ``settled`` (their hull is a repeat) and ``open`` (to be looked at closer).

    ``earlier``: a repeat is one that also occurs in a document with a smaller id;
    else one that occurs anywhere else. Counts and minima are reduced by each task
    before they are shuffled. What is joined on a core is written before and after, so that
    adaptive execution may split the join at a core with many hulls. ``single``: rows are
    single windows, of which none is left open.
    """
    hulls = rows.groupBy("core", "hull").agg(F.sum("n").alias("times"), F.min(F.struct("doc", "mark")).alias("top"))
    if single:
        known = stored(hulls.where("times > 1").withColumn("kinds", F.lit(None).cast("long")), "known")
    else:
        hulls = stored(hulls, "hulls")
        kinds = stored(hulls.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1"), "kinds")
        known = stored(hulls.join(kinds, "core", "left").where("times > 1 or kinds is not null"), "known")
    one = F.col("top.doc") == F.col("doc")
    if earlier:
        settled, speaks = F.col("top.doc") < F.col("doc"), one
    else:
        settled = F.col("times") > 1
        speaks = one & (F.col("top.mark") == F.col("mark"))
    return (
        rows.join(known, ["core", "hull"])
        .withColumn("settled", settled)
        .withColumn("open", speaks & F.col("kinds").isNotNull())
        .where("settled or open")
        .select("doc", "mark", "places", "settled", "open")
    )


def finer(rows: DataFrame, units: DataFrame, read: Callable, step: int, earlier: bool) -> DataFrame:
    """Split the open ranges into ranges of at most ``step`` starts and decide those.

    Ranges are split at multiples of ``step`` before their anchor, so that equal
    windows come into like ranges; a range of one start is told by its content only.
    """
    open_places = rows.where("open").groupBy("doc", "mark").agg(F.collect_list("places").alias("places"))
    some = listed(units, rows.where("open").select("doc", "mark")).where("listed").drop("listed")
    seen = some.join(open_places, ["doc", "mark"])

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            columns = (frame[c] for c in ("doc", "mark", "text", "copies", "places"))
            for doc, mark, text, copies, held in zip(*columns):
                own, ranges = read(text), ranges_of(held)
                top = (ranges[:, 2] - ranges[:, 0]) // step  # the block of the first start
                sizes = top - (ranges[:, 2] - ranges[:, 1]) // step + 1
                owner = np.repeat(np.arange(len(ranges)), sizes)
                block = top[owner] - np.arange(len(owner)) + np.repeat(np.cumsum(sizes) - sizes, sizes)
                at = ranges[owner, 2]
                early, late = at - (block + 1) * step + 1, at - block * step
                first, last = np.maximum(early, ranges[owner, 0]), np.minimum(late, ranges[owner, 1])
                core = own.hashes(0)(late, early + own.window)
                if step == 1:
                    _, once = np.unique(first, return_index=True)
                    core, first, last, at = core[once], first[once], last[once], first[once]
                out.append(grouped(core, own.hulls(first, last, at), first, last, at, doc, mark, copies))
            yield from together(out)

    return decided(stored(seen.mapInPandas(split, ROW), "parts"), earlier, single=step == 1)


def repeated_ranges(units: DataFrame, read: Callable, earlier: bool) -> DataFrame:
    """doc, mark, places: ranges of starts of all windows that are repeats.

    ``units`` are those of ``once``; ``read`` turns the bytes of a text into a Sequence with ``anchors()``.
    """
    spark = units.sparkSession

    def cores(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [different(read(t).anchors()[0]) for t in frame["text"]]
            one = {"core": signed(np.concatenate([c for c, _ in found]))}
            if earlier:
                one["doc"] = np.repeat(frame["doc"].to_numpy(), [len(c) for c, _ in found])
            else:
                one["n"] = np.concatenate([n * k for (_, n), k in zip(found, frame["copies"])])
            yield pd.DataFrame(one)

    if earlier:
        met = units.select("doc", "text").mapInPandas(cores, "core long, doc long").groupBy("core")
        twice = met.agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b")
    else:
        met = units.select("text", "copies").mapInPandas(cores, "core long, n long").groupBy("core")
        twice = met.agg(F.sum("n").alias("n")).where("n > 1")
    table = spark.sparkContext.broadcast(bit_table(twice.select("core")))

    def kept(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc, mark, text, copies in zip(*(frame[c] for c in ("doc", "mark", "text", "copies"))):
                own = read(text)
                core, first, last, at = own.anchors()
                few = in_table(table.value, core)
                if few.any():
                    core, first, last, at = (x[few] for x in (core, first, last, at))
                    out.append(grouped(core, own.hulls(first, last, at), first, last, at, doc, mark, copies))
            yield from together(out)

    return decided(stored(units.mapInPandas(kept, ROW), "anchors"), earlier)
