"""Near duplicates by SimHash, found with vantage-point trees over Hamming distance.

Two fingerprints within ``radius`` bits are, on at least one of their two 32-bit
halves, within ``radius // 2`` bits. For each half a tree of vantage points divides all
fingerprints into cells: at a node, those within the node's distance of its
vantage point go left, the others right. By the triangle inequality a partner of a
fingerprint at distance d can only lie on the other side if d is within ``radius // 2``
of the border, so just those fingerprints visit both sides. Every fingerprint lives in
one cell per half and looks for partners in the cells it visits; any pair in reach
meets there, and its full distance is checked.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..operators.rows import quoted
from .common import stored
from .components import components

RADIUS = 3
SHINGLE = 3
CELL = 256  # fingerprints of the sample per cell, where the tree stops dividing
SAMPLE = 1 << 17  # fingerprints from which the trees are built
BLOCK = 2048  # fingerprints compared at once
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ONES = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x) if hasattr(np, "bitwise_count") else sum(
        ONES[(x >> np.uint64(s)) & np.uint64(0xFFFF)] for s in (0, 16, 32, 48)
    )


def simhash(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the UTF-8 text: a bit is set if it is in over half the shingle hashes."""
    words = WORD.findall((text or b"").translate(LOWER))
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-1]])
        parts = [
            line[a:b] for a, b in zip(starts[: 1 - shingle].tolist(), (ends[shingle - 1 :] - 1).tolist())
        ]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(p, 42) for p in parts), np.uint64, len(parts))
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        some = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.flatnonzero(2 * total > len(hashes))
    return sum(1 << int(b) for b in set_bits)


def fingerprints(docs: DataFrame, id_column="doc_id", text_column="text", shingle: int = SHINGLE) -> DataFrame:
    """Per row: doc_id and its fingerprint as a signed 64-bit number; one narrow pass."""
    rows = docs.select(quoted(id_column).alias("doc_id"), quoted(text_column).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def mark(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = np.array([simhash(t, shingle) for t in frame["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "fp": found.view(np.int64)})

    return rows.mapInPandas(mark, f"doc_id {kind}, fp long")


def grow(points: np.ndarray, reach: int, cell: int, seed: int) -> list[tuple]:
    """A tree over 32-bit halves: (vantage point, border distance, left, right) or leaves as None.

    Of some candidates the vantage point with the fewest points near the border
    is taken. A cell that no candidate divides well stays whole.
    """
    rng = np.random.default_rng(seed)
    nodes: list = []

    def build(own: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append(None)
        if len(own) <= cell or depth >= 40:
            return at
        best = None
        trial = own if len(own) <= 4096 else rng.choice(own, 4096, replace=False)
        for point in (*rng.choice(own, 6), *rng.integers(0, 1 << 32, 6, dtype=np.uint64)):
            far = bits(trial ^ point)
            for border in np.unique(np.quantile(far, [0.35, 0.5, 0.65]).astype(int)):
                # What the two sides would hold together, squared as comparing costs.
                left = np.count_nonzero(far <= border + reach) / len(far)
                right = np.count_nonzero(far > border - reach) / len(far)
                own_left = np.count_nonzero(far <= border) / len(far)
                cost = own_left * left + (1 - own_left) * right
                if best is None or cost < best[0]:
                    best = (cost, point, int(border))
        if best is None or best[0] > 0.9:
            return at
        _, point, border = best
        far = bits(own ^ np.uint64(point))
        sides = build(own[far <= border], depth + 1), build(own[far > border], depth + 1)
        nodes[at] = (int(point), border, *sides)
        return at

    build(points, 0)
    return nodes


def visits(nodes: list[tuple], halves: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, home): the cells each half visits; one of them is its home."""
    out = []
    todo = [(0, np.arange(len(halves)), np.ones(len(halves), bool))]
    while todo:
        at, rows, home = todo.pop()
        if not len(rows):
            continue
        if nodes[at] is None:
            out.append((rows, np.full(len(rows), at), home))
            continue
        point, border, left, right = nodes[at]
        far = bits(halves[rows] ^ np.uint64(point)).astype(np.int64)
        to_left, to_right = far <= border + reach, far > border - reach
        todo.append((left, rows[to_left], (home & (far <= border))[to_left]))
        todo.append((right, rows[to_right], (home & (far > border))[to_right]))
    if not out:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*out))


class Forest:
    """Union of row numbers, the smaller root on top."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def links_in_cell(home: np.ndarray, guests: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Enough pairs within ``radius`` to connect what is connected in this cell.

    Home fingerprints are compared with all in the cell, a block at a time; a pair
    that is connected already adds nothing, so no more links leave than there
    are fingerprints.
    """
    everyone = np.concatenate([home, guests])
    forest, links = Forest(len(everyone)), []
    for a in range(0, len(home), BLOCK):
        mine = home[a : a + BLOCK]
        for b in range(a, len(everyone), BLOCK):
            near = bits(mine[:, None] ^ everyone[None, b : b + BLOCK]) <= radius
            for i, j in zip(*np.nonzero(near)):
                if a + i != b + j and forest.join(int(a + i), int(b + j)):
                    links.append((int(mine[i]), int(everyone[b + j])))
    return links


def links(distinct: DataFrame, radius: int = RADIUS, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """Pairs ``u, v`` of different fingerprints within ``radius`` bits, enough for all components.

    ``distinct`` holds each fingerprint once in ``fp``. The trees are built on the
    driver from at most ``sample`` of them, chosen by hash; all are dealt into cells.
    A cell far larger than planned is divided: its home fingerprints are
    dealt over several tasks, each of which sees all that visit the cell.
    """
    spark, reach = distinct.sparkSession, radius // 2
    n = distinct.count()
    draw = F.pmod(F.xxhash64("fp"), F.lit(1 << 30))
    some = distinct.where(draw <= int((1 << 30) * min(1.0, sample / max(n, 1)))).limit(2 * sample)
    known = np.array([r["fp"] for r in some.collect()], np.int64).view(np.uint64)
    known.sort()
    low = np.uint64(0xFFFFFFFF)
    halves = (known & low, known >> np.uint64(32))
    # Cells hold CELL fingerprints of the sample, but no more of all than a block or two.
    least = max(8, min(cell, int(cell * len(known) / max(n, 1))))
    trees = [grow(h, reach, least, seed) for seed, h in enumerate(halves)]
    shared = spark.sparkContext.broadcast(trees)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fp = frame["fp"].to_numpy(np.int64)
            for side, tree in enumerate(shared.value):
                own = fp.view(np.uint64)
                half = own & low if side == 0 else own >> np.uint64(32)
                rows, cells, home = visits(tree, half, reach)
                yield pd.DataFrame({"cell": cells * 2 + side, "home": home, "fp": fp[rows]})

    dealt = stored(distinct.select("fp").mapInPandas(deal, "cell long, home boolean, fp long"), "cells")
    sizes = dealt.groupBy("cell").agg(
        F.count_if("home").alias("homes"), F.count("*").alias("all")
    )
    # The number of shares follows the work of a cell: homes times visitors.
    work = float(16 * BLOCK * BLOCK)
    large = {
        r["cell"]: int(min(256, 1 + r["homes"] * r["all"] // work))
        for r in sizes.where(F.col("homes").cast("double") * F.col("all") > work).collect()
    }
    shares = F.lit(1)
    if large:
        listed = F.create_map(*[F.lit(x) for pair in large.items() for x in pair])
        shares = F.coalesce(F.try_element_at(listed, "cell"), F.lit(1))
    # A fingerprint is at home in one share of its cell and a guest in the others.
    own = F.pmod(F.xxhash64("fp", F.lit(7)), shares)
    spread = dealt.withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1))).withColumn(
        "home", F.col("home") & (F.col("share") == own)
    )

    def find(frame: pd.DataFrame) -> pd.DataFrame:
        fp, home = frame["fp"].to_numpy(np.int64).view(np.uint64), frame["home"].to_numpy(bool)
        found = links_in_cell(np.sort(fp[home]), np.sort(fp[~home]), radius)
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"u": pairs[:, 0], "v": pairs[:, 1]})

    return spread.groupBy("cell", "share").applyInPandas(find, "u long, v long")


def groups(marks: DataFrame, radius: int = RADIUS) -> DataFrame:
    """fp and component_id, the smallest ``doc_id`` of its group, from rows of ``doc_id, fp``."""
    distinct = stored(marks.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    pairs = links(distinct, radius)
    stars = components(pairs, "near-links")
    # Of each linked fingerprint the root, then of each root the smallest id below it.
    rooted = distinct.join(stars.withColumnRenamed("u", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("v", "fp").alias("root")
    )
    tops = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("fp", "root").join(tops, "root").select("fp", "component_id")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id.

    Documents whose fingerprints differ in ``radius`` or fewer bits are linked,
    whatever their texts; ``component_id`` is the smallest doc_id reachable. NULL
    and empty texts, or texts of white space, have fingerprint zero and link like any
    other. Equal fingerprints are one node of the graph, with the smallest id, so a
    group of copies costs no pairs. Rows that repeat each get their row; a NULL
    id gets the component of its fingerprint (NULL only where no id is known there).
    """
    marks = stored(fingerprints(docs, id_column, text_column, shingle), "simhash")
    return marks.join(groups(marks, radius), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
