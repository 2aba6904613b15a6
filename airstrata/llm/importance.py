"""Importance resampling towards a target: hashed n-gram counts, Gumbel scores, the highest drawn.

A 256-byte table lower-cases A to Z and blanks separators in the UTF-8 bytes, ``bytes.split``
gives the words, and the CRC-32 of an n-gram is the seed from which that of the n-gram one word
longer is computed, so every word is hashed once per length. Each task counts its buckets in one
array, so at most one row per bucket and task is shuffled and the model is a list of ``buckets`` gains.
"""

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.rows import quoted
from .common import stored
from .order import numbered

BUCKETS = 10_000
LONGEST = 3
SHARE = (5, 100)
LEAST_WORDS = 20
SEED = 42
BLOCK = 1 << 16  # words hashed at a time
# Digits, a to z and all bytes of other characters are kept, A to Z lower-cased, the rest blanked.
LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(LETTERS).split()


def buckets_of(words: list[bytes], buckets: int, longest: int = LONGEST) -> Iterator[np.ndarray]:
    """The buckets of all runs of 1 to ``longest`` words, a block of first words at a time."""
    for start in range(0, len(words), BLOCK):
        part = words[start : start + BLOCK + longest - 1]
        hashes, follow = list(map(crc32, part[:BLOCK])), [b" " + w for w in part]
        for n in range(1, longest + 1):
            if n > 1:
                hashes = list(map(crc32, follow[n - 1 :], hashes))  # ends with the shorter list
            yield np.array(hashes, np.int64) % buckets


def counted(texts: DataFrame, buckets: int, longest: int) -> DataFrame:
    """bucket, n: how many features of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                for found in buckets_of(words_of(text.as_py()), buckets, longest):
                    total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": some, "n": total[some]})

    return texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """Per bucket 1000 times the logarithm of how much likelier the target makes it, rounded down."""
    all_source, all_target = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    ratios = [
        (float(target.get(b, 0) + 1) * all_source) / (float(source.get(b, 0) + 1) * all_target) for b in range(buckets)
    ]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def weights(texts: DataFrame, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """Per row: doc_id, n_words, n_features and weight, the sum of its features' gains."""
    table = texts.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((batch.num_rows, 3), np.int64)
            for row, text in zip(out, batch.column("text")):
                words = words_of(text.as_py())
                row[0] = len(words)
                for found in buckets_of(words, len(table.value), longest):
                    row[1] += len(found)
                    row[2] += table.value[found].sum()
            numbers = dict(zip(("n_words", "n_features", "weight"), np.ascontiguousarray(out.T)))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **numbers})

    return texts.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def gumbel(seed: int) -> Column:
    """1000 times a Gumbel variate that follows from the seed and the id, rounded down."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    share: tuple[int, int] = SHARE,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight, score and rank (NULL if not drawn).

    Of the rows with at least ``least_words`` words the ``share`` with the highest scores is drawn without
    replacement; ties go to the smaller id (a NULL id comes last and is hashed like an empty one), then
    to the smaller weight, then as stored. NULL and empty texts have no features and weight
    zero. Rows that repeat are drawn as rows of their own. An empty target makes all its
    counts zero; an empty table gives no rows. Texts are read twice, for the counts and for the
    weights; only ids and numbers are kept in between.
    """

    def of(table: DataFrame, column: str) -> dict[int, int]:
        # At most one row per bucket.
        return {r["bucket"]: r["n"] for r in counted(table.select(quoted(column).alias("text")), buckets, longest).collect()}

    texts = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).alias("text"))
    gain = gains(of(docs, text_column), of(target, target_text), buckets)
    scored = stored(weights(texts, gain, longest), "weights").withColumn("score", F.col("weight") + gumbel(seed))
    enough = F.col("n_words") >= least_words
    by = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight"), F.col("n_features")]
    ranked = numbered(scored.where(enough), by)
    drawn = F.col("position") < F.floor(F.col("size") * share[0] / share[1])
    ranked = ranked.withColumn("rank", F.when(drawn, F.col("position") + 1)).drop("position", "size")
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)
