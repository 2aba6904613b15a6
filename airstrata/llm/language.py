"""Language of whole texts: the nearest of several centroids per language, or none."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.rows import quoted

UNDETERMINED = "und"
DIMENSIONS = 4096  # hashed 1- to 3-grams of letters
CENTROIDS = 4  # per language
SAMPLE = 2000  # texts per language that place the centroids
ROUNDS = 12
USUAL = 0.999  # share of a language's training texts whose distance counts; the rest may be mislabelled
BINS = 1000  # in which distances are counted
SLACK = 0.05  # added to the distance of that share
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
LETTERS: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    """For every code point whether it is a letter; made once per process."""
    if not LETTERS:
        LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return LETTERS[0]


def gram_counts(text: str | None) -> np.ndarray | None:
    """How often each hashed gram occurs in the whole text; None without a letter.

    Lower case; a run of anything but letters counts as one gap.
    """
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    letter = is_letter()[points]
    if not letter.any():
        return None
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    signs = np.where(letter, points, 0)[keep].astype(np.uint64)
    counts = np.zeros(DIMENSIONS, np.int64)
    shift = np.uint64(64 - int(DIMENSIONS).bit_length() + 1)
    gram = signs * MIX[0]
    for n in range(1, 4):
        if n > 1:
            gram = gram[:-1] * MIX[1] + signs[n - 1 :] * MIX[0]
        mixed = (gram ^ (gram >> np.uint64(29))) * MIX[2]
        counts += np.bincount((mixed >> shift).astype(np.int64), minlength=DIMENSIONS)
    return counts


def vectors(counts: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors, one row per text."""
    weights = np.log1p(np.array(counts, np.float32).reshape(-1, DIMENSIONS)) * idf
    length = np.linalg.norm(weights, axis=1, keepdims=True)
    return weights / np.where(length > 0, length, 1)


def spherical_means(rows: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """``k`` unit centroids by cosine; the first is the mean, further ones start far off.

    Not at the very farthest rows, a two-hundredth of all, which may be mislabelled.
    """
    centres = [rows.mean(axis=0)]
    nearest = rows @ (centres[0] / (np.linalg.norm(centres[0]) or 1))
    while len(centres) < min(k, len(rows)):
        centres.append(rows[int(np.argsort(nearest, kind="stable")[len(rows) // 200])])
        nearest = np.maximum(nearest, rows @ centres[-1])
    centre = np.array(centres)
    for _ in range(rounds):
        centre = centre / np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-12)
        own = (rows @ centre.T).argmax(axis=1)
        centre = np.array(
            [rows[own == i].mean(axis=0) if (own == i).any() else centre[i] for i in range(len(centre))]
        )
    return centre / np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-12)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each gram occurs, and how many texts have letters.

    Each task adds up its own; at most DIMENSIONS + 1 numbers come back.
    """

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(DIMENSIONS + 1, np.int64)
        for frame in frames:
            for text in frame["text"]:
                counts = gram_counts(text)
                if counts is not None:
                    total[:-1] += counts > 0
                    total[-1] += 1
        used = np.flatnonzero(total)
        yield pd.DataFrame({"gram": used, "texts": total[used]})

    sums = texts.select("text").mapInPandas(add, "gram long, texts long")
    out = np.zeros(DIMENSIONS + 1, np.int64)
    for gram, n in sums.groupBy("gram").agg(F.sum("texts")).collect():
        out[gram] = n
    return out[:-1], int(out[-1])


def fit(training: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> dict:
    """Centroids per language from rows of ``doc_id, text, lang``.

    Document frequencies cover all rows. The centroids are placed by about
    ``sample`` texts per language, chosen by a hash of the id (at most twice
    that many); each language is fitted in a task of its own. How far a text may be
    from its language comes from all rows: USUAL of its training texts are no farther.
    """
    labelled = training.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return {"langs": [], "centres": np.zeros((0, DIMENSIONS), np.float32), "idf": None, "far": []}
    frequency, n = document_frequencies(labelled)
    idf = np.log((1 + n) / (1 + frequency)).astype(np.float32) + np.float32(1)
    share = F.create_map(
        *[F.lit(x) for lang, size in sizes.items() for x in (lang, min(1.0, sample / size))]
    )
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000)) / 1_000_000
    chosen = labelled.where(draw < F.try_element_at(share, F.col("lang")))

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "text"]).head(2 * sample)
        counts = [c for c in map(gram_counts, frame["text"]) if c is not None]
        if not counts:
            return pd.DataFrame({"lang": [], "centre": []})
        rows = vectors(counts, idf)
        centre = spherical_means(rows, centroids)
        made = [x.astype("<f4").tobytes() for x in centre]
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "centre": made})

    fitted = (
        chosen.select("doc_id", "text", "lang")
        .groupBy("lang")
        .applyInPandas(place, "lang string, centre binary")
        .orderBy("lang", "centre")
        .collect()
    )
    centres = np.array([np.frombuffer(r["centre"], "<f4") for r in fitted], np.float32)
    langs, centres = [r["lang"] for r in fitted], centres.reshape(-1, DIMENSIONS)
    usual = usual_distances(labelled, langs, centres, idf)
    return {"langs": langs, "centres": centres, "idf": idf, "far": [usual[lang] + SLACK for lang in langs]}


def usual_distances(labelled: DataFrame, langs: list[str], centres: np.ndarray, idf: np.ndarray) -> dict[str, float]:
    """Per language the distance to its nearest centroid that USUAL of its texts do not exceed.

    Each task counts its own texts by language and bin of distance; at most BINS + 1 numbers
    per language come back.
    """
    own = {lang: np.array([lang == other for other in langs]) for lang in set(langs)}

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {lang: np.zeros(BINS + 1, np.int64) for lang in own}
        for whole in frames:
            for at in range(0, len(whole), 512):
                frame = whole.iloc[at : at + 512]
                told = [(lang, gram_counts(text)) for lang, text in zip(frame["lang"], frame["text"])]
                told = [(lang, counts) for lang, counts in told if lang in own and counts is not None]
                if told:
                    near = vectors([counts for _, counts in told], idf) @ centres.T
                    for (lang, _), row in zip(told, near):
                        distance = min(max(1 - float(row[own[lang]].max()), 0.0), 1.0)
                        total[lang][int(np.ceil(distance * BINS))] += 1
        for lang, counts in total.items():
            used = np.flatnonzero(counts)
            yield pd.DataFrame({"lang": lang, "bin": used, "texts": counts[used]})

    counted = labelled.select("lang", "text").mapInPandas(count, "lang string, bin long, texts long")
    found = counted.groupBy("lang", "bin").agg(F.sum("texts").alias("texts")).collect()
    out = {}
    for lang in own:
        counts = np.zeros(BINS + 1, np.int64)
        for r in found:
            if r["lang"] == lang:
                counts[r["bin"]] = r["texts"]
        passed = np.cumsum(counts)
        out[lang] = float(np.searchsorted(passed, USUAL * passed[-1])) / BINS
    return out


def predict(docs: DataFrame, model: dict, id_column: str = "doc_id", text_column: str = "text"):
    """Per row: doc_id, lang_pred, score, rejected.

    ``score`` is the cosine to the nearest centroid. NULL texts, texts without a
    letter, and all texts where nothing was learned get ``und``, score 0, and are
    rejected; so is, with its nearest language kept, a text farther from its
    centroid than USUAL of the training texts of that language by more than SLACK. Equal
    distances go to the language that sorts first. Whole texts are used.
    """
    rows = docs.select(quoted(id_column).alias("doc_id"), quoted(text_column).alias("text"))
    key = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for whole in frames:
            for at in range(0, len(whole), 512):
                frame = whole.iloc[at : at + 512]
                langs, scores = [UNDETERMINED] * len(frame), np.zeros(len(frame))
                rejected = np.ones(len(frame), bool)
                counts = [gram_counts(t) if known["langs"] else None for t in frame["text"]]
                found = [i for i, c in enumerate(counts) if c is not None]
                if found:
                    near = vectors([counts[i] for i in found], known["idf"]) @ known["centres"].T
                    for i, best, row in zip(found, near.argmax(axis=1), near):
                        langs[i] = known["langs"][best]
                        scores[i] = min(max(float(row[best]), 0.0), 1.0)
                        rejected[i] = 1 - row[best] > known["far"][best]
                yield pd.DataFrame(
                    {"doc_id": frame["doc_id"], "lang_pred": langs, "score": scores, "rejected": rejected}
                )

    schema = f"doc_id {key}, lang_pred string, score double, rejected boolean"
    return rows.mapInPandas(label, schema)


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a document is kept out of training; a NULL id counts as empty text."""
    text = F.coalesce(quoted(id_column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(3)) == 1


def identify(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang"):
    """Learn from the rows that are not held out, and label all of them."""
    named = docs.select(
        quoted(id_column).alias("doc_id"),
        quoted(text_column).alias("text"),
        quoted(lang_column).alias("lang"),
    )
    model = fit(named.where(~held_out()))
    return predict(named, model).withColumn("held_out", held_out())
