"""Quality without given labels: overlapping heuristics, their accuracies, a linear scorer.

Heuristic labellers vote on each text or abstain, for two aspects: form (junk or
prose) and tone (abusive or not). Expectation-maximisation estimates how often each
labeller is right from how the votes of all texts agree. The posterior of
the votes is the label from which a linear scorer over hashed words learns.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import texts

GOOD, BAD, ABSTAIN = 0, 1, 2
DIMENSIONS = 1 << 18
SAMPLE = 8_000  # texts that train the scorer
EPOCHS = 12
WORD_CACHE = 1_000_000
# Common insults in English, French, German and Spanish, in three groups that vote apart.
INSULTS = (
    frozenset(
        "idiot idiots idiotic moron morons moronic stupid dumb imbecile fool "
        "idiote idiotes crétin crétine crétins imbécile imbéciles abruti abrutie abrutis débile stupide stupides "
        "idioten vollidiot trottel dummkopf schwachkopf blödmann depp deppen dumm blöd "
        "idiota idiotas imbécil estúpido estúpida estúpidos tonto tonta tontos cretino cretinos tarado".split()
    ),
    frozenset(
        "loser losers pathetic worthless useless clown clowns coward "
        "minable minables pathétique pathétiques bouffon bouffons "
        "versager erbärmlich erbärmliche wertlos nutzlos feigling feiglinge "
        "perdedor perdedores patético patética payaso payasos cobarde cobardes inútil inútiles".split()
    ),
    frozenset(
        "trash scum garbage disgusting vermin filth filthy disgrace "
        "ordure ordures racaille vermine dégoûtant dégoûtante dégueulasse crasseux "
        "abschaum dreck gesindel ungeziefer ekelhaft widerlich widerliche "
        "basura escoria asqueroso asquerosa repugnante alimaña alimañas".split()
    ),
)
# Common words of these languages that are not words of the others.
FUNCTION = (
    frozenset("the of and to is that it for was with are this be at not you".split()),
    frozenset("le les des et du dans qui pas sur pour ne au une ce il par".split()),
    frozenset("der die und den das nicht von mit sich ist ein zu auf für dem im".split()),
    frozenset("el los y las del por una con para se al lo su más como pero".split()),
)
SPOKEN = 0.03  # share of a language's common words from which a text is in it
HEARD = 0.1  # of the insulted share of the most insulted language, from which labellers vote
WORD = re.compile(r"[^\W_]+")
SAME = re.compile(r"(.)\1+")
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Groups of insults, then languages, in whose list a word is.
LISTED: dict[str, list[int]] = {}
for number, listed in enumerate(INSULTS + FUNCTION):
    for listed_word in listed:
        LISTED.setdefault(listed_word, []).append(number)
# Kinds of byte: other, lower-case letter, upper-case letter, digit, white space, sign.
KINDS = np.zeros(256, np.int64)
KINDS[[*range(33, 127)]] = 5
KINDS[[*range(97, 123)]] = 1
KINDS[[*range(65, 91)]] = 2
KINDS[[*range(48, 58)]] = 3
KINDS[[9, 10, 11, 12, 13, 32]] = 4
# What labellers measure: name, bad from, good up to (in between they abstain).
FORM = (
    ("signs among visible bytes", 0.2, 0.08),
    ("capitals among letters", 0.6, 0.3),
    ("words equal to the one before", 0.25, 0.05),
    ("words equal to one of the two before", 0.35, 0.12),
    ("pairs of words met before in the text", 0.6, 0.4),
    ("share of the five commonest words", 0.7, 0.5),
    ("words with two or more signs at the end", 0.2, 0.04),
    ("words of signs only", 0.1, 0.02),
    ("words without a letter", 0.3, 0.05),
    ("mean word length off 6 bytes", 5.0, 3.5),
)
TONE = (
    ("insults of group 1", 0.5, 0.0),
    ("insults of group 2", 0.5, 0.0),
    ("insults of group 3", 0.5, 0.0),
    ("insults in all", 1.5, 0.0),
    ("kinds of insult", 1.5, 0.0),
)


class Kinds(dict):
    """For ``str.translate``: digits as 0, A-Z as A, all other letters as a; signs stay."""

    def __missing__(self, place: int) -> str:
        sign = chr(place)
        if sign.isdecimal():
            kind = "0"
        elif "A" <= sign <= "Z":
            kind = "A"
        else:
            kind = "a" if sign.isalnum() else sign
        self[place] = kind
        return kind


@lru_cache(1 << 16)
def shape_feature(kinds: str) -> int:
    """The feature of a word that is not all letters, from its kinds: like ones in a row count as two."""
    return hashed_shape(SAME.sub(r"\1\1", kinds)[-3:])


@lru_cache(1 << 16)
def hashed_shape(shape: str) -> int:
    return xxhash.xxh32_intdigest(shape) % (DIMENSIONS - 1)


class Words(dict):
    """Numbers words, and keeps of each number the hashes and signs of its word.

    Per number: the word hashed to two features, its shape to one, and whether it
    ends in signs, is only signs, has no letter, then its insults per group and
    whether it is a common word of each language.
    """

    def __init__(self, limit: int = WORD_CACHE):
        self.limit = limit
        self.kinds = Kinds()
        self.hashed = np.zeros((limit, 3), np.int32)
        self.signs = np.zeros((limit, 3 + len(INSULTS) + len(FUNCTION)), np.uint8)
        # Single numbers are put in faster through these.
        self.flat_hashed, self.flat_signs = self.hashed.reshape(-1).data, self.signs.reshape(-1).data

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        lower = word.lower()
        joined = lower.strip(SIGNS)
        inner = [joined]
        if not joined.isalpha():  # signs within, digits, or nothing
            inner = WORD.findall(lower)
            joined = " ".join(inner)
        at, signs = number * self.signs.shape[1], self.flat_signs
        if word.isalpha():
            shape = hashed_shape(
                "aa" if word.islower() else "Aa" if word.istitle() else "AA" if word.isupper() else "aA"
            )
        else:
            shape = shape_feature(word.translate(self.kinds))
            last = 0
            while last < len(word) and not word[-1 - last].isalnum():
                last += 1
            signs[at] = 2 <= last < len(word)
            signs[at + 1] = not inner
            signs[at + 2] = not (word[0].isalpha() or any(map(str.isalpha, word)))
        mixed = xxhash.xxh64_intdigest(joined)
        hashed = self.flat_hashed
        hashed[3 * number] = mixed % DIMENSIONS
        hashed[3 * number + 1] = (mixed >> 32) % DIMENSIONS
        hashed[3 * number + 2] = shape
        for w in inner:
            for group in LISTED.get(w, ()):
                signs[at + 3 + group] = min(signs[at + 3 + group] + 1, 255)
        return number

    def numbers(self, text: str | None) -> np.ndarray:
        """The words of a text by number; they hold until the next call."""
        words = (text or "").split()
        if len(self) + len(words) > self.limit:
            signs, hashed = self.signs, self.hashed
            self.clear()
            signs[:] = 0
            hashed[:] = 0
            if len(words) > self.limit:  # a text of more words than are kept
                self.__init__(2 * len(words))
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


TABLES: list[Words] = []


def table() -> Words:
    """One table per worker process."""
    if not TABLES:
        TABLES.append(Words())
    return TABLES[0]


def measures(words: Words, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """What the labellers of form and of tone measure in a text of at least one word; its language.

    Languages are numbered from 1 as in FUNCTION; 0 is any other.
    """
    n = len(ids)
    kinds = np.bincount(KINDS[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)], minlength=6)
    visible, letters = kinds.sum() - kinds[4], kinds[1] + kinds[2]
    distinct, counts = np.unique(ids, return_counts=True)
    signs = words.signs[distinct].astype(np.int64)
    sums = counts @ signs
    repeats = np.count_nonzero(ids[1:] == ids[:-1])
    near = repeats + np.count_nonzero(ids[2:] == ids[:-2])
    pairs = len(np.unique(ids[1:] * (1 << 32) + ids[:-1]))
    form = [
        kinds[5] / max(visible, 1),
        kinds[2] / max(letters, 1),
        repeats / n,
        near / n,
        1 - (pairs + 1) / n if n >= 20 else 0.0,
        np.sort(counts)[-5:].sum() / n if n >= 20 else 0.6,
        sums[0] / n,
        sums[1] / n,
        sums[2] / n,
        abs(visible / n - 6),
    ]
    insults, common = sums[3 : 3 + len(INSULTS)], sums[3 + len(INSULTS) :]
    tone = [*insults, insults.sum(), np.count_nonzero(signs[:, 3 : 3 + len(INSULTS)].any(axis=1))]
    language = int(common.argmax()) + 1 if common.max() >= max(1, SPOKEN * n) else 0
    return np.array(form, float), np.array(tone, float), language


def features(words: Words, ids: np.ndarray) -> tuple[tuple, tuple]:
    """Feature numbers and values for form and for tone.

    Form has hashed shapes of words, in unit length, with the share of repeats;
    tone the presence of words, each under two numbers, so that a word that
    shares one number with an insult has half its weight.
    """
    shapes, counts = np.unique(words.hashed[ids, 2], return_counts=True)
    values = np.log1p(counts)
    values /= np.linalg.norm(values)
    repeats = np.count_nonzero(ids[1:] == ids[:-1])
    places = np.append(shapes, DIMENSIONS - 1)
    present = np.unique(words.hashed[np.unique(ids), :2])
    return (places, np.append(values, 4 * repeats / len(ids))), (present, np.full(len(present), 0.5))


def votes(measures: np.ndarray, rules) -> list[int]:
    return [
        BAD if m >= bad else GOOD if m <= good else ABSTAIN
        for m, (_, bad, good) in zip(measures, rules)
    ]


def code(measures: np.ndarray, rules) -> int:
    """The votes as one number; there are 3 ** labellers patterns."""
    return sum(v * 3**i for i, v in enumerate(votes(measures, rules)))


def decode(pattern: int, labellers: int) -> list[int]:
    return [pattern // 3**i % 3 for i in range(labellers)]


SILENT = code(np.zeros(len(TONE)), TONE)  # no insult: all labellers of tone vote good


def heard(patterns: dict[int, Counter]) -> set[int]:
    """The languages in which labellers of tone vote, from the vote patterns by language.

    Lists of words that meet hardly any insult in a language, beside what they meet in
    another, do not speak as it is written here; unknown languages have no list.
    """
    shares = {k: 1 - p[SILENT] / p.total() for k, p in patterns.items() if k}
    most = max(shares.values(), default=0.0)
    return {k for k, share in shares.items() if share > 0 and share >= HEARD * most}


def accuracies(patterns: dict[int, int], labellers: int, rounds: int = 200):
    """Expectation-maximisation over vote patterns and their counts.

    Returns the share of bad texts, per labeller and class how likely each vote
    is, and per pattern the probability of bad. It starts from the share of bad
    votes, any of which is stronger evidence than a good one.
    """
    keys = list(patterns)
    if not keys:
        return 0.0, np.zeros((labellers, 2, 3)), {}
    ballots = np.array([decode(p, labellers) for p in keys])
    weight = np.array([patterns[p] for p in keys], float)
    shown = ballots[:, :, None] == np.arange(3)
    belief = np.clip((ballots == BAD).any(axis=1) * 0.9, 0.02, 0.98)
    for _ in range(rounds):
        prior = np.clip((weight * belief).sum() / weight.sum(), 1e-4, 0.5)
        given = np.stack([np.einsum("p,plv->lv", weight * b, shown) for b in (1 - belief, belief)], 1)
        given = (given + 0.5) / (given.sum(axis=2, keepdims=True) + 1.5)
        logs = [np.log(given[np.arange(labellers), c, ballots]).sum(axis=1) for c in (0, 1)]
        odds = np.log(prior / (1 - prior)) + logs[1] - logs[0]
        before, belief = belief, 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        if np.abs(before - belief).max() < 1e-9:
            break
    return float(prior), given, dict(zip(keys, belief.tolist()))


def train(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, bias: float = 0.0, seed: int = 7):
    """Weights of a logistic scorer (bias last), by adaptive gradient steps."""
    weight, square = np.zeros(DIMENSIONS + 1), np.full(DIMENSIONS + 1, 1e-8)
    weight[-1] = bias
    order = np.random.default_rng(seed)
    balance = np.where(target > 0.5, min(10.0, len(target) / max(target.sum(), 1) / 2), 1.0)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            places, values = rows[i]
            guess = 1 / (1 + math.exp(-max(-50.0, min(50.0, weight[places] @ values + weight[-1]))))
            step = balance[i] * (guess - target[i])
            if abs(step) < 1e-3:
                continue
            slope = step * values
            square[places] += slope * slope
            weight[places] -= 0.3 * slope / np.sqrt(square[places])
            square[-1] += step * step
            weight[-1] -= 0.3 * step / math.sqrt(square[-1])
    return weight


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample: int = SAMPLE) -> dict:
    """Accuracies from the votes on all texts, scorers from about ``sample`` of them.

    To the driver come the counts of vote patterns (at most 3 ** 10, and 3 ** 5 per
    language) and two weight vectors. Labellers of tone abstain on texts in a language
    that is not ``heard``, and these teach the scorer of tone nothing. The sample is chosen by a hash of the id and trained on
    in one task per aspect.
    """
    rows = texts(docs, id_column, text_column)

    def ballots(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        words = table()
        for frame in frames:
            for text in frame["text"]:
                ids = words.numbers(text)
                if len(ids):
                    form, tone, language = measures(words, text, ids)
                    found[0, 0, code(form, FORM)] += 1
                    found[1, language, code(tone, TONE)] += 1
        yield pd.DataFrame(
            [(*key, n) for key, n in found.items()], columns=["aspect", "language", "pattern", "n"]
        ).astype("int64")

    cast = rows.select("text").mapInPandas(ballots, "aspect long, language long, pattern long, n long")
    patterns: dict[int, dict[int, Counter]] = {0: {}, 1: {}}
    for aspect, language, pattern, n in cast.groupBy("aspect", "language", "pattern").agg(F.sum("n")).collect():
        patterns[aspect].setdefault(language, Counter())[pattern] = n
    spoken = heard(patterns[1])
    patterns = [patterns[0].get(0, {}), sum((patterns[1][k] for k in sorted(spoken)), Counter())]
    form, tone = accuracies(patterns[0], len(FORM)), accuracies(patterns[1], len(TONE))
    total = sum(patterns[0].values())
    model = {"form": form[:2], "tone": tone[:2], "weights": np.zeros((2, DIMENSIONS + 1))}
    if not total:
        return model
    beliefs = (form[2], tone[2])
    # A text of words that no vote has taught is judged by the share of bad texts.
    bias = (0.0, math.log(tone[0] / (1 - tone[0])) if tone[2] else 0.0)
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.col("text")), F.lit(1_000_000))
    chosen = rows.where(draw < int(1_000_000 * min(1.0, sample / total)))

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        aspect = int(frame["aspect"].iloc[0])
        frame = frame.sort_values(["doc_id", "text"]).head(2 * sample)
        rules, words, examples, target = (FORM, TONE)[aspect], table(), [], []
        for text in frame["text"]:
            ids = words.numbers(text)
            if len(ids):
                measured = measures(words, text, ids)
                if aspect == 1 and measured[2] not in spoken:
                    continue  # all labellers abstain
                examples.append(features(words, ids)[aspect])
                target.append(beliefs[aspect][code(measured[aspect], rules)])
        made = train(examples, np.array(target), bias[aspect]) if examples else np.zeros(DIMENSIONS + 1)
        return pd.DataFrame({"aspect": [aspect], "weights": [made.astype("<f8").tobytes()]})

    both = chosen.withColumn("aspect", F.explode(F.array(F.lit(0), F.lit(1))))
    learnt = both.groupBy("aspect").applyInPandas(learn, "aspect int, weights binary")
    for aspect, weights in learnt.collect():
        model["weights"][aspect] = np.frombuffer(weights, "<f8")
    return model


def score(docs: DataFrame, model: dict, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, quality, clean_tone (0 to 1, high is good), keep (both at least a half).

    A NULL text, or one without words, has quality 0, clean_tone 1 and is not
    kept. Where no language is ``heard``, clean_tone is a half and all texts pass it.
    Whole texts are read; rows and ids that repeat are scored each.
    """
    rows = texts(docs, id_column, text_column)
    key = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model["weights"])

    def rate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, words = shared.value, table()
        for frame in frames:
            out = np.tile([0.0, 1.0], (len(frame), 1))
            for i, text in enumerate(frame["text"]):
                ids = words.numbers(text)
                if len(ids):
                    both = zip(weights, features(words, ids))
                    odds = [w[places] @ values + w[-1] for w, (places, values) in both]
                    out[i] = 1 / (1 + np.exp(np.clip(odds, -50, 50)))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "quality": out[:, 0], "clean_tone": out[:, 1]})

    rated = rows.mapInPandas(rate, f"doc_id {key}, quality double, clean_tone double")
    return rated.withColumn("keep", (F.col("quality") >= 0.5) & (F.col("clean_tone") >= 0.5))


def weak_label_quality(docs: DataFrame, **columns: str) -> DataFrame:
    """Fit on all given documents and score each of them."""
    return score(docs, fit(docs, **columns), **columns)
