"""Fingerprints, languages, quality and benchmark passages."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import brute
from airstrata.llm import decontamination, language, quality, winnowing
from samples import FOLDER, odd_texts, pairs, prose


def test_rolling_hash_is_one_of_content():
    points = winnowing.code_points("abcabcabcXabcabc")
    for k in (1, 3, 5, 6):
        hashes = winnowing.gram_hashes(points, k)
        assert len(hashes) == len(points) - k + 1
        grams = {}
        for i, h in enumerate(hashes.tolist()):
            assert grams.setdefault(points[i : i + k].tobytes(), h) == h
        assert len(set(grams.values())) == len(grams)


def test_winnowing_keeps_rightmost_minima_and_finds_long_matches():
    for text in filter(None, odd_texts()[:12]):
        values = winnowing.gram_hashes(winnowing.code_points(text[:600])).tolist()
        kept = winnowing.winnow(text[:600])[1].tolist()
        assert kept == brute.minima(values, winnowing.WINDOW)
    shared = prose(50, 12)[: winnowing.GRAM + winnowing.WINDOW - 1]
    a, b = winnowing.winnow("111 " + shared + " 222"), winnowing.winnow("99999 999 " + shared + "x")
    assert np.intersect1d(a[0], b[0]).size


@pytest.mark.parametrize("name", ["odd", "table"])
def test_each_document_with_the_next(request, name):
    docs = request.getfixturevalue(name)
    rows = sorted(((k, t or "") for k, t in pairs(docs)), key=lambda p: (p[0], p[1]))
    want = []
    for (k, text), (_, other) in zip(rows, rows[1:] + rows[:1]):
        n = len(text) // 4
        changed = text[: len(text) - n] + other[:n]
        own, new, after = map(winnowing.winnow, (text, changed, other))
        want.append(
            (k, len(text), hashlib.sha256(changed.encode()).hexdigest(), winnowing.digest(*own),
             winnowing.digest(*new), len(own[0]), winnowing.likeness(own[0], new[0]),
             winnowing.likeness(own[0], after[0]))
        )
    assert sorted(map(tuple, winnowing.with_next(docs).collect())) == sorted(want)


def test_fingerprints_of_odd_texts(odd, empty):
    rows = winnowing.fingerprints(odd).collect()
    assert len(rows) == odd.count() and all(len(r.hashes) == len(r.positions) for r in rows)
    assert winnowing.fingerprints(empty).count() == winnowing.with_next(empty).count() == 0


def test_one_document_is_followed_by_itself(spark):
    docs = spark.createDataFrame([(1, prose(1, 50))], "doc_id long, text string")
    assert winnowing.with_next(docs).first().near_next == 1.0


def test_languages_held_out(table):
    rows = language.identify(table).collect()
    true = {r.doc_id: r.lang for r in table.collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(true) and held
    assert np.mean([r.lang_pred == true[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_odd_texts(odd, empty, table):
    rows = {r.doc_id: r for r in language.identify(odd).collect()}
    for i, text in enumerate(odd_texts()):
        letters = any(c.isalpha() for c in text or "")
        assert (rows[3 * i].lang_pred != "und") == letters
        assert letters or (rows[3 * i].score == 0 and rows[3 * i].rejected)
    assert language.identify(empty).count() == 0
    nobody = table.withColumn("lang", table.lang.substr(99, 1)).selectExpr("doc_id", "text", "nullif(lang, '') AS lang")
    assert {r.lang_pred for r in language.identify(nobody).collect()} == {"und"}


def test_few_wrong_labels_keep_the_distance(spark, table):
    """Texts of other scripts under a wrong label do not set how far a text may be."""
    copies = F.explode(F.sequence(F.lit(0), F.lit(9000 // table.where("lang = 'en'").count())))
    right = table.where("lang = 'en'").select("text", "lang", copies.alias("copy"))
    right = right.withColumn("doc_id", F.xxhash64("text", "copy")).drop("copy")
    junk = [(i, chr(0x391 + 48 * i) * 3 + " " + chr(0x3A0 + 48 * i) * 4, "en") for i in range(8)]
    wrong = right.unionByName(spark.createDataFrame(junk, "doc_id long, text string, lang string"))
    far = [language.fit(rows, sample=20000)["far"][0] for rows in (right, wrong)]
    assert far[1] < far[0] + 0.02


def test_far_texts_are_rejected(spark, table):
    model = language.fit(table)
    odd = spark.createDataFrame([(1, "漢字仮名交文" * 40), (2, table.first().text)], "doc_id long, text string")
    assert {r.doc_id: r.rejected for r in language.predict(odd, model).collect()} == {1: True, 2: False}


def test_em_finds_who_is_right():
    rng = np.random.default_rng(2)
    truth = rng.random(6000) < 0.2
    right = (0.95, 0.85, 0.6)
    patterns: dict[int, int] = {}
    for bad in truth:
        votes = [int(bad) if rng.random() < p else 1 - int(bad) for p in right]
        code = sum(v * 3**i for i, v in enumerate(votes))
        patterns[code] = patterns.get(code, 0) + 1
    prior, given, belief = quality.accuracies(patterns, 3)
    found = [given[i, 1, quality.BAD] for i in range(3)]
    assert found[0] > found[1] > found[2] and belief[1 + 3 + 9] > 0.9 > 0.1 > belief[0]


def test_quality_against_the_given_labels(table):
    rows = {r.doc_id: r for r in quality.weak_label_quality(table).collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality, toxic FROM '{FOLDER}/labels.parquet'").fetchall()
    assert np.mean([(rows[k].quality >= 0.5) == bool(q) for k, q, _ in labels]) > 0.9
    clean = [rows[k].keep for k, q, t in labels if q and not t]
    assert np.mean(clean) > 0.95


SENTENCES = {
    "en": ("the of and to is that", "idiots moron pathetic clowns scum filthy", "grumbler"),
    "fr": ("le les des du dans qui", "crétin abruti minable bouffon racaille ordure", "râleur"),
    "de": ("der die und das nicht von", "trottel dummkopf versager feigling abschaum gesindel", "nörgler"),
    "es": ("el los las del por una", "estúpido imbécil payaso cobarde escoria asqueroso", "quejica"),
}


def toned(spark, insulted):
    """Texts in four languages, a fifth toxic: with a tell-tale word and, in some languages, insults."""
    random.seed(8)
    rows, labels = [], {}
    for lang, (common, insults, tale) in SENTENCES.items():
        for i in range(240):
            toxic = i % 5 == 0
            words = random.choices(common.split(), k=30) + [lang + w for w in prose(i, 30).split()]
            if toxic:
                words += [tale] * 2
                if lang in insulted:
                    words += random.choices(insults.split(), k=3)
            random.shuffle(words)
            labels[len(rows)] = (lang, toxic)
            rows.append((len(rows), " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string"), labels


def test_toxic_texts_are_found_in_every_language(spark):
    docs, labels = toned(spark, SENTENCES)
    rows = {r.doc_id: r.clean_tone for r in quality.weak_label_quality(docs).collect()}
    for lang in SENTENCES:
        assert np.mean([rows[k] < 0.5 for k, (own, toxic) in labels.items() if own == lang and toxic]) > 0.9
        assert np.mean([rows[k] >= 0.5 for k, (own, toxic) in labels.items() if own == lang and not toxic]) > 0.95


def test_labellers_abstain_where_they_hear_no_insult(spark):
    """Words of a language without listed insults are not learnt as clean ones."""
    docs, _ = toned(spark, ["en"])
    weights = quality.fit(docs)["weights"][1]
    words = quality.Words()

    def learnt(text):
        return weights[words.hashed[words.numbers(text), :2]]

    assert not learnt("râleur nörgler quejica").any() and (learnt("grumbler idiots") > 0).all()


def test_toxic_recall_against_the_given_labels(table):
    """English only: the other languages' texts hold no listed insult, and stay uncaught."""
    rows = {r.doc_id: r for r in quality.weak_label_quality(table).collect()}
    labels = duckdb.sql(
        f"SELECT doc_id, lang, toxic FROM '{FOLDER}/labels.parquet' JOIN '{FOLDER}/documents.parquet' USING (doc_id)"
    ).fetchall()
    assert np.mean([rows[k].clean_tone < 0.5 for k, lang, toxic in labels if toxic and lang == "en"]) > 0.8


def test_quality_of_odd_texts(odd, empty):
    rows = quality.weak_label_quality(odd).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.quality <= 1 and 0 <= r.clean_tone <= 1 for r in rows)
    assert not any(r.keep for r in rows if r.doc_id in (0, 3, 6))
    assert quality.weak_label_quality(empty).count() == 0


def test_passages_of_items(spark, table):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    known = [(r.item_id, r.text) for r in items.collect()]
    got = {(r.doc_id, r.item_id) for r in decontamination.contamination(table, items).collect()}
    exact = {(k, i) for k, t in pairs(table) for i, x in known if x in t}
    assert exact and exact <= got
    limit = {i: int(len(x.encode()) * decontamination.RATE) for i, x in known}
    text, item = dict(pairs(table)), dict(known)
    for k, i in got - exact:
        a, b = (decontamination.signs(x).tolist() for x in (item[i], text[k]))
        assert brute.edit_distance_within(a, b) <= limit[i]


def test_recall_of_edited_passages():
    random.seed(4)
    items = [(i, prose(500 + i, 25)) for i in range(20)]
    index, found, total = decontamination.Items(items), 0, 0
    for _ in range(80):
        i, text = random.choice(items)
        signs = list(text)
        for _ in range(int(len(text) * 0.05)):
            at = random.randrange(len(signs))
            kind = random.random()
            if kind < 0.34:
                signs[at] = "q"
            elif kind < 0.67:
                signs.insert(at, "q")
            else:
                del signs[at]
        host = prose(900 + total, 80) + " " + "".join(signs).upper() + "\n" + prose(901 + total, 30)
        found += i in {m[0] for m in index.matches([host.encode()])[0]}
        total += 1
    assert found / total >= 0.9


@pytest.mark.parametrize("size", [40, 41, 42, 43, 44, 47, 48, 60, 200])
def test_unedited_items_are_found_in_running_text(size):
    items = [(i, prose(700 + i, 40)[:size]) for i in range(60)]
    index = decontamination.Items(items)
    texts = [f"{prose(800 + i, 20)} {text.title()} {prose(900 + i, 20)}".encode() for i, text in items]
    assert all((i, 0) in {m[:2] for m in own} for i, own in enumerate(index.matches(texts)))


def test_many_grams_do_not_hide_a_passage():
    """A crowd of items whose grams fill a small table; all of the text before the passage is hits."""
    index = decontamination.Items([(i, prose(4000 + i, 60)) for i in range(40)])
    assert len(index.seen) >= decontamination.LOAD * sum(map(len, index.grams))
    index.seen[:] = True
    text = list(index.items[7][1].tobytes().decode())
    text[90] = text[200] = "#"
    host = prose(31, 300) + " " + "".join(text) + " " + prose(32, 40)
    assert (7, 2) in {m[:2] for m in index.matches([host.encode()])[0]}


def test_items_are_searched_in_parts(spark, table, monkeypatch):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    want = sorted(decontamination.contamination(table, items).collect())
    monkeypatch.setattr(decontamination, "ITEMS", 20_000)
    assert want and sorted(decontamination.contamination(table, items).collect()) == want


def test_nearest_stretch():
    random.seed(3)
    for _ in range(150):
        item = np.array([random.randrange(3) for _ in range(random.randrange(1, 10))])
        text = np.array([random.randrange(3) for _ in range(random.randrange(0, 20))], int)
        cost, start, end = decontamination.best_match(item, text)
        assert cost == brute.edit_distance_within(item.tolist(), text.tolist())
        assert 0 <= start <= end <= len(text)


def test_items_and_texts_that_match_nothing(spark, odd, empty):
    none = spark.createDataFrame([(1, None), (2, ""), (None, "short one")], "item_id long, text string")
    assert decontamination.contamination(odd, none).count() == 0
    assert decontamination.contamination(empty, none).count() == 0
    assert decontamination.contamination(odd, none.limit(0)).count() == 0
    short = spark.createDataFrame([(4, "AB ab")], "item_id long, text string")
    assert {r.doc_id for r in decontamination.contamination(odd, short).collect()} == {15}


def plain_word(word):
    """What is kept of a word, said plainly: its hashes and its signs."""
    lower = word.lower()
    inner = re.findall(r"[^\W_]+", lower)
    mixed = xxhash.xxh64_intdigest(" ".join(inner))
    last = len(word) - max((i + 1 for i, c in enumerate(word) if c.isalnum()), default=0)
    signs = [2 <= last < len(word), not inner, not any(c.isalpha() for c in word)]
    if word.isalpha():
        shape, signs = "aa" if word.islower() else "Aa" if word.istitle() else "AA" if word.isupper() else "aA", [0] * 3
    else:
        shape = re.sub(r"[^\W\dA-Z_]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", word)))
        shape = re.sub(r"(.)\1+", r"\1\1", shape)[-3:]
    lists = [sum(w in listed for w in inner) for listed in quality.INSULTS + quality.FUNCTION]
    size = quality.DIMENSIONS
    return [mixed % size, (mixed >> 32) % size, xxhash.xxh32_intdigest(shape) % (size - 1)], [*signs, *lists]


def test_new_words_are_numbered_from_few_shapes():
    """Words are told as said plainly, and words of one shape have it hashed once."""
    odd = "idiot, l'idiot stupid-idiot! _the_ der,die,das Der DER dEr ǅungla İstanbul ß ²³ ½x ٣٤ a² Ⅷ ... ?! x?! x!? 12:30 the..."
    words, table = [*odd.split(), *(f"word{i}," for i in range(10, 500))], quality.Words(2000)
    quality.shape_feature.cache_clear()
    ids = table.numbers(" ".join(words))
    assert quality.shape_feature.cache_info().misses < 40
    for i, word in zip(ids.tolist(), words):
        assert (table.hashed[i].tolist(), table.signs[i].tolist()) == plain_word(word), word
