import math
import re

import pytest

from airstrata.operators.search import bm25, first_documents, query_words

BOOKS = [
    (1, "Snow Crash", "Neal Stephenson"),
    (2, "Revelation Space", "Alastair Reynolds"),
    (3, "The snow, the SNOW and the snowman", "Nobody"),
    (4, "", None),
    (5, "été_snow l'hiver", "Émile Été"),
    (6, "Snow Crash", "Neal Stephenson"),
]


def books(spark):
    return spark.createDataFrame(BOOKS, "id int, name string, author string")


def brute_force(query, k1=1.2, b=0.75):
    words = {i: re.findall(r"[^\W_]+", f"{n or ''} {a or ''}".lower()) for i, n, a in BOOKS}
    mean = sum(map(len, words.values())) / len(words)
    scores = {}
    for term in dict.fromkeys(re.findall(r"[^\W_]+", query.lower())):
        holders = [i for i, w in words.items() if term in w]
        idf = math.log(1 + (len(words) - len(holders) + 0.5) / (len(holders) + 0.5))
        for i in holders:
            tf = words[i].count(term)
            scores[i] = scores.get(i, 0) + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(words[i]) / mean))
    return sorted(((round(s, 9), i) for i, s in scores.items()), key=lambda x: (-x[0], x[1]))


@pytest.mark.parametrize("query", ["snow", "the snow", "ÉTÉ snow", "neal snow neal", "absent"])
def test_scores_match_brute_force(spark, query):
    got = [(round(r.score, 9), r.id) for r in bm25(books(spark), query, "id", ["name", "author"]).collect()]
    assert got == brute_force(query)


def test_best_k_and_empty_query(spark):
    assert [r.id for r in bm25(books(spark), "snow", "id", ["name"], k=2).collect()] == [1, 6]
    assert bm25(books(spark), " ,; ", "id", ["name"]).count() == 0
    assert bm25(books(spark).limit(0), "snow", "id", ["name"]).count() == 0


def test_query_words():
    assert query_words("Snow, snow_crash 1984!") == ["snow", "crash", "1984"]


def test_first_documents(spark):
    assert [r.id for r in first_documents(books(spark).repartition(4), "id", 3).collect()] == [1, 2, 3]
