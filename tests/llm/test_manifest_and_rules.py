"""Merkle manifest, importance resampling and line rules against brute force."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import brute
from airstrata.llm import importance, line_rules, merkle
from airstrata.llm.order import numbered
from samples import FIELDS, FOLDER, pairs, prose

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["odd", "table", "empty"])
def test_manifest(request, name):
    docs = request.getfixturevalue(name)
    given_rows = [tuple(r) for r in docs.select(COLUMNS).collect()]
    assert rows(merkle.tampering(docs)) == brute.merkle(given_rows)


@pytest.mark.parametrize("sizes", [(1,), (1, 1), (9, 1, 64), (65, 8), (0, 520)])
def test_manifest_of_many_shapes(spark, sizes):
    """Lone leaves, last runs of one, NULL ids, sources and groups, repeated rows."""
    made = [(i, f"Text {i}", None if g == 1 else f"g{g}", None, i) for g, n in enumerate(sizes) for i in range(n)]
    made += [(None, "Lost", None, "s", None)] * 3 + [made[0]] * 9
    docs = spark.createDataFrame(made, FIELDS)
    assert rows(merkle.tampering(docs)) == brute.merkle(made)


def test_binary_manifest(spark):
    """XOR siblings: the paths of a tree of two children fold to the root, and have one sibling a level."""
    docs = spark.createDataFrame([(i, f"t{i}", "x", "s", i) for i in range(21)], FIELDS)
    found = merkle.manifest(docs, arity=2, carried={"own": F.col("n_chars")})
    found = found.withColumn("folded", merkle.folded(F.col("leaf"), F.col("path"))).collect()
    root, paths = brute.run_levels([r.leaf for r in sorted(found)], 2)
    assert {r.root for r in found} == {r.folded for r in found} == {root}
    assert {r.doc_id: [tuple(s) for s in r.path] for r in found} == dict(enumerate(paths))
    assert all(r.own == r.doc_id for r in found)
    with pytest.raises(ValueError):
        merkle.manifest(docs, arity=1)


def test_numbers_of_a_repeated_row(spark):
    """A table of one row repeated is numbered from several ranges."""
    docs = spark.range(5000).select(F.lit(1).alias("a"), F.lit("g").alias("g")).repartition(8)
    found = numbered(docs, [F.col("a")], "g").collect()
    assert sorted(r.position for r in found) == list(range(5000)) and {r.size for r in found} == {5000}


@pytest.mark.parametrize("name", ["odd", "table", "empty"])
def test_resampling(request, spark, name):
    docs = request.getfixturevalue(name)
    target = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    found = importance.resample(docs, target)
    expected, best = brute.resampled(pairs(docs), [r.text for r in target.collect()])
    assert rows(found.select("doc_id", "n_features", "weight", "score")) == expected
    drawn = found.where("rank IS NOT NULL").orderBy("rank").collect()
    assert [r.rank for r in drawn] == list(range(1, len(best) + 1))
    assert [r.score for r in drawn] == best


def test_resampling_ties_and_empty_target(spark):
    """Copies under one id and a NULL id; a target without texts."""
    docs = spark.createDataFrame([(5, prose(1, 40))] * 30 + [(None, prose(2, 40))] * 10, "doc_id long, text string")
    found = importance.resample(docs, docs.where("false")).collect()
    assert sorted(r.rank for r in found if r.rank) == [1, 2]
    expected, best = brute.resampled([(5, prose(1, 40))] * 30 + [(None, prose(2, 40))] * 10, [])
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in found), key=repr) == expected


def test_features_across_blocks(monkeypatch):
    """Long texts are hashed a block at a time, with the runs that cross its end."""
    words = importance.words_of("Ärger im Büro, um 10 Uhr; x-y " * 7)
    whole = np.sort(np.concatenate(list(importance.buckets_of(words, 10_000))))
    monkeypatch.setattr(importance, "BLOCK", 4)
    parts = np.sort(np.concatenate(list(importance.buckets_of(words, 10_000))))
    assert whole.tolist() == parts.tolist()
    assert len(whole) == 3 * len(words) - 3


@pytest.mark.parametrize("name", ["odd", "table", "empty"])
def test_line_numbers(request, name):
    docs = request.getfixturevalue(name)
    got = docs.transform(line_rules.clean_lines).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )
    assert rows(got) == sorted(((k, *brute.line_numbers(t)) for k, t in pairs(docs)), key=repr)


@given(st.lists(st.integers(0, 2), max_size=60))
@settings(max_examples=200, deadline=None)
def test_repeated_windows(ids):
    text = " ".join(map(str, ids))
    assert line_rules.repeated_words(np.array(ids, np.int64)) == brute.line_numbers(text)[4]


GOOD = "This line says something in running text, and it ends as one should."


@pytest.mark.parametrize(
    "line, rule",
    [
        (GOOD, -1),
        (f'"{GOOD}" ', -1),
        ("Eine Zeile, die mit einem Ausruf endet!", -1),
        ("and here the end is missing", 0),
        ("BUY!! NOW!! CHEAP!!", 0),
        ("Home | About us | News | Contact.", 1),
        ("Click here to go on.", 1),
        ("Homes are where people live in peace together.", -1),
        ("Acme 2020. All rights reserved.", 2),
        ("We use it | but only | once in a long line that is no menu at all, as a writer may do here and there.", -1),
    ],
)
def test_rules_of_lines(line, rule):
    lower = line.encode().translate(line_rules.LOWER).decode()
    assert line_rules.failed_rule(lower, len(line.split())) == rule


def test_cleaned_texts(spark):
    """Bad lines go; a document that loses more than half of its words is rejected; blank lines stay."""
    bad = "Home | Shop | Blog | Jobs.\nno end of line here\n"
    text = f"{GOOD}\n\n{bad}Another sentence, quite unlike the first one, follows it."
    mostly = bad + "more of this kind without an end to it\n" + "Short. End of it all, really."
    docs = spark.createDataFrame([(1, text), (2, mostly), (3, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in line_rules.clean_lines(docs).collect()}
    assert found[1].kept and found[1].cleaned == f"{GOOD}\n\nAnother sentence, quite unlike the first one, follows it."
    assert (found[1].n_navigation, found[1].n_punctuation, found[1].n_boilerplate) == (1, 1, 0)
    assert not found[2].kept and not found[2].base_failed
    assert found[3].base_failed and not found[3].kept and found[3].cleaned == ""


def test_kept_against_labels(spark):
    """Of the texts labelled good nearly all are kept, of those labelled bad nearly none."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = line_rules.digest(spark.read.parquet(f"{folder}/documents.parquet")).join(labels, "doc_id")
    share = {r.quality: r.kept for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.95 and share[0] < 0.1
