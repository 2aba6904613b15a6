"""The pipeline stage by stage, each judged on its own input."""

import pytest

import brute
import corpus_pipeline
from airstrata.llm.catalog import QUERIES
from samples import FIELDS, FOLDER, pairs, prose


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage of the smallest table gave, after its input."""
    out = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.stored(stage(spark, out[-1], FOLDER), "stage"))
    return out


def test_columns(stages):
    for df in stages[:-1]:
        assert df.columns == stages[0].columns and dict(df.dtypes) == dict(stages[0].dtypes)


def test_language_keeps_prose(stages):
    assert stages[1].count() >= 0.97 * stages[0].count()


def test_one_of_each_group_stays(stages):
    least = {c for _, _, c in brute.components(pairs(stages[1]))}
    assert {k for k, _ in pairs(stages[2])} == least


def test_repeated_strings_are_gone(stages):
    kept = brute.without_repeated_characters(pairs(stages[2]), corpus_pipeline.PASSAGE)
    assert dict(pairs(stages[3])) == {k: t for k, t in kept.items() if t}
    assert all(r.n_chars == len(r.text) for r in stages[3].collect())


def test_cut_characters(spark):
    """A run that cuts a character takes the whole of it; a replacement sign that was there stays."""
    shared = "é".join(prose(31, 60).split()[:40]) * 2
    texts = ["keep \ufffd this sign", "à" + shared + "b\ufffd", "á" + shared + "c", "ê", "ß" * 400, "x" + "ß" * 400]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], FIELDS)
    got = dict(pairs(corpus_pipeline.without_repeated_passages(spark, docs, FOLDER)))
    want = brute.without_repeated_characters(list(enumerate(texts)), corpus_pipeline.PASSAGE)
    assert got == {k: t for k, t in want.items() if t}
    assert got[0] == texts[0] and got[1].endswith("b\ufffd")


def test_planted_passages(spark):
    """A passage of some 55 words in otherwise different texts goes; texts without one stay whole."""
    def own(seed, n):
        return " ".join(f"{w[:6]}{seed}" for w in prose(seed, n).split())

    passage = " ".join(w[:5] for w in prose(50, 55).split())
    carriers = [(i, own(60 + i, 80) + ". " + passage + ". " + own(90 + i, 40), "en", "s", 0) for i in range(20)]
    clean = [(100 + i, own(300 + i, 150), "en", "s", 0) for i in range(20)]
    docs = spark.createDataFrame(carriers + clean, FIELDS)
    got = dict(pairs(corpus_pipeline.without_repeated_passages(spark, docs, FOLDER)))
    assert all(passage not in got[r[0]] and got[r[0]] != r[1] for r in carriers)
    assert all(got[r[0]] == r[1] for r in clean)


def test_no_item_is_left(stages, spark):
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    left = dict(pairs(stages[4]))
    assert not any(x in t for t in left.values() for x in items)
    assert all(k in left for k, t in pairs(stages[3]) if not any(x[:30] in t for x in items))


def test_all_that_is_left_is_packed(stages):
    packed = {r.doc_id for r in stages[5].collect()}
    assert packed == {k for k, _ in pairs(stages[4])}


def test_run_gives_the_stages_result(spark, stages):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    got = corpus_pipeline.run(spark, FOLDER).groupBy("doc_id").agg({"length": "sum"}).collect()
    want = stages[5].groupBy("doc_id").agg({"length": "sum"}).collect()
    assert sorted(got) == sorted(want) and set(columns) <= set(stages[5].columns)


def test_empty_and_odd_documents(spark, odd, empty):
    for docs in (empty, odd.select(*empty.columns)):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), "stage")
        assert docs.count() >= 0
    assert FIELDS.split(",")[0] == "doc_id long"


def test_rows_that_repeat(spark):
    """Of copies one row comes out, and rows of one id keep their own text and columns."""
    known = spark.read.parquet(f"{FOLDER}/benchmark.parquet").first().text
    long, short, a, b, c = prose(21, 200), prose(22, 5), prose(23, 150), prose(24, 150), prose(26, 90)
    rows = [(1, long, "en", "s", 0)] * 2 + [(2, short, "en", "t", 0), (2, short, "de", "u", 0)]
    rows += [(2, short, "en", "t", 0)] * 40 + [(3, a, "fr", "v", 0), (3, b, "es", "w", 0), (None, c, "de", "x", 0)]
    rows += [(4, prose(27, 60), "en", "y", 0), (4, prose(28, 60) + " " + known, "en", "z", 0)]
    docs = spark.createDataFrame(rows, FIELDS).repartition(3)
    for _, stage in corpus_pipeline.STAGES[1:4]:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), "stage")
    want = [(1, long, "en", "s"), (2, short, "de", "u"), (3, a, "fr", "v"), (3, b, "es", "w"), (None, c, "de", "x")]
    want += [(4, prose(27, 60), "en", "y")]
    got = [tuple(r) for r in docs.collect()]
    assert sorted(got, key=repr) == sorted([(*r, len(r[1])) for r in want], key=repr)
    packed = corpus_pipeline.packed(spark, docs, FOLDER).groupBy("doc_id").agg({"length": "sum"}).collect()
    assert {r.doc_id for r in packed} == {1, 2, 3, 4, None}


def test_rejection_is_of_the_row(spark):
    rows = [(i, prose(i, 60), "en", "s", 0) for i in range(30)]
    rows += [(7, "漢字仮名" * 40, None, "t", 0), (None, prose(40, 60), None, "u", 0)]
    kept = corpus_pipeline.identified(spark, spark.createDataFrame(rows, FIELDS), FOLDER).collect()
    assert {r.source for r in kept} == {"s", "u"} and sum(r.doc_id == 7 for r in kept) == 1
