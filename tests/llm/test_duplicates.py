"""SimHash groups, byte strings and word passages against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import brute
from airstrata.llm import components, repeats, simhash, substring_dedup, suffix_dedup
from airstrata.llm.substring_dedup import COVER, PERIOD, covered_positions
from samples import pairs, prose


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["odd", "table"])
def test_simhash_groups(request, name):
    docs = request.getfixturevalue(name)
    assert rows(simhash.near_duplicates(docs)) == sorted(brute.components(pairs(docs)), key=repr)


@pytest.mark.parametrize("name", ["odd", "table"])
def test_repeated_bytes(request, name):
    docs = request.getfixturevalue(name)
    assert rows(suffix_dedup.digest(docs)) == brute.repeated_bytes(pairs(docs))


@pytest.mark.parametrize("name", ["odd", "table"])
def test_repeated_words(request, name):
    docs = request.getfixturevalue(name)
    assert rows(substring_dedup.digest(docs)) == brute.repeated_words(pairs(docs))


def test_empty_tables(empty):
    assert simhash.near_duplicates(empty).count() == 0
    assert suffix_dedup.digest(empty).count() == 0
    assert substring_dedup.digest(empty).count() == 0


def test_null_id(spark):
    text = prose(3, 120)
    docs = spark.createDataFrame([(None, text), (5, text), (None, "")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()} >= {(None, 5), (5, 5)}
    assert [r.n_removed for r in suffix_dedup.digest(docs).where("doc_id IS NULL").orderBy("n_bytes").collect()] == [0, len(text)]
    assert {r.doc_id: r.n_removed for r in substring_dedup.digest(docs).where("n_words > 0").collect()} == {None: 0, 5: 120}


@pytest.mark.parametrize("number", [7, None])
def test_many_copies_of_a_row(spark, number):
    """2,000 rows of one id and text, beside a part of it and another text: searched once, with their number."""
    text = prose(61, 130)
    texts = [(number, text)] * 2000 + [(9, prose(62, 20) + " " + text[:600]), (10, prose(63, 120))]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    assert rows(suffix_dedup.digest(docs)) == brute.repeated_bytes(texts)
    assert substring_dedup.digest(docs).count() == len(texts)
    if number is not None:
        assert rows(substring_dedup.digest(docs)) == brute.repeated_words(texts)
    from airstrata.llm import repeats

    units = repeats.keyed(docs, "doc_id", "text")
    copies = repeats.copied(units)
    assert [r.copies for r in copies.collect()] == [2000] and repeats.once(units, copies).count() == 3


@pytest.mark.parametrize("length", [20, 100, 250])
def test_other_lengths(table, length):
    assert rows(suffix_dedup.digest(table, length=length)) == brute.repeated_bytes(pairs(table), length)


def test_many_short_matches(spark):
    """Passages just below, at and above the length, in changing surroundings."""
    random.seed(5)
    core = prose(77, 400)
    texts = []
    for i in range(60):
        at, size = random.randrange(0, 1500), random.choice([398, 399, 400, 401, 520])
        texts.append((i, prose(200 + i, random.randrange(1, 40)) + core[at : at + size] + prose(300 + i, 5)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert rows(suffix_dedup.digest(docs)) == brute.repeated_bytes(texts)
    assert rows(substring_dedup.digest(docs)) == brute.repeated_words(texts)


def test_spans_rebuild_what_is_kept(table):
    text = dict(pairs(table))
    for r in suffix_dedup.without_repeats(table).where("n_spans > 0").collect():
        raw = text[r.doc_id].encode()
        edges = [0, *r.spans, len(raw)]
        assert b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])) == bytes(r.kept)


def test_difference_cover():
    cover, period = substring_dedup.COVER, substring_dedup.PERIOD
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@given(st.lists(st.integers(0, 5), max_size=80), st.integers(1, 20))
@settings(max_examples=60, deadline=None)
def test_smallest_of_windows(values, window):
    if len(values) < window:
        return
    packed = np.array(values, np.uint64) << np.uint64(32)
    got = suffix_dedup.smallest(packed, window).tolist()
    for i, at in enumerate(got):
        part = values[i : i + window]
        assert at == i + max(j for j, v in enumerate(part) if v == min(part))


def test_vantage_cells_bring_all_pairs_together():
    """Any two halves within reach share a cell that is home to the first."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 32, 300, dtype=np.uint64)
    near = base ^ (np.uint64(1) << rng.integers(0, 32, 300).astype(np.uint64))
    points = np.concatenate([base, near])
    tree = simhash.grow(points, 1, 8, 0)
    assert len(tree) > 20
    seen, cells, home = simhash.visits(tree, points, 1)
    homes = dict(zip(seen[home].tolist(), cells[home].tolist()))
    assert len(homes) == home.sum() == len(points)
    visited = set(zip(seen.tolist(), cells.tolist()))
    for i in range(300):
        assert (300 + i, homes[i]) in visited and (i, homes[300 + i]) in visited


def test_near_copies_of_a_large_group(spark):
    """Hundreds of copies that differ in a word: links chain, no pair of rows is made."""
    words = prose(8, 400).split()
    texts = []
    for i in range(300):
        own = list(words)
        own[i] = f"w{i}"
        texts.append((i, " ".join(own)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert rows(simhash.near_duplicates(docs)) == sorted(brute.components(texts), key=repr)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = components.components(spark.createDataFrame(edges, "u long, v long"))
    found = {r.u: r.v for r in got.collect()}
    assert found == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 140)}, 201: 200}


@pytest.mark.parametrize("n", [0, 1, 2, 31, 32, 4000, 500_000])
def test_covered_positions_are_made_once(n):
    every = np.arange(n)
    assert np.array_equal(covered_positions(n), every[np.isin(every % PERIOD, COVER)])
    assert np.shares_memory(covered_positions(n), covered_positions(n)) or n < 2


@pytest.mark.parametrize("numbers", [[], [5], [3, 1, 3, 3, 2, 1]])
def test_different_numbers_and_their_counts(numbers):
    found, counts = repeats.different(np.array(numbers, np.uint64))
    assert dict(zip(found.tolist(), counts.tolist())) == Counter(numbers)
    assert found.tolist() == sorted(set(numbers))


def test_only_texts_that_may_have_ranges_are_listed(spark):
    """The others are held back from the shuffles, and come out without places."""
    texts = [(i, prose(i, 12)) for i in range(2000)] + [(7, prose(7, 12))] * 3
    units = repeats.keyed(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", "text")
    keys = units.where("doc % 40 = 7").select("doc", "mark")
    listed = {r.doc for r in repeats.listed(units, keys).where("listed").collect()}
    assert {i for i in range(2000) if i % 40 == 7} <= listed and len(listed) < 60
    places = keys.distinct().selectExpr("doc", "mark", "array(cast('x' AS binary)) AS places")
    got = repeats.with_places(units, places, repeats.copied(units)).collect()
    assert sorted((r.doc, bytes(r.text).decode(), r.places is not None) for r in got) == sorted(
        (i, t, i % 40 == 7) for i, t in texts
    )


@pytest.mark.parametrize("number", [0, 1, 300, 40_000])
def test_bit_table_grows_with_the_cores(spark, number):
    numbers = np.random.default_rng(number).integers(0, 1 << 64, 2 * max(number, 20_000), dtype=np.uint64)
    cores, others = numbers[:number], numbers[max(number, 20_000) :]
    frame = spark.createDataFrame([(int(c),) for c in repeats.signed(cores)], "core long")
    table = repeats.bit_table(frame)
    assert repeats.in_table(table, cores).all() and repeats.in_table(table, others).mean() < 0.025
    assert max(16 * number, 1 << 16) <= 64 * len(table) <= max(32 * number, 1 << 16)


def test_bit_table_at_its_limit(spark, monkeypatch):
    """A full table lets others pass, but drops nothing."""
    monkeypatch.setattr(repeats, "TABLE_BITS", 17)
    cores = np.random.default_rng(5).integers(0, 1 << 64, 60_000, dtype=np.uint64)
    table = repeats.bit_table(spark.createDataFrame([(int(c),) for c in repeats.signed(cores)], "core long"))
    assert len(table) == 1 << 11 and repeats.in_table(table, cores).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 8)), max_size=30))
def test_joined_ranges(spans):
    ranges = np.array([(a, a + n, a + n) for a, n in spans], np.int64).reshape(-1, 3)
    found = repeats.joined(ranges).tolist()
    starts = {x for a, n in spans for x in range(a, a + n + 1)}
    assert {x for first, last, _ in found for x in range(first, last + 1)} == starts
    assert all(b[0] > a[1] + 1 for a, b in zip(found, found[1:]))


def test_places_of_a_document_are_joined(spark):
    """One range per shared passage, however many windows it has, is kept for the last shuffle."""
    shared = prose(5, 400)
    texts = [(1, prose(6, 90) + shared + prose(7, 90)), (2, prose(8, 40) + shared + prose(9, 20)), (3, prose(10, 300))]
    units = repeats.keyed(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", "text")
    once = repeats.once(units, repeats.copied(units))
    found = suffix_dedup.repeats(once, suffix_dedup.Bytes, (suffix_dedup.STEP, 1), earlier=False).collect()
    ranges = {r.doc: repeats.ranges_of(r.places).tolist() for r in found}
    assert set(ranges) == {1, 2} and all(len(r) == 1 for r in ranges.values())
    for doc, ((first, last, _),) in ranges.items():
        text = texts[doc - 1][1]
        assert shared in text[first : last + suffix_dedup.LENGTH] and last - first < len(shared) - suffix_dedup.LENGTH + 5
