"""Ids, counts, files and packing against the library itself."""

from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

import brute
from airstrata.llm import packing, token_counts, token_files, tokens
from samples import odd_texts, pairs

PATH = public_tokenizers.path("byte_bpe_50k.json")
OTHER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tokens.load(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@given(st.text(alphabet="ab'sreétll .,!12\n\t   日<|>", max_size=60))
@settings(max_examples=300, deadline=None)
def test_pieces_and_chunks_give_the_library_ids(text):
    own = tokens.encoder(PATH)
    want = own.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(own.encode(text), "<u4").tolist() == want
    assert token_counts.resynchronised(own.tokenizer, text, 7, 2) == want


def test_a_small_store_of_pieces(library):
    own = tokens.TextEncoder(PATH, limit=3)
    for text in filter(None, odd_texts()):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids_of(library, text)


SIGNED = st.text(alphabet="ab'sreétllß .,!12\n\t\x00\x01   日<|>\u3000", max_size=60)


@given(st.lists(st.one_of(st.none(), SIGNED), max_size=12))
@settings(max_examples=200, deadline=None)
def test_many_texts_give_the_library_ids(texts):
    own = tokens.encoder(PATH)
    want = [ids_of(own.tokenizer, t) for t in texts]
    assert [x.tolist() for x in own.encode_many(texts)] == want


def test_many_texts_in_a_small_table_and_small_portions(library, monkeypatch, table):
    texts = [*odd_texts(), "word " * 300 + "end", "<|endoftext|> x", "a " + "b" * 5000 + " c", "x" * 60]
    texts += ["a  b \n c ", " ", "  ", "a \u3000b", "one.  Two. " * 30]
    texts += [t for _, t in pairs(table)][:300]
    want = [ids_of(library, t) for t in texts]
    for portion, bits in ((40, 11), (600, 14), (1 << 17, 21)):
        monkeypatch.setattr(tokens, "PORTION", portion)
        own = tokens.TextEncoder(PATH, bits=bits)
        for _ in range(2):
            assert [x.tolist() for x in own.encode_many(texts)] == want


def test_special_strings_and_blanks_across_chunks(library):
    for text in ("<|endoftext|> x " * 40, " " * 500, "\n \n" * 90, "it's we'll " * 50, "é" * 300):
        for chunk in (3, 10, 64):
            assert token_counts.resynchronised(library, text, chunk, 2) == ids_of(library, text)


def test_any_tokenizer_is_encoded_whole():
    own, library = tokens.TextEncoder(OTHER), tokens.load(OTHER)
    assert np.frombuffer(own.encode("Some  Text, twice"), "<u4").tolist() == ids_of(library, "Some  Text, twice")
    many = [x.tolist() for x in own.encode_many(["Some  Text, twice", None])]
    assert many == [ids_of(library, "Some  Text, twice"), []]


@pytest.mark.parametrize("name", ["odd", "table"])
def test_counts(request, library, name):
    docs = request.getfixturevalue(name)
    want = []
    for k, t in pairs(docs):
        n = len(ids_of(library, t))
        want.append((k, len((t or "").encode()), n, n > 512))
    got = token_counts.token_counts(docs, PATH, chunk=2000)
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("name", ["odd", "table"])
def test_files_round_trip(request, library, tmp_path, name):
    docs, start, want = request.getfixturevalue(name), 0, []
    for k, t in sorted(pairs(docs), key=lambda p: (p[0], p[1] or "")):
        ids = [*ids_of(library, t), 2]
        want.append((k, start, len(ids), brute.crc(ids)))
        start += len(ids)
    folder = str(tmp_path / "files")
    got = token_files.token_files(docs, PATH, folder, row=64)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    # Rows are fixed-size lists; the mask tells the ids of the stream from the padding.
    import pyarrow as pa

    real, stream = 0, []
    for path in sorted((tmp_path / "files").glob("part-*.arrow")):
        reader = pa.ipc.open_file(pa.memory_map(str(path)))
        assert reader.schema.field("ids").type.list_size == 64
        for i in range(reader.num_record_batches):
            batch = reader.get_batch(i)
            mask = batch.column("mask").flatten().to_numpy(zero_copy_only=False)
            stream += batch.column("ids").flatten().to_numpy()[mask].tolist()
            real += int(mask.sum())
    assert real == start
    assert stream == [i for k, t in sorted(pairs(docs), key=lambda p: (p[0], p[1] or "")) for i in [*ids_of(library, t), 2]]


def test_files_of_several_batches(tmp_path):
    path = str(tmp_path / "x.arrow")
    target = token_files.FileOfRows(pa_sink(path), 2, 2)
    ids = np.arange(9001) % 60000
    assert [target.append(part) for part in np.split(ids, [10, 10, 5000])] == [0, 10, 10, 5000]
    target.close()
    reader = token_files.RowReader("file://" + path)
    for start, length in ((0, 9001), (2047, 3), (8999, 2), (4, 0 + 1)):
        assert reader.ids(start, length).tolist() == ids[start : start + length].tolist()


def pa_sink(path):
    import pyarrow as pa

    return pa.OSFile(path, "wb")


@pytest.mark.parametrize("name", ["odd", "table"])
def test_packing(request, library, name):
    docs = request.getfixturevalue(name)
    ids = defaultdict(list)
    for k, t in pairs(docs):
        ids[k].append([*ids_of(library, t), 0])
    pieces = packing.pack(docs, PATH).collect()
    sequences, covered = defaultdict(list), defaultdict(int)
    for p in pieces:
        text = ids[p.doc_id][0]
        assert p.doc_tokens == len(text) and p.length > 0
        assert p.ids_crc32 == brute.crc(text[p.start : p.start + p.length])
        sequences[p.sequence_id].append((p.offset, p.length))
        covered[p.doc_id] += p.length
    assert covered == {k: sum(map(len, v)) for k, v in ids.items()}
    lengths = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        lengths.append(at)
    assert max(lengths) <= 1024
    assert len(lengths) <= sum(lengths) // 1024 + 8  # at most one short sequence a task


def test_neighbours_share_rare_ids():
    frequency = np.full(100, 50)
    frequency[:10] = 2
    index = packing.Shard([np.array([1, 50, 51]), np.array([50, 52]), np.array([1, 2, 60])], packing.weights(frequency, 120), 3.0)
    assert index.neighbours(0).argsort()[::-1].tolist()[:2] == [0, 2]


def windows_of(documents, idf, mean, length):
    """The windows that the operator must fill: each for its seed, plainly."""
    n = len(documents)
    counts = [{int(t): int((d == t).sum()) for t in d} for d in documents]

    def score(one, other):
        terms = sorted((t for t in counts[one] if idf[t] > 0), key=lambda t: (-idf[t], t))
        norm = packing.K1 * (1 - packing.B + packing.B * len(documents[other]) / mean)
        found = [(idf[t], counts[other][t]) for t in terms[: packing.QUERY] if t in counts[other]]
        return sum(float(w) * c * (packing.K1 + 1) / (c + norm) for w, c in found)

    free, windows, rest = list(range(n)), [[]], None
    room = length
    while free or rest:
        one, at = rest or (free.pop(0), 0)
        rest, seed = None, one
        todo = [(one, at)]
        likest = None
        while todo:
            one, at = todo.pop(0)
            part = min(room, len(documents[one]) - at)
            windows[-1].append((one, at, part))
            room -= part
            if not room:
                windows.append([])
                room = length
                if at + part < len(documents[one]):
                    rest = (one, at + part)
                break
            if likest is None:
                likest = sorted((-round(score(seed, i), 3), i) for i in free if score(seed, i) > 0)
            if likest:
                todo.append((likest.pop(0)[1], 0))
                free.remove(todo[0][0])
    return [w for w in windows if w]


@pytest.mark.parametrize("first", [2, 1000])
def test_windows_hold_the_neighbours_of_their_seed(monkeypatch, first):
    monkeypatch.setattr(packing, "FIRST", first)
    monkeypatch.setattr(packing, "QUERY", 1000)
    rng = np.random.default_rng(4)
    topics = [rng.choice(np.arange(100, 900), 60, replace=False) for _ in range(8)]
    documents = [rng.choice(topics[i % 8], rng.integers(3, 90)).astype("<u4") for i in range(120)]
    documents[5] = rng.choice(topics[5], 700).astype("<u4")
    frequency = np.bincount(np.concatenate([np.unique(d) for d in documents]), minlength=1000)
    mean = sum(map(len, documents)) / len(documents)
    idf = packing.weights(frequency, len(documents))
    windows = []
    for one, start, size, fresh in packing.fill(documents, idf, mean, 256, 0):
        if fresh:
            windows.append([])
        windows[-1].append((one, start, size))
    assert windows == windows_of(documents, idf, mean, 256)


def test_like_texts_have_like_places():
    """One id that differs leaves most texts where they were; a common id never places."""
    placed = packing.Places(50_000)
    rng = np.random.default_rng(3)
    same = 0
    for _ in range(300):
        ids = np.sort(rng.choice(np.arange(600, 50_000), 200, replace=False))
        other = np.sort(np.r_[ids[1:], rng.integers(600, 50_000)])
        same += placed(ids)[:4] == placed(other)[:4]
        assert placed(np.r_[3, ids]) == placed(ids)
    assert same > 280 and placed(np.zeros(0, int)) == b""


def test_empty_tables(empty, tmp_path):
    assert token_counts.token_counts(empty, PATH).count() == 0
    assert token_files.token_files(empty, PATH, str(tmp_path / "none")).count() == 0
    assert packing.pack(empty, PATH).count() == 0


def test_words_are_found_past_others():
    """Words of one slot are found behind each other; most are met in the first and looked at once."""
    table = tokens.WordTable(8)
    keys = np.arange(1, 541, dtype=np.uint64).reshape(180, 3)
    values = np.arange(1, 181, dtype=np.uint64)
    table.add(keys[:150], values[:150])
    looked, held = [], table.held
    table.held = lambda at, keys: looked.append(len(keys)) or held(at, keys)
    assert table.find(keys).tolist() == [*range(1, 151), *[0] * 30]
    assert len(looked) > 1 and looked[0] == 180 and max(looked[1:]) < 180
    assert table.find(keys[:0]).tolist() == []
