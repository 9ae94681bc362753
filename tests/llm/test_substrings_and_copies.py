"""Operators 1, 7 and 10 against brute force, on small tables with every odd case."""

import dataclasses
import random

import numpy as np
import pytest

from siftloom.llm import minhash_near_dedup as M
from siftloom.llm import substring_dedup as S
from siftloom.llm import suffix_array_dedup as A

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
FULL = SCHEMA + ", _d string, _row string, kept string, _bucket string"


def sentence(rnd, n, words=400):
    return " ".join(f"w{rnd.randint(0, words)}é" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    shared, base = sentence(rnd, 60), sentence(rnd, 120)
    out = [(i, sentence(rnd, rnd.randint(1, 40))) for i in range(30)]
    out += [(30 + i, f"{sentence(rnd, 20)}\n{shared}\t{sentence(rnd, 20)}") for i in range(25)]
    out += [(60 + i, base) for i in range(4)]
    edited = base.split()
    edited[50] = "changed"
    out += [(70, " ".join(edited)), (71, ""), (72, None), (73, " \n\t "), (74, "a" * 700),
            (75, "line of text\n" * 60), (76, "b"), (76, "c " * 30), (77, sentence(rnd, 9000)),
            (None, shared), (60, base), (78, "\x1f  x y " * 30)]
    rnd.shuffle(out)
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(
        [(i, t, None if i is None else "en", "src0", 0, "x", "y", "z", "b") for i, t in rows], FULL)


def key(i):
    return -(1 << 63) if i is None else i


def by_brute_force(rows, width, split, later_only):
    units = [(key(i), split((t or "").encode())) for i, t in rows]
    places = {}
    for n, (i, u) in enumerate(units):
        for j in range(len(u) - width + 1):
            places.setdefault(bytes(u[j:j + width]) if isinstance(u, bytes)
                              else tuple(u[j:j + width]), []).append(i)
    out = []
    for i, u in units:
        gone = np.zeros(len(u), dtype=bool)
        for j in range(len(u) - width + 1):
            found = places[bytes(u[j:j + width]) if isinstance(u, bytes) else tuple(u[j:j + width])]
            if min(found) < i if later_only else len(found) > 1:
                gone[j:j + width] = True
        out.append((i, [x for x, g in zip(u, gone) if not g], int(gone.sum())))
    return out


@pytest.mark.parametrize("spread", [4000, 3])
def test_words_of_earlier_documents_go(docs, rows, spread):
    search = dataclasses.replace(S.BY_WORDS, salted_beyond=spread, shard_bytes=3000)
    got = S.substring_dedup(docs, search).collect()
    want = by_brute_force(rows, 13, bytes.split, True)
    assert sorted((key(r.doc_id), bytes(r.kept), r.n_removed) for r in got) == sorted(
        (i, b" ".join(u), n) for i, u, n in want)
    assert sum(r.n_removed for r in got) > 1000


@pytest.mark.parametrize("spread", [4000, 3])
def test_repeated_bytes_go(docs, rows, spread):
    search = dataclasses.replace(A.BY_BYTES, salted_beyond=spread, shard_bytes=3000)
    got = A.suffix_dedup(docs, search).collect()
    want = by_brute_force(rows, 200, lambda t: t, False)
    assert sorted((key(r.doc_id), bytes(r.kept), r.n_removed) for r in got) == sorted(
        (i, bytes(u), n) for i, u, n in want)
    assert all((r.n_spans > 0) == (r.n_removed > 0) for r in got)


def test_cut_texts_stay_text(docs):
    out = A.without_repeated_strings(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[72] is None and texts[71] == "" and texts[74] == "" and "w" in texts[77]
    assert not any("�" in t for t in texts.values() if t)


@pytest.mark.parametrize("alphabet", [1, 2, 3, 20])
def test_suffix_array_is_sorted(alphabet):
    rnd = random.Random(alphabet)
    for _ in range(150):
        s = [rnd.randint(1, alphabet) for _ in range(rnd.randint(0, 60))] + [0]
        assert A.suffix_array(np.array(s, dtype=np.int16)).tolist() == sorted(
            range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("text", [b"ab" * 1_000_000, b"=-=--" * 100_000, b"x " * 200_000])
def test_periodic_texts_take_seconds(text):
    import time
    start = time.perf_counter()
    flags = A.repeated_windows([text, b"c" * 300], [1, 2], A.BY_BYTES)
    assert flags[0].all() and len(flags[0]) == len(text) - 199 and flags[1].all()
    assert time.perf_counter() - start < 30


def test_automaton_knows_the_first_owner():
    rnd = random.Random(1)
    for _ in range(100):
        texts = [[str(rnd.randint(0, 2)) for _ in range(rnd.randint(2, 9))] for _ in range(4)]
        automaton = S.SuffixAutomaton()
        for owner, words in enumerate(texts):
            automaton.add(words, owner)
        for words in texts:
            for j, owner in enumerate(automaton.owners(words, 3)):
                assert owner == next(i for i, t in enumerate(texts) for m in range(len(t) - 2)
                                     if t[m:m + 3] == words[j:j + 3])


def test_near_classes_match_brute_force(docs, rows):
    """A document is an id and a text."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().split()
        sets[key(i), t or ""] = frozenset(tuple(w[j:j + 5]) for j in range(len(w) - 4)) or (
            frozenset([tuple(w)] if w else []))
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d
    for a, x in sets.items():
        for b, y in sets.items():
            if a < b and (a[1] == b[1] or x and y and len(x & y) >= 0.8 * len(x | y)):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    least = {}
    for d in sets:
        least[root(d)] = min(least.get(root(d), d[0]), d[0])
    got = M.near_classes(docs).collect()
    assert sorted((key(r.doc_id), key(r.class_id)) for r in got) == sorted(
        (key(i), least[root((key(i), t or ""))]) for i, t in rows)
    # all that have the class's id stay unless several texts of the id are in the class
    assert {key(r.doc_id) for r in got if r.kept} == set(least.values())
    kept = M.near_dedup_apart(docs)
    assert kept.columns == docs.columns and kept.count() == len(least)


def test_documents_without_id_do_not_join_others(spark):
    rnd = random.Random(11)
    a, b = sentence(rnd, 40), sentence(rnd, 40)
    docs = spark.createDataFrame([(None, a), (None, b), (5, b), (6, a)], "doc_id bigint, text string")
    got = {(r.doc_id, r.class_id, r.kept) for r in M.near_classes(docs).collect()}
    assert got == {(None, None, True), (5, None, False), (6, None, False)}
    assert {r.text for r in M.near_dedup_apart(docs).collect()} == {a, b}


def test_signatures_of_short_texts_stay_small():
    """A slice of many short texts may not take more memory than one of few long ones."""
    import tracemalloc

    import pyarrow as pa
    rnd = random.Random(2)
    texts = [sentence(rnd, 12) for _ in range(5000)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(5000), pa.int64()), pa.array([str(i) for i in range(5000)]), pa.array(texts)],
        names=["_d", "_copy", "_text"])
    tracemalloc.start()
    held = sum(out.num_rows for out in M._banded(M.Darts())(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held == 5000 and peak < 64 << 20


def test_word_hashes_tell_long_words_apart():
    """Two words that a sum of powers modulo 2^64 cannot tell apart."""
    from siftloom.llm.rows import word_bounds, word_hashes
    word, other = "a", "b"
    for _ in range(10):
        word, other = word + other, other + word
    data = np.frombuffer(f"{word} {other}".encode(), dtype=np.uint8)
    starts, ends, _ = word_bounds(data, np.array([0, len(data)]))
    first, second = word_hashes(data, starts, ends)
    assert len(word) == 1024 and first != second


def test_darts_estimate_weighted_similarity():
    rnd = np.random.default_rng(0)
    element = rnd.integers(0, 2**63, 60, dtype=np.int64).view(np.uint64)
    a, b = rnd.integers(0, 6, 60).astype(float), rnd.integers(0, 6, 60).astype(float)
    document = np.repeat([0, 1], 60)
    weight = np.concatenate([a, b])
    own = weight > 0
    signed, filled = M.signatures(document[own], np.concatenate([element, element])[own],
                                  weight[own], 2, 2000)
    assert filled.all()
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((signed[0] == signed[1]).mean() - true) < 0.05


def test_components_close_chains(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 103), (103, 101), (7, 3)]
    got = M.components(spark.createDataFrame(chain, "_a bigint, _b bigint")).collect()
    assert {r._node: r._root for r in got} == {
        **{i: 0 for i in range(1, 41)}, 101: 100, 103: 100} | {
            r._node: r._root for r in got if r._node == r._root}


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert S.substring_dedup(none).count() == 0
    assert A.suffix_dedup(none).count() == 0
    assert M.near_classes(none).count() == 0 and M.near_dedup_apart(none).count() == 0
