"""Operator 12 against scores computed term by term."""

import collections
import math
import random
import re

import numpy as np
import pytest

from siftloom.llm import lexical_search as L

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "doc_id bigint, text string, score string, _item string, rank string"
ITEMS = "item_id bigint, text string, doc_id string"


def terms(text):
    lower = "".join(chr(ord(c) | 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(120)] + ["Ünit", "ünit", "ÉT", "naïve", "日本"]

    def text():
        return rnd.choice([" ", "-", "\x7f"]).join(
            rnd.choice(words).upper() if rnd.random() < 0.2 else rnd.choice(words)
            for _ in range(int(rnd.paretovariate(0.8) * 5) % 900))
    out = [(i, text()) for i in range(900)]
    out += [(2000 + i, "w1 w2 w3 copy") for i in range(30)]
    out += [(5, "w1 w2 w3 copy"), (None, "w1 w2 w3 copy"), (None, None), (3000, ""), (3001, "-_ \x00"),
            (3002, "w1 " * 200_000), (3003, "w" * 100_000), (3004, "w1 w2 w3 copy"), (3004, "w1 w2 w3 copy")]
    rnd.shuffle(out)
    return out


@pytest.fixture(scope="module")
def items():
    rnd = random.Random(4)
    out = [(i, " ".join(f"W{rnd.randint(0, 140)}" for _ in range(rnd.randint(1, 30)))) for i in range(25)]
    return out + [(30, "w1 w1 w2 copy"), (31, ""), (32, None), (33, "absent words"), (34, "ünit Ünit"),
                  (35, "ÉT ét"), (None, "w1")]


def by_brute_force(rows, items, top=10):
    counted = [(d, collections.Counter(terms(t))) for d, t in rows]
    n = sum(1 for _, c in counted if c)
    total = sum(sum(c.values()) for _, c in counted)
    held = collections.Counter(t for _, c in counted for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * h + 1))) for t, h in held.items()}
    out = []
    for item, text in items:
        scored = []
        for d, c in counted:
            m = 25 + (75 * sum(c.values()) * n) // total
            score = sum(weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in terms(text) if c[t])
            if score > 0:
                scored.append((-score, -(1 << 63) if d is None else d))
        for rank, (score, d) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, None if d == -(1 << 63) else d, -score))
    return sorted(out, key=str)


@pytest.mark.parametrize("lexical", [L.Lexical(), L.Lexical(head=1, focus=2, cells=3000),
                                     L.Lexical(head=60, block_bytes=300), L.Lexical(top=3, head=20)])
def test_search_matches_brute_force(spark, rows, items, lexical):
    docs = spark.createDataFrame([(*r, "s", "i", "r") for r in rows], SCHEMA).repartition(7)
    asked = spark.createDataFrame([(*r, "d") for r in items], ITEMS)
    got = L.lexical_search(docs, asked, lexical)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == by_brute_force(rows, items, lexical.top)


def test_bounds_spare_work():
    rnd = np.random.default_rng(1)
    dense = rnd.integers(0, 1000, (400, 30)) * (rnd.random((400, 30)) < 0.3)
    norms = np.sqrt((dense.astype(float) ** 2).sum(axis=1))
    query = L.Query(np.arange(12), rnd.integers(1, 9000, 12))
    scores = dense[:, query.terms] @ query.weights
    best = L.Best(10, int(np.sort(scores)[-10]))
    rescored = L._bucket_searched(dense, norms, np.arange(400), np.arange(400), [query], [best], 4)
    assert 10 <= rescored < 200
    assert [r[1] for r in best.rows] == np.lexsort((np.arange(400), -scores))[:10].tolist()
    assert not L._bucket_searched(dense[:1] * 0 + 1, np.ones(1), np.arange(1), np.arange(1), [query],
                                  [best], 4)


def test_empty_tables(spark, rows, items):
    none, asked = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(*r, "d") for r in items], ITEMS)
    docs = spark.createDataFrame([(*r, "s", "i", "r") for r in rows[:50]], SCHEMA)
    assert L.lexical_search(none, asked).count() == 0
    assert L.lexical_search(docs, spark.createDataFrame([], ITEMS)).count() == 0
