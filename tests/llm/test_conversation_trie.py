"""Operator 13 against a trie built in memory, with borrowed turns and odd rows."""

import hashlib
import random
import zlib

import pytest

from siftloom.llm import conversation_trie as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string, _key string, node string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256"]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    out = []
    for c in [*range(0, 260), 305, 1000, 1007]:
        for t in range(rnd.choice([0, 1, 2, 3, 5, 8])):
            out.append((c, t, rnd.choice(["user", "assistant"]), rnd.choice(["a", "bé", "c d"])))
    out += [(700 + i, t, "user", f"same {t}") for i in range(60) for t in range(7)]
    out += [(100, None, "user", "first of all"), (101, None, None, None), (102, 1, "", ""),
            (None, 0, "user", "no id"), (None, 1, "user", "no id"), (103, 2, "user", "x" * 200_000),
            (104, 2, "user", "tie"), (104, 2, "user", "tie"), (104, 2, "user", "tie, another")]
    out += [(2000, t, "user", f"long {t}") for t in range(900)]
    rnd.shuffle(out)
    return out


def digest(role, text):
    role, text = role or "", text or ""
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def by_brute_force(rows):
    low = -(1 << 63)
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(low if c is None else c, []).append(
            (t is not None, t or 0, digest(r, x), (r or "", x or "")))
    convs = {c: [t[3] for t in sorted(own)] for c, own in convs.items()}
    full = {}
    for c, own in convs.items():
        h = 0 if c == low else zlib.crc32(str(c).encode()) % 6
        full[c] = tuple(convs.get(c - c % 100, [])[:h] + own[h:]) if h else tuple(own)
    members, ends = {}, {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
        ends.setdefault(turns, []).append(c)
    children = {}
    for key in members:
        if key:
            children[key[:-1]] = children.get(key[:-1], 0) + 1
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        leaves[key] = leaves.get(key, 0) or 1
        saved[key] = saved.get(key, 0) + (len(members[key]) - 1) * (len(key[-1][1]) if key else 0)
        if key:
            leaves[key[:-1]] = leaves.get(key[:-1], 0) + leaves[key]
            saved[key[:-1]] = saved.get(key[:-1], 0) + saved[key]

    def shown(c):
        return None if c == low else c
    return sorted([(shown(min(m)), len(k), shown(min(members[k[:-1]])) if k else None, len(m),
                    children.get(k, 0), leaves[k], saved[k],
                    hashlib.sha256(",".join("" if c == low else str(c) for c in sorted(
                        ends.get(k, []))).encode()).hexdigest()) for k, m in members.items()], key=str)


@pytest.mark.parametrize("trie", [C.Trie(), C.Trie(shard=1, most_above=10**6),
                                  C.Trie(shard=8, queued=5)])
def test_trie_matches_brute_force(spark, rows, trie):
    given = spark.createDataFrame([(*r, "k", "n") for r in rows], SCHEMA)
    got = C.conversation_trie(given, trie).select(COLUMNS).collect()
    assert sorted([tuple(r) for r in got], key=str) == by_brute_force(rows)


def test_nodes_have_names(spark, rows):
    got = C.conversation_trie(spark.createDataFrame([(*r, "k", "n") for r in rows], SCHEMA)).collect()
    names = {r.node: r for r in got}
    assert len(names) == len(got)
    for r in got:
        assert r.parent is None if r.depth == 0 else names[r.parent].depth == r.depth - 1


def test_no_conversations(spark):
    assert C.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("limit", [3, 1000])
def test_queue_keeps_its_order(limit):
    rnd = random.Random(limit)
    queue, plain = C.MessageQueue(limit), []
    for _ in range(400):
        if plain and rnd.random() < 0.4:
            plain.sort()
            assert queue.head() == plain[0] and queue.pop() == plain.pop(0)
        else:
            message = (rnd.randint(-4, 4), bytes([rnd.randint(0, 3)]) * 16, rnd.randint(0, 9), 1)
            queue.push(message)
            plain.append(message)
    assert [queue.pop() for _ in plain] == sorted(plain) and queue.head() is None
