"""Operator 11 against all pairs, with common passages and every level of signatures."""

import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from siftloom.llm import ngram_join as J

WORD = re.compile("[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, _node string, component_id string, _sig string"


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(8)

    def words(n, stem="w"):
        return [f"{stem}{rnd.randint(0, 5000)}" for _ in range(n)]
    out, passage = [], words(60, "p")
    for i in range(120):  # one passage in many otherwise different texts
        out.append((i, " ".join(words(rnd.randint(5, 60)) + passage + words(rnd.randint(5, 30)))))
    for i in range(120, 160):  # texts that differ in little more than the passage
        out.append((i, " ".join(passage + words(rnd.randint(1, 6)))))
    base = words(150)
    for i in range(200, 260):  # copies with some words changed
        copy = list(base)
        for _ in range(rnd.randint(0, 4)):
            copy[rnd.randrange(150)] = rnd.choice(words(3))
        out.append((i, " ".join(copy[:rnd.randint(135, 150)])))
    for i in range(300, 420):  # short ones
        out.append((i, " ".join(rnd.choice("abc") for _ in range(rnd.randint(1, 14)))))
    for i in range(500, 540):
        long = words(rnd.randint(200, 600))
        out += [(i, " ".join(long)), (i + 100, " ".join(long[:int(len(long) * rnd.uniform(.7, 1))]).upper())]
    out += [(900, None), (901, ""), (902, " \t\n"), (903, None), (None, " ".join(base)), (None, "only here"),
            (200, "another text of the same id"), (905, "tie " * 4000), (906, "tie " * 3000),
            (907, " ".join(words(20_000))), (908, "x" * 150_000), (908, "x" * 150_000),
            (909, "Straße É a b c d"), (910, "straße É A B C D"), (911, "straße é a b c d")]
    rnd.shuffle(out)
    return out


def by_brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i
    held = {}
    for i, s in enumerate(sets):
        for g in s:
            held.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        near = {}
        for g in s:
            for j in held[g]:
                near[j] = near.get(j, 0) + 1
        for j, n in near.items():
            if j < i and 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                parent[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted([(d, len(s), least.get(top(i)) if s else d)
                   for i, ((d, _), s) in enumerate(zip(rows, sets))], key=str)


@pytest.mark.parametrize("join", [J.PartEnum(), J.PartEnum(block=4, leaders=1), J.PartEnum(block=16, levels=1)])
def test_components_match_brute_force(spark, rows, join):
    docs = spark.createDataFrame([(*r, "n", "c", "s") for r in rows], SCHEMA).repartition(5)
    got = J.ngram_join(docs, join)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == by_brute_force(rows)


@pytest.mark.parametrize("level", [0, 1, 2])
def test_similar_sets_share_a_signature(level):
    """Any similar pair has a common signature unless both sets may go on to the next level."""
    rnd = random.Random(level)
    join = J.PartEnum()
    for _ in range(400):
        size = int(rnd.paretovariate(0.6) * 3) % 900 + 1
        a = {rnd.getrandbits(63) for _ in range(size)}
        b = set(a)
        while True:
            change = set(b)
            if rnd.random() < 0.5 and change:
                change.remove(rnd.choice(sorted(change)))
            else:
                change.add(rnd.getrandbits(63))
            if 100 * len(a & change) < 80 * len(a | change):
                break
            b = change
        document = np.repeat([0, 1], [len(a), len(b)])
        element = np.array([*sorted(a), *sorted(b)], dtype=np.uint64)
        owner, found, free = J.signatures(document, element, 2, join, level)
        common = set(found[owner == 0].tolist()) & set(found[owner == 1].tolist())
        left = (free < 0).any(axis=1)
        assert common or left.all()


def test_schemes_leave_the_slack_they_state():
    join = J.PartEnum()
    for level in range(join.levels):
        for k in range(500):
            n1, n2, k2, slack = join.scheme(k, level)
            # with slack parts taken away, k differences cannot spoil all the others
            assert (n1 - slack) * (k2 + 1) > k and n2 > k2


def test_empty_table(spark):
    assert J.ngram_join(spark.createDataFrame([], SCHEMA)).count() == 0


def test_large_groups_meet_by_rare_shingles_only(spark):
    """A family with one passage takes rows in proportion to its texts, not to their pairs."""
    rnd, join = random.Random(3), J.PartEnum()
    passage = [f"p{i}" for i in range(90)]
    texts = [" ".join(passage + [f"w{rnd.randint(0, 10 ** 6)}" for _ in range(rnd.randint(6, 30))])
             for _ in range(150)]
    texts += [t + f" end{i}" for i, t in enumerate(texts[:40])]
    sets = [shingles(t) for t in texts]
    nodes = spark.createDataFrame(list(enumerate(texts)), "_node bigint, _text string")
    waiting = nodes.selectExpr("1L AS _sig", "_node", "_node AS _root").unionByName(
        nodes.selectExpr("2L AS _sig", "_node", "_node AS _root"))
    rows = J._rare(waiting, nodes, join).collect()
    held = {}
    for r in rows:
        held.setdefault(r["_node"], {})[r["_sig"]] = r["_asks"]
    for node, sigs in held.items():
        size = len(sets[node])
        assert len(sigs) <= size - -(-80 * size // 100) + 1
    links = {(i, j) for i in range(len(sets)) for j in range(i)
             if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert len(links) > 40
    for i, j in links:
        small, large = sorted((i, j), key=lambda k: len(sets[k]))
        common = held[small].keys() & held[large].keys()
        asked = [small] if len(sets[small]) < len(sets[large]) else [small, large]
        assert any(held[k][s] for s in common for k in asked)


def packed(texts, join, buckets):
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["_node", "_text"])
    return pa.Table.from_batches(J._signed(join, 0, buckets)([batch]))


def test_signatures_travel_in_few_bytes_and_meet():
    """Less than nine bytes a signature here; what two texts have meets in one bucket, once for copies of a slice."""
    rnd, join = random.Random(5), J.PartEnum()
    texts = [" ".join(f"w{rnd.randint(0, 10 ** 6)}" for _ in range(400)) for _ in range(50)]
    texts += [t + " end" for t in texts[:20]]
    sets = [J._sets(pa.array([t]), join)[0] for t in texts]
    document = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    owner, found, _ = J.signatures(document, np.concatenate(sets), len(sets), join, 0)
    table = packed(texts, join, 16)
    assert sum(table.column(n).nbytes for n in ("_sigs", "_nodes", "_counts")) < 9 * len(found)
    met = []
    twice = pa.concat_tables([table, table])
    for bucket in range(16):
        rows = twice.filter(pc.equal(twice.column("_bucket"), bucket))
        met += J._met((pa.scalar(bucket),), rows).to_pylist()
    assert sorted(r["_node"] for r in met if r["_sig"] is None) == list(range(len(texts)))
    held = {}
    for o, f in zip(owner.tolist(), found.tolist()):
        held.setdefault(f, set()).add(o)
    expected = sorted((min(h), len(h), o, f & 1) for f, h in held.items() if len(h) > 1 for o in h)
    assert sorted((r["_lead"], r["_n"], r["_node"], r["_sig"] & 1) for r in met if r["_sig"] is not None) == expected


def test_texts_with_too_few_common_signatures_are_left_out(spark):
    """A common passage gives signatures but no partner: such texts are not moved."""
    rnd, join = random.Random(6), J.PartEnum()
    passage = [f"p{i}" for i in range(60)]
    texts = [" ".join(passage + [f"w{rnd.randint(0, 10 ** 6)}" for _ in range(220)]) for _ in range(90)]
    texts += [t + f" end{i}" for i, t in enumerate(texts[:10])]
    docs = spark.createDataFrame(list(enumerate(texts)), "_node bigint, _text string")
    groups = J.materialize(J._groups(docs, join, 0), "groups")
    nodes = {r[0] for r in groups.where("_sig IS NOT NULL").select("_node").distinct().collect()}
    kept = {r[0] for r in J._members(groups, join).select("_node").distinct().collect()}
    assert len(nodes) > 60
    assert {*range(10), *range(90, 100)} <= kept and len(kept) < 30


def test_large_groups_are_dealt_to_several_shards(spark):
    """A leader meets many members in as many shards as these need."""
    pairs = spark.range(1, 1001).selectExpr("id AS _node", "id AS _root", "0L AS _lead")
    rows = J._led(pairs.union(pairs), J.PartEnum(shard=100)).collect()
    assert len(rows) == 1000 and len({r["_of"] for r in rows}) > 8


def test_bitmaps_keep_all_rows_of_the_nodes(spark):
    docs = spark.range(20_000).selectExpr("xxhash64(id) AS _node", "cast(id AS string) AS _text", "id")
    nodes = docs.where("id % 10 = 3").select("_node")
    found = {r["id"] for r in J._perhaps(docs, nodes).collect()}
    assert found >= set(range(3, 20_000, 10)) and len(found) < 4000
    assert {r["id"] for r in J._texts(docs, nodes).collect()} == set(range(3, 20_000, 10))
    assert J._texts(docs, nodes.limit(0)).count() == 0


def test_large_groups_are_judged_without_a_row_for_each_signature(spark, monkeypatch):
    """A component meets a node once, however many signatures the node has in large groups."""
    rnd, join = random.Random(9), J.PartEnum(block=8)
    passage = [f"p{i}" for i in range(90)]
    texts = [" ".join(passage + [f"w{rnd.randint(0, 10 ** 6)}" for _ in range(rnd.randint(6, 30))])
             for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts + [t + f" end{i}" for i, t in enumerate(texts[:20])] + texts[:5])]
    written, kept = {}, J.materialize

    def materialize(df, label):
        written.setdefault(label, []).append(kept(df, label))
        return written[label][-1]
    monkeypatch.setattr(J, "materialize", materialize)
    docs = spark.createDataFrame([(*r, "n", "c", "s") for r in rows], SCHEMA)
    got = J.ngram_join(docs, join)
    large = [g.where("_lead IS NOT NULL").count() for g in written["groups"][1::2]]
    assert len(large) == join.levels and min(large) > 10 * len(rows)
    # only the first round tells groups apart, by their second leaders
    assert all(w.count() <= len(rows) for w in written["waiting"][1:])
    # the components of all nodes are looked up once, too
    assert "LeftOuter" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, got.collect()), key=str) == by_brute_force(rows)


@pytest.mark.parametrize("buckets", [1, 7])
def test_only_groups_of_several_components_wait(spark, buckets):
    """The nodes of such groups, with their numbers of such signatures and the second leaders."""
    rnd = random.Random(buckets)
    sigs = [rnd.getrandbits(62) for _ in range(40)]
    held = [(n, [s for i, s in enumerate(sigs) if rnd.random() < (.5 if i < 20 else .05)]) for n in range(-20, 40)]
    root = {n: -20 if n < 20 else n // 10 * 10 for n, _ in held}
    groups = {s: [n for n, own in held if s in own] for s in sigs}
    nodes = spark.createDataFrame(held, "_node bigint, _sigs array<bigint>")
    roots = spark.createDataFrame([x for x in root.items() if x[0] != x[1]], "_node bigint, _root bigint")
    for leaders in (True, False):
        expected = {}
        for s, members in groups.items():
            if len({root[n] for n in members}) > 1:
                high = max(root[n] for n in members)
                second = max(n for n in members if root[n] == high)
                for n in members:
                    key = n, root[n], second if leaders and root[n] != high else n
                    expected.setdefault(key, [0, 0])[s & 1] += 1
        assert 0 < len({s for s, m in groups.items() if len({root[n] for n in m}) == 1})
        got = J._waiting(nodes, roots, buckets, leaders).collect()
        found = {}
        for r in got:
            counts = found.setdefault((r["_node"], r["_root"], r["_next"]), [0, 0])
            counts[0] += r["_even"]
            counts[1] += r["_odd"]
        assert found == expected
        assert len(got) == len(expected) or buckets > 1
