"""run() over planted documents against the five stages done in plain Python."""

import hashlib
import random
import re

import pytest

import corpus_pipeline
from siftloom.llm import mixing as X

WORD = re.compile("[^\x20\x09-\x0D]+")
TOXIC = ("vilest", "nastiest", "foulest")


@pytest.fixture(scope="module")
def planted():
    """(documents, toxic ids): clean ones, toxic ones, copies, near copies, shared passages."""
    rnd = random.Random(13)

    def words(n):
        return [f"w{rnd.randint(0, 4000)}" for _ in range(n)]
    texts, toxic = {}, set()
    for i in range(600):
        own = words(rnd.randint(40, 90))
        if i % 6 == 0:
            toxic.add(i)
            for word in TOXIC:
                own.insert(rnd.randrange(len(own)), word)
        texts[i] = " ".join(own)
    for i in range(600, 640):  # exact copies
        texts[i] = texts[i - 599]
    for i in range(640, 680):  # near copies: one word of a long text changed
        base = texts[i - 399].split() if i % 2 else texts[i - 639].split()
        base[len(base) // 2] = "changed"
        texts[i] = " ".join(base)
    passage = " ".join(words(60))
    for i in range(700, 720):  # a passage of more than 200 bytes in otherwise different texts
        texts[i] = " ".join(words(200)) + "\n" + passage + "\n" + " ".join(words(150))
    toxic |= {i for i, t in texts.items() if TOXIC[0] in t.split()}
    rows = [(i, t, rnd.choice(["en", "de"]), f"src{i % 4}", len(t)) for i, t in texts.items()]
    return rows, toxic


def near_deduplicated(docs):
    """Smallest id of each class of five-word sets with a similarity of 0.8."""
    sets = {}
    for i, t in docs.items():
        w = WORD.findall(t)
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set())
    parent = {i: i for i in docs}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i
    held = {}
    for i, s in sets.items():
        for g in s:
            held.setdefault(g, []).append(i)
    for i, s in sets.items():
        shared = {}
        for g in s:
            for j in held[g]:
                shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if j < i and n >= 0.8 * (len(s) + len(sets[j]) - n):
                low, high = sorted((top(i), top(j)))
                parent[high] = low
    return {i: t for i, t in docs.items() if top(i) == i}


def without_repeats(docs, width=200):
    places = {}
    data = {i: t.encode() for i, t in docs.items()}
    for i, t in data.items():
        for j in range(len(t) - width + 1):
            places.setdefault(t[j:j + width], []).append((i, j))
    gone = {i: bytearray(len(t)) for i, t in data.items()}
    for found in places.values():
        if len(found) > 1:
            for i, j in found:
                gone[i][j:j + width] = b"\x01" * width
    return {i: bytes(b for b, g in zip(t, gone[i]) if not g).decode() for i, t in data.items()}


def filled(capacity, weight, budget):
    low, high = 0.0, max((c / w for c, w in zip(capacity, weight)), default=0.0)
    for _ in range(200):
        middle = (low + high) / 2
        if sum(min(c, w * middle) for c, w in zip(capacity, weight)) < budget:
            low = middle
        else:
            high = middle
    return [min(c, w * high) for c, w in zip(capacity, weight)]


def mixed(docs, mix):
    """Ids that fit the budgets; ``docs`` are id: (leaf, tokens)."""
    leaves = {}
    for leaf, n in docs.values():
        leaves[leaf] = leaves.get(leaf, 0) + n

    def descend(prefix, budget):
        if len(prefix) == 3:
            return {prefix: budget}
        names = sorted({k[len(prefix)] for k in leaves if k[:len(prefix)] == prefix})
        capacity = [mix.epochs * sum(n for k, n in leaves.items() if k[:len(prefix) + 1] == (*prefix, name))
                    for name in names]
        weight = [mix.weights.get(X.LEVELS[len(prefix)], {}).get(name, 1.0) for name in names]
        out = {}
        for name, share in zip(names, filled(capacity, weight, budget)):
            out |= descend((*prefix, name), share)
        return out
    total = sum(leaves.values())
    budgets = descend((), min(total * mix.share, total * mix.epochs))
    kept = set()
    for leaf, budget in budgets.items():
        own = sorted((i for i in docs if docs[i][0] == leaf),
                     key=lambda i: hashlib.md5(f"{mix.seed}:{0 if budget + 1e-6 < leaves[leaf] else 1}:{i}".encode()).hexdigest())
        rest = min(int(budget + 1e-6), leaves[leaf])
        if rest == leaves[leaf]:
            kept |= set(own)
            continue
        for i in own:
            rest -= docs[i][1]
            if rest < 0:
                break
            kept.add(i)
    return kept


def test_run_matches_the_stages_in_plain_python(spark, planted, tmp_path):
    import public_tokenizers
    import sentencepiece
    rows, toxic = planted
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"
                          ).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i % 7 > 0), int(i in toxic)) for i, *_ in rows if i % 3 == 0]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    clean = {i: t for i, t, *_ in rows if i not in toxic}
    cut = without_repeats(near_deduplicated(clean))
    domains = ("web", "code", "books")
    known = {i: (lang, source) for i, _, lang, source, _ in rows}
    leaves = {i: ((domains[int(known[i][1][3:]) % 3], *known[i]), len(WORD.findall(t)))
              for i, t in cut.items()}
    kept = mixed(leaves, corpus_pipeline.MIX)
    assert len(kept) < len(cut) < len(clean)
    assert set(got) == kept
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for i in kept:
        ids = model.encode(cut[i])
        assert list(got[i].token_ids) == ids and got[i].decoded == model.decode(ids)


def test_stages_take_odd_rows(spark, planted, tmp_path):
    """Nulls in any column, empty and very long texts, repeated rows; and no rows at all."""
    rows, toxic = planted
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    odd = [(None, None, None, None, None), (None, "no id", None, "src1", 5), (9000, "", "en", None, 0),
           (9001, "x " * 60_000, "en", "src1", None), (9001, "x " * 60_000, "en", "src1", None),
           (9002, "ab" * 60_000, None, "src2", 1)]
    spark.createDataFrame([(i, 1, int(i in toxic)) for i, *_ in rows[:300]],
                          "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(rows[:300] + odd, schema)
    for docs in (docs, docs.limit(0)):
        before = docs.count()
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(
                spark, docs, str(tmp_path)).cache()
            assert docs.schema.names == [f.split()[0] for f in schema.split(", ")]
        assert docs.count() <= before
        last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert last.count() == docs.count()
