"""Operators 2 and 6: exact round trips and brute force."""

import collections
import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from siftloom.llm import sentencepiece_codec as P
from siftloom.llm import weighted_fingerprints as W

TEXTS = ["", None, " ", "  a  b ", "▁x ▁▁", "日本語\x00x", "é é ﬁ ½", "<s> hi </s> <unk>", "<0x0A>",
         "\n\t x\r\n", "😀😀 ok", "x" * 3000, "the " * 500, "word,word;word" * 40, "a​b"]


@pytest.fixture(scope="module")
def model():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def test_encoding_is_the_librarys(model):
    codec = P.Codec(model)
    rnd = random.Random(2)
    pieces = list(codec.rank)
    texts = [t for t in TEXTS if t is not None]
    for _ in range(3000):
        texts.append("".join(rnd.choice([" ", "e", "th", "\n", "▁", "日", "́"])
                             if rnd.random() < 0.6 else rnd.choice(pieces)
                             for _ in range(rnd.randint(0, 12))))
    for text in texts:
        assert codec.encode(text) == codec.library.encode(text), text


def test_pairs_agree_with_merging(model):
    codec = P.Codec(model)
    rnd = random.Random(3)
    pieces = [p for p in codec.rank if P.SPACE * 2 not in p]
    for _ in range(4000):
        left, right = rnd.choice(pieces), rnd.choice(pieces)
        assert codec.remerged(left, right) == (codec.merged(left + right) == [left, right])


def test_documents_are_encoded_whole(spark, model):
    codec = P.Codec(model)
    docs = spark.createDataFrame(
        [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], None), (None, "a", "b")],
        "doc_id bigint, text string, decoded string")
    rows = P.encode_documents(docs, model).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        assert r.token_ids == codec.library.encode(r.text or "")
        assert r.decoded == codec.library.decode(r.token_ids) if r.token_ids else r.decoded == ""
    empty = P.encode_documents(docs.limit(0), model)
    assert empty.count() == 0 and empty.columns == ["doc_id", "text", "token_ids", "decoded"]


def likeness(a, b):
    a, b = (collections.Counter((t or "").encode().split()) for t in (a, b))
    most = sum((a | b).values())
    return sum((a & b).values()) / most if most else 1.0


def test_edited_texts_and_likeness(spark):
    rnd = random.Random(4)
    rows = [(i * 3, " ".join(f"w{rnd.randint(0, 600)}" for _ in range(rnd.randint(1, 300))))
            for i in range(60)]
    rows += [(1, None), (4, ""), (7, "déjà vu " * 50), (10, "déjà vu " * 50), (13, "x")]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows],
                                 "doc_id bigint, text string, fingerprint string")
    got = {r.doc_id: r for r in W.fingerprints(docs, samples=64).collect()}
    ordered = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    errors = []
    for n, (i, text) in enumerate(ordered):
        text, following = text or "", ordered[(n + 1) % len(rows)][1] or ""
        third = len(text) // 3
        edited = text[:len(text) - third] + following[:third]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors.append(got[i].near_edited - likeness(text, edited))
        errors.append(got[i].near_next - likeness(text, following))
    assert got[7].fingerprint == got[10].fingerprint != got[13].fingerprint
    assert got[1].fingerprint == "" and got[1].near_edited == 1.0
    assert max(map(abs, errors)) < 0.3 and abs(sum(errors) / len(errors)) < 0.02


def test_accuracy_of_the_registered_size(spark):
    rnd = random.Random(6)
    rows = [(i, " ".join(f"w{rnd.randint(0, 900)}" for _ in range(150))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in W.fingerprints(docs).collect()}
    errors = []
    for i, text in rows:
        following, third = rows[i - 1][1], len(text) // 3
        edited = text[:len(text) - third] + following[:third]
        errors.append(got[i].near_edited - likeness(text, edited))
    # 64 samples have a standard error of 0.0625 at 0.5, 32 have 0.088
    assert max(map(abs, errors)) < 0.3
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.072


def test_odd_tables_of_fingerprints(spark):
    docs = spark.createDataFrame([(5, "a b c d"), (5, "a b c d"), (5, "e f"), (None, "g h i")],
                                 "doc_id bigint, text string")
    rows = W.fingerprints(docs).collect()
    assert len(rows) == 4 and sum(r.doc_id is None for r in rows) == 1
    assert W.fingerprints(docs.limit(0)).count() == 0
    alone = W.fingerprints(docs.where("doc_id IS NULL")).first()
    assert alone.near_next == 1.0


def test_fingerprints_stay_in_the_engine(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    plan = W.fingerprints(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert F.col("x") is not None
