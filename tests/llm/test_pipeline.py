"""The five stages on the smallest tables, and their order."""

import corpus_pipeline
from siftloom.llm.queries import QUERIES

TINY = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_of_documents(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "minhash_near_dedup", "suffix_array_dedup", "mixing",
                     "sentencepiece_codec"]
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, TINY)
        docs = docs.cache()
        assert docs.columns == columns, name
        assert 0.5 * before < docs.count() <= before
        before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, TINY).collect()
    assert len(last) == before and all(r.token_ids for r in last if r.decoded)


def test_near_dedup_keeps_different_texts_of_one_id(spark):
    def text(stem, words=60):
        return " ".join(f"{stem}{i}" for i in range(words))
    near = text("a", 59) + " changed"
    rows = [(None, text("a")), (None, text("b")), (None, text("b")), (None, text("b", 40) + " end"),
            (7, text("c")), (7, text("d")), (8, near), (9, text("d")), (9, None), (None, ""),
            (4, "x"), (4, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = corpus_pipeline.minhash_near_dedup(spark, docs, TINY)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(None, text("a")), (None, text("b")), (None, text("b", 40) + " end"), (7, text("c")),
         (7, text("d")), (None, ""), (4, "x")], key=str)


def test_every_operator_has_one_query():
    numbers = [n.split("_")[0] for n in QUERIES if n.startswith("op")]
    assert sorted(numbers) == sorted(f"op{i}" for i in range(1, 14))
