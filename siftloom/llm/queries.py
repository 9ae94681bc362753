"""One query for each operator, over its whole tables, and their SQL where it exists."""

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from siftloom.llm.oracle import SQL
from siftloom.llm.oracle_joins import SQL as JOIN_SQL
from siftloom.llm.rows import hex_sha256, whole
from siftloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model() -> bytes:
    """The public 32k merge model; only the driver reads the file."""
    import public_tokenizers
    return Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()


@query
def op1_substring_dedup(spark, sf_dir):
    from siftloom.llm.substring_dedup import substring_dedup
    cut = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed",
                      F.sha2("kept", 256).alias("kept_sha256"), "n_spans")


@query
def op2_weighted_fingerprints(spark, sf_dir):
    from siftloom.llm.weighted_fingerprints import fingerprints
    return fingerprints(table(spark, sf_dir, "documents"))


@query
def op3_mixing(spark, sf_dir):
    from siftloom.llm.mixing import mixed
    return mixed(table(spark, sf_dir, "documents")).drop("_d", "_h")


@query
def op4_toxicity(spark, sf_dir):
    from siftloom.llm.toxicity import toxicity
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_token_rollups(spark, sf_dir):
    """Insert all documents, count them anew by a second tokenizer, delete some, move some to
    another language, revise the texts of some; two of the batches come twice."""
    from siftloom.llm.token_rollups import TokenRollups, documents_as_changes
    docs = table(spark, sf_dir, "documents")
    rollups = TokenRollups(spark, scratch_path(spark, "rollups"))
    key = F.col("doc_id")
    batches = {
        "load": documents_as_changes(docs, "words-1", "insert", 1),
        "tokenizer": documents_as_changes(docs, "lexical-1", "insert", 1),
        "revisions": documents_as_changes(
            docs.where(key % 7 == 3).withColumn("text", F.concat("text", F.lit(" "), "text")),
            "words-1", "revise", 1)
        .unionByName(documents_as_changes(docs.where(key % 11 == 5), "lexical-1", "delete", 2)),
        "labels": documents_as_changes(docs.where(key % 13 == 4).withColumn("lang", F.lit("xx")),
                                       "words-1", "revise", 1)}
    for name in ("load", "tokenizer", "load", "revisions", "labels", "revisions"):
        rollups.apply(name, batches[name])
    return rollups.totals()


@query
def op6_sentencepiece_codec(spark, sf_dir):
    from siftloom.llm.sentencepiece_codec import encode_documents
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_documents(docs, piece_model())
    return coded.select(
        "doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"),
        hex_sha256(F.array_join(F.col("token_ids").cast("array<string>"), ","))
        .alias("ids_sha256"), hex_sha256(whole("decoded")).alias("decoded_sha256"))


@query
def op7_suffix_array_dedup(spark, sf_dir):
    from siftloom.llm.suffix_array_dedup import suffix_dedup
    cut = suffix_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans",
                      F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_quality_rules(spark, sf_dir):
    from siftloom.llm.quality_rules import quality
    return quality(table(spark, sf_dir, "documents"))


@query
def op9_kd_sharding(spark, sf_dir):
    from siftloom.llm.kd_sharding import shard
    return shard(table(spark, sf_dir, "documents"))


@query
def op10_minhash_near_dedup(spark, sf_dir):
    from siftloom.llm.minhash_near_dedup import near_classes
    return near_classes(table(spark, sf_dir, "documents"))


@query
def op11_ngram_join(spark, sf_dir):
    from siftloom.llm.ngram_join import ngram_join
    return ngram_join(table(spark, sf_dir, "documents"))


@query
def op12_lexical_search(spark, sf_dir):
    from siftloom.llm.lexical_search import lexical_search
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_conversation_trie(spark, sf_dir):
    from siftloom.llm.conversation_trie import conversation_trie
    return conversation_trie(table(spark, sf_dir, "conversations")).drop("node", "parent")


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


ORACLE: dict[str, str] = SQL | JOIN_SQL | {
    "op5_token_rollups": r"""
WITH words AS (
  SELECT doc_id, source, CASE WHEN doc_id % 13 = 4 THEN 'xx' ELSE lang END AS lang, 'words-1' AS tokenizer,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))
      * CASE WHEN doc_id % 7 = 3 AND doc_id % 13 <> 4 THEN 2 ELSE 1 END AS tokens
  FROM documents),
lexical AS (
  SELECT doc_id, source, lang, 'lexical-1' AS tokenizer,
    len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_\x20\x09-\x0D]')) AS tokens
  FROM documents WHERE doc_id % 11 <> 5)
SELECT source, lang, tokenizer, CAST(count(*) AS BIGINT) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens
FROM (SELECT * FROM words UNION ALL SELECT * FROM lexical)
GROUP BY source, lang, tokenizer""",
}
