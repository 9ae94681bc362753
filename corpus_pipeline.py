"""A corpus from raw documents to token ids, in five stages that are each written and reread.

Toxic documents go, one document of each near-duplicate class stays, long strings that
repeat are cut, sources are mixed to target weights, and what is left is encoded. Every stage
but the last returns the columns of documents.
"""

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftloom.llm.minhash_near_dedup import near_dedup_apart
from siftloom.llm.mixing import Mix, mixture
from siftloom.llm.sentencepiece_codec import encode_documents
from siftloom.llm.suffix_array_dedup import without_repeated_strings
from siftloom.llm.toxicity import without_toxic
from siftloom.session import materialize

#: Every document at most once; a tenth of the tokens makes room for the weights.
MIX = Mix(share=0.9, epochs=1)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain trained on the given labels does not call toxic."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate class; different texts that
    share an id or have none are documents of their own."""
    return near_dedup_apart(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without strings of 200 bytes that occur elsewhere too."""
    cut = without_repeated_strings(docs)
    return cut.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that fit the budgets of their domain, language and source."""
    return mixture(docs, MIX)


def sentencepiece_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, token_ids and the text they decode to."""
    import public_tokenizers
    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    return encode_documents(docs, model).select("doc_id", "lang", "source", "token_ids", "decoded")


STAGES = [("toxicity", toxicity), ("minhash_near_dedup", minhash_near_dedup),
          ("suffix_array_dedup", suffix_array_dedup), ("mixing", mixing),
          ("sentencepiece_codec", sentencepiece_codec)]

#: Near-duplicate classes, suffix arrays and the merge model are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
