"""Operator 5: token totals by source, language and tokenizer version, kept up by deltas.

A batch of changes becomes signed rows: what a document added before is taken out, what it adds
now is put in. The rows are kept as the ledger of their batch, and their sums as the batch's
rollup; totals are sums of rollups, so no batch ever reads a text again. A batch is
written into folders of its own and counts only once its commit is written, so it can
be repeated after a failure, and a batch that is committed is not applied again.
"""

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftloom.llm.rows import id_key, text_key, whole

ENTRY = "doc_id bigint, part string, source string, lang string, tokenizer string, docs bigint, tokens bigint"
DOCUMENT = ("doc_id", "part")
KEYS = ("source", "lang", "tokenizer")
COUNTERS = {"words-1": r"[^\x20\x09-\x0D]+",
            "lexical-1": r"[A-Za-z0-9_]+|[^A-Za-z0-9_\x20\x09-\x0D]"}


def counted(text, tokenizer: str) -> Column:
    """Number of tokens of a text by one of the lexical tokenizers; null has none."""
    return F.regexp_count(whole(text), F.lit(COUNTERS[tokenizer])).cast("bigint")


def counted_by_model(docs: DataFrame, path: str, pattern: str, text: str = "text",
                     name: str = "tokens") -> DataFrame:
    """The documents with their number of tokens under a byte-level vocabulary of ranks."""
    import base64
    from collections.abc import Iterator

    import pandas as pd
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken
        model = tiktoken.Encoding("counter", pat_str=pattern, mergeable_ranks=ranks,
                                  special_tokens={})
        for batch in batches:
            yield batch.map(lambda t: len(model.encode_ordinary(t)))
    return docs.withColumn(name, count(whole(text)))


class TokenRollups:
    """Rollups below one shared folder.

    Changes have (doc_id, tokenizer, action, source, lang, tokens, seq): ``insert`` and ``revise`` put
    the row in the place of what the document had under that tokenizer, ``delete`` takes it out
    whatever the other columns say. An optional column ``part`` tells documents apart that share
    an id or have none; it counts as '' where it is absent or null. Of several changes of a document
    in a batch the last by ``seq`` counts (ties: the largest row). A delete of an unknown
    document changes nothing. Null labels are labels of their own, null tokens count 0,
    changes without tokenizer or known action are refused by ``apply``. An empty batch is
    committed and changes nothing; totals of no batches are empty.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        if not self._exists("commits"):
            none = spark.createDataFrame([], ENTRY)
            self._write(none, "ledger", "start")
            self._write(none.select(*KEYS, "docs", "tokens"), "rollup", "start")
            self._commit("start", 0)

    def _exists(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _write(self, df: DataFrame, kind: str, batch: str) -> None:
        df.write.mode("overwrite").parquet(f"{self.folder}/{kind}/batch={batch}")

    def _commit(self, batch: str, rows: int) -> None:
        self._write(self.spark.createDataFrame([(rows,)], "n_changes bigint"), "commits", batch)

    def _read(self, kind: str, schema: str) -> DataFrame:
        """Rows of committed batches only."""
        rows = self.spark.read.schema(f"{schema}, batch string").parquet(f"{self.folder}/{kind}")
        done = self.spark.read.schema("n_changes bigint, batch string").parquet(
            f"{self.folder}/commits").select("batch")
        return rows.join(done, "batch", "left_semi")

    def current(self) -> DataFrame:
        """What each document adds now: (doc_id, part, labels, tokenizer, docs, tokens)."""
        return (self._read("ledger", ENTRY).groupBy(*DOCUMENT, *KEYS)
                .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
                .where("docs <> 0 OR tokens <> 0"))

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch; False if it was committed before."""
        if not re.fullmatch(r"[A-Za-z0-9_-]+", batch):
            raise ValueError(f"batch name {batch!r}")
        if self._exists(f"commits/batch={batch}/_SUCCESS"):
            return False
        columns = ("action", "source", "lang", "tokens")
        last = Window.partitionBy(*DOCUMENT, "tokenizer").orderBy(
            F.desc("seq"), *[F.desc(c) for c in columns])
        part = F.coalesce("part", F.lit("")) if "part" in changes.columns else F.lit("")
        # the ledger has no null keys, so joins and groups agree
        checked = changes.select(id_key("doc_id").alias("doc_id"), part.alias("part"), F.when(
            F.col("tokenizer").isNull()
            | ~F.coalesce(F.col("action"), F.lit("")).isin("insert", "revise", "delete"),
            F.raise_error(F.lit("a change needs a tokenizer and a known action")))
            .otherwise(F.col("tokenizer")).alias("tokenizer"), *columns, "seq")
        final = checked.withColumn("_n", F.row_number().over(last)).where("_n = 1")
        out = self.current().join(final.select(*DOCUMENT, "tokenizer"), [*DOCUMENT, "tokenizer"],
                                  "left_semi")
        out = out.select(*DOCUMENT, *KEYS, (-F.col("docs")).alias("docs"),
                         (-F.col("tokens")).alias("tokens"))
        put = final.where("action <> 'delete'").select(
            *DOCUMENT, *KEYS, F.lit(1).cast("bigint").alias("docs"),
            F.coalesce(F.col("tokens").cast("bigint"), F.lit(0)).alias("tokens"))
        # a row that stays as it is cancels out and is not kept
        entries = out.unionByName(put).groupBy(*DOCUMENT, *KEYS).agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where(
                "docs <> 0 OR tokens <> 0")
        self._write(entries, "ledger", batch)
        written = self.spark.read.schema(ENTRY).parquet(f"{self.folder}/ledger/batch={batch}")
        self._write(written.groupBy(*KEYS).agg(F.sum("docs").alias("docs"),
                                               F.sum("tokens").alias("tokens")), "rollup", batch)
        self._commit(batch, written.count())
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens) from the committed rollups."""
        return (self._read("rollup", "source string, lang string, tokenizer string, "
                                     "docs bigint, tokens bigint")
                .groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
                .where("docs <> 0"))


def documents_as_changes(docs: DataFrame, tokenizer: str, action: str, seq: int,
                         text: str = "text") -> DataFrame:
    """One change for every row, with its lexical count.

    Rows that share an id are documents of their own, ``part`` 1, 2, ... in the order of a hash of
    their texts (the first has ''); rows without id are told apart by that hash, and numbered if
    the text repeats. So a table that is loaded again revises the same documents.
    """
    key = F.col("doc_id").isNull()
    rows = docs.select("doc_id", text_key(text).alias("_h"), "source", "lang",
                       counted(text, tokenizer).alias("tokens"))
    same = Window.partitionBy("doc_id", F.when(key, F.col("_h"))).orderBy("_h", "source", "lang")
    nth = F.nullif(F.row_number().over(same) - 1, F.lit(0)).cast("string")
    part = F.concat_ws(" ", F.when(key, F.hex("_h")), nth)
    return rows.select("doc_id", part.alias("part"), F.lit(tokenizer).alias("tokenizer"),
                       F.lit(action).alias("action"), "source", "lang", "tokens",
                       F.lit(seq).alias("seq"))
