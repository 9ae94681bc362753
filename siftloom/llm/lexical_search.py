"""Operator 12: ranked lexical search over impact vectors in buckets by length.

A document is the vector of its impacts on the terms of the queries, a query the vector of its
term weights, and a score their inner product. Vectors are taken in order of their length
(norm), longest first, in buckets of similar lengths. With ten documents found, a query's tenth
score is its threshold, and by Cauchy and Schwarz a bucket can be left out when the query's
length times the bucket's longest vector stays below it. Inside a bucket the query's heaviest
coordinates bound each document: their part of the product, plus the length of the rest of the
query times the length of the rest of the document. What survives is rescored in integers.

The longest vectors of the whole table are searched first, so that every task starts with
thresholds that hold for the corpus, and raises them as it finds more.

Queries are taken in blocks of bounded bytes, each against all documents. A task keeps
``top`` documents per query, whatever it reads.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftloom.llm.rows import id_key, lowered, slices, text_key, whole, word_bounds, word_hashes
from siftloom.session import materialize

# fixed values of the score
SCALE, SATURATION, LENGTH_PERCENT = 1_000_000_000, 8, 75
BETWEEN = np.ones(256, dtype=bool)
BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
VECTORS = "_d bigint, _h bigint, _n bigint, _terms array<int>, _tf array<int>"
FOUND = "_item int, _d bigint, _h bigint, _score bigint"


@dataclass(frozen=True)
class Lexical:
    """``top`` documents per query; ``block_bytes`` of query texts at a time; the first round takes
    the longest ``head`` vectors; ``focus`` coordinates bound a document."""

    top: int = 10
    block_bytes: int = 1 << 18
    head: int = 5000
    focus: int = 8
    cells: int = 1 << 22


def terms_of(data: np.ndarray, offsets: np.ndarray):
    """(hash of each term, each text's first term); only A-Z are lowered."""
    data = lowered(data)
    starts, ends, first = word_bounds(data, offsets, BETWEEN)
    return word_hashes(data, starts, ends), first


def _hashes(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").encode(), dtype=np.uint8)
    return terms_of(data, np.array([0, len(data)]))[0]


def _vectors(vocabulary: np.ndarray):
    """Number of terms, and the terms of the vocabulary with their counts, of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, data, offsets in slices(batch, "_text"):
                hashes, first = terms_of(data, offsets)
                counts = np.diff(first)
                document = np.repeat(np.arange(len(counts)), counts)
                at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                hit = np.flatnonzero(vocabulary[at] == hashes)
                cell, tf = np.unique(document[hit] * len(vocabulary) + at[hit], return_counts=True)
                edges = np.searchsorted(cell, np.arange(piece.num_rows + 1) * len(vocabulary))
                edges = pa.array(edges.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("_d"), piece.column("_h"), pa.array(counts.astype(np.int64)),
                     pa.ListArray.from_arrays(edges, pa.array((cell % len(vocabulary)).astype(np.int32))),
                     pa.ListArray.from_arrays(edges, pa.array(tf.astype(np.int32)))],
                    names=["_d", "_h", "_n", "_terms", "_tf"])
    return run


def _lists(batch: pa.RecordBatch):
    """(row, term, count) of all entries, and each row's first."""
    terms, counts = batch.column("_terms"), batch.column("_tf")
    edges = np.concatenate([[0], np.cumsum(terms.value_lengths().to_numpy(zero_copy_only=False))])
    row = np.repeat(np.arange(batch.num_rows), np.diff(edges).astype(np.int64))
    return (row, terms.flatten().to_numpy(zero_copy_only=False),
            counts.flatten().to_numpy(zero_copy_only=False).astype(np.int64), edges.astype(np.int64))


def _counted(n_terms: int):
    """Per task: documents that hold each term; -1: documents with terms, -2: all terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, terms = np.zeros(n_terms, dtype=np.int64), 0, 0
        for batch in batches:
            held += np.bincount(_lists(batch)[1], minlength=n_terms)
            sizes = batch.column("_n").to_numpy()
            docs, terms = docs + int((sizes > 0).sum()), terms + int(sizes.sum())
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-1, -2], used]).astype(np.int32)),
             pa.array(np.concatenate([[docs, terms], held[used]]).astype(np.int64))],
            names=["_term", "_count"])
    return run


@dataclass(frozen=True)
class Statistics:
    """Documents with terms, all terms, and documents that hold each term of the vocabulary."""

    docs: int
    terms: int
    held: np.ndarray

    def weights(self) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * self.docs + 2) / (2 * int(n) + 1)))
                         for n in self.held], dtype=np.int64)

    def impacts(self, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        m = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * sizes * self.docs) // max(1, self.terms)
        return (SCALE * counts) // (1000 * counts + SATURATION * m)


def _impacts(batch: pa.RecordBatch, corpus: Statistics):
    """(row, term, impact, first entry of each row, norm of each row)."""
    row, term, counts, edges = _lists(batch)
    impact = corpus.impacts(counts, batch.column("_n").to_numpy()[row])
    norm = np.sqrt(np.bincount(row, weights=impact.astype(np.float64) ** 2,
                               minlength=batch.num_rows))
    return row, term, impact, edges, norm


def length_bucket(norm: np.ndarray) -> np.ndarray:
    """Eight buckets to a doubling of the length."""
    return np.floor(8 * np.log2(np.maximum(norm, 1.0))).astype(np.int32)


def _bucket_sizes(corpus: Statistics):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.zeros(1, dtype=np.int64)
        for batch in batches:
            own = np.bincount(length_bucket(_impacts(batch, corpus)[4]))
            if len(own) > len(sizes):
                own, sizes = sizes, own.astype(np.int64)
            sizes[:len(own)] += own
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(sizes), dtype=np.int32)), pa.array(sizes)],
            names=["_bucket", "_rows"])
    return run


@dataclass
class Query:
    """A query's terms with weights, heaviest first, and the length of what follows each."""

    terms: np.ndarray
    weights: np.ndarray

    def __post_init__(self):
        order = np.argsort(-self.weights, kind="stable")
        self.terms, self.weights = self.terms[order], self.weights[order]
        squares = self.weights.astype(np.float64) ** 2
        self.norm = math.sqrt(squares.sum()) * (1 + 1e-9)
        self.rest = np.sqrt(np.maximum(0, squares.sum() - np.cumsum(squares))) * (1 + 1e-9)


class Best:
    """The best ``top`` (score, id, text hash) seen: higher scores first, then smaller ids."""

    def __init__(self, top: int, threshold: int):
        self.top, self.threshold, self.rows = top, threshold, []

    def add(self, scores: np.ndarray, ids: np.ndarray, texts: np.ndarray) -> None:
        good = np.flatnonzero((scores > 0) & (scores >= self.threshold))
        if not len(good):
            return
        self.rows += zip((-scores[good]).tolist(), ids[good].tolist(), texts[good].tolist())
        self.rows = sorted(self.rows)[:self.top]
        if len(self.rows) == self.top:
            self.threshold = max(self.threshold, -self.rows[-1][0])


def _bucket_searched(dense, norms, ids, texts, queries, best, focus) -> int:
    """Search one bucket (documents by terms) for all queries; the number of rescored pairs."""
    longest, rescored = norms.max() * (1 + 1e-9), 0
    for query, own in zip(queries, best):
        if not len(query.terms) or query.norm * longest < own.threshold:
            continue
        if own.threshold:
            part = dense[:, query.terms[:focus]].astype(np.float64)
            rest = np.sqrt(np.maximum(0, norms ** 2 * (1 + 1e-9) - (part ** 2).sum(axis=1)))
            bound = part @ query.weights[:focus] + query.rest[len(part[0]) - 1] * rest
            alive = np.flatnonzero(bound * (1 + 1e-9) >= own.threshold)
        else:
            alive = np.arange(len(dense))
        if len(alive):
            rescored += len(alive)
            scores = dense[np.ix_(alive, query.terms)] @ query.weights
            own.add(scores, ids[alive], texts[alive])
    return rescored


def _searched(queries: list[Query], thresholds: list[int], corpus: Statistics, n_terms: int,
              lexical: Lexical, low: int, high: int):
    """The best documents of a task, of those whose length bucket lies in [low, high)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(lexical.top, t) for t in thresholds]
        step = max(1, lexical.cells // n_terms)
        for batch in batches:
            row, term, impact, edges, norm = _impacts(batch, corpus)
            ids, texts = batch.column("_d").to_numpy(), batch.column("_h").to_numpy()
            bucket = length_bucket(norm)
            order = np.flatnonzero((bucket >= low) & (bucket < high) & (norm > 0))
            order = order[np.argsort(-norm[order], kind="stable")]
            # a bucket ends where the lengths change, or where the matrix is full
            own = bucket[order]
            changes = np.flatnonzero(np.diff(own, prepend=own[:1] + 1))
            for first, last in zip(changes, [*changes[1:], len(order)]):
                for begin in range(first, last, step):
                    rows = order[begin:min(begin + step, last)]
                    dense = np.zeros((len(rows), n_terms), dtype=np.int64)
                    for i, r in enumerate(rows):
                        dense[i, term[edges[r]:edges[r + 1]]] = impact[edges[r]:edges[r + 1]]
                    _bucket_searched(dense, norm[rows], ids[rows], texts[rows], queries, best,
                                     lexical.focus)
        out = [(i, d, h, -s) for i, b in enumerate(best) for s, d, h in b.rows]
        columns = list(zip(*out)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, (pa.int32(), pa.int64(), pa.int64(),
                                                            pa.int64()))],
            names=["_item", "_d", "_h", "_score"])
    return run


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("_item").orderBy(F.desc("_score"), "_d", "_h")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search_block(spark: SparkSession, docs: DataFrame, texts: list, lexical: Lexical) -> DataFrame:
    """(_item, _d, _h, _score, rank) for the queries ``texts``, known by their place."""
    hashes = [_hashes(t) for t in texts]
    vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, dtype=np.uint64)
    n_terms = len(vocabulary)
    if not n_terms:
        return spark.createDataFrame([], FOUND + ", rank int")
    vectors = materialize(docs.mapInArrow(_vectors(vocabulary), VECTORS), "vectors")
    counts = {r[0]: r[1] for r in vectors.mapInArrow(_counted(n_terms), "_term int, _count bigint")
              .groupBy("_term").agg(F.sum("_count")).collect()}
    corpus = Statistics(counts.get(-1, 0), counts.get(-2, 0),
                        np.array([counts.get(i, 0) for i in range(n_terms)], dtype=np.int64))
    weights = corpus.weights()
    queries = []
    for own in hashes:
        terms, times = np.unique(np.searchsorted(vocabulary, own), return_counts=True)
        queries.append(Query(terms, weights[terms] * times))
    sizes = sorted(vectors.mapInArrow(_bucket_sizes(corpus), "_bucket int, _rows bigint")
                   .groupBy("_bucket").agg(F.sum("_rows")).collect(), reverse=True)
    held, cut = 0, 0
    for bucket, rows in sizes:
        held, cut = held + rows, bucket
        if held >= lexical.head:
            break

    def part(thresholds, low, high):
        return vectors.mapInArrow(
            _searched(queries, thresholds, corpus, n_terms, lexical, low, high), FOUND)
    head = materialize(_ranked(part([0] * len(texts), cut, 1 << 20), lexical.top).drop("rank"), "head")
    thresholds = [0] * len(texts)
    full = head.groupBy("_item").agg(F.count("*").alias("n"), F.min("_score").alias("s"))
    for r in full.where(F.col("n") == lexical.top).collect():
        thresholds[r["_item"]] = r["s"]
    return _ranked(head.unionByName(part(thresholds, 0, cut)), lexical.top)


def lexical_search(docs: DataFrame, items: DataFrame, lexical: Lexical = Lexical(),
                   doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                   item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``top`` best documents of each item, score above 0.

    Every row of either table counts on its own, repeated ones too. A null text has no terms; items
    without terms and items that nothing matches have no rows. Equal scores go by document
    id, a null id first, then by a hash of the text. Texts are read whole, however long.
    An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    given = docs.select(id_key(doc_id).alias("_d"), F.col(doc_id).alias("_id"),
                        text_key(text).alias("_h"), whole(text).alias("_text"))
    asked = items.select(F.col(item_id).alias("item_id"), whole(item_text).alias("_query"))
    size = asked.agg(F.sum(F.octet_length("_query"))).first()[0] or 0
    blocks = int(size // lexical.block_bytes) + 1
    dealt = asked.withColumn("_block", F.pmod(F.xxhash64("item_id", "_query"), F.lit(blocks)))
    kind = items.schema[item_id].dataType.simpleString()
    out = []
    for block in range(blocks):
        rows = dealt.where(F.col("_block") == block).orderBy("item_id", "_query").collect()
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)],
                                      f"_item int, item_id {kind}")
        found = search_block(spark, given, [r["_query"] for r in rows], lexical)
        out.append(found.join(F.broadcast(names), "_item"))
    found = reduce(DataFrame.unionByName, out)
    return found.select("item_id", "rank", F.nullif("_d", F.lit(-(1 << 63))).cast(
        docs.schema[doc_id].dataType).alias("doc_id"), F.col("_score").alias("score"))
