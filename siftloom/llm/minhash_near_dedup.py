"""Operator 10: near-duplicate classes by DartMinHash signatures and banded joining.

Every shingle owns a random sprinkling of darts over the plane weight x rank, one to a unit
of area, made from its hash alone. A document keeps the darts that fall below the weight
it gives the shingle; the earliest dart by rank in each of ``k`` coordinates is its
signature. As a dart of a high rank cannot win, only ranks up to about ``k ln k`` over the
document's total weight are thrown, so a signature costs the number of shingles plus
``k log k`` rather than their product. Two documents agree in a coordinate with the
probability of their weighted Jaccard similarity.

Equal texts collapse first. Documents that agree on all rows of a band meet in a bucket; each
is compared exactly with the bucket's leaders, and only buckets whose members are not yet
one class go on with more leaders. Links are closed into classes by alternating stars.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftloom.llm.rows import (aside, back, expanded, gram_hashes, id_key, mixed, slices, span_hashes,
                               text_key, whole, within, word_bounds, word_hashes)
from siftloom.session import materialize

MASK = (1 << 64) - 1
# cumulative Poisson(1) probabilities as 53-bit thresholds
_TERMS = np.cumsum([np.exp(-1.0) / f for f in np.cumprod([1.0, *range(1, 18)])])


@dataclass(frozen=True)
class Darts:
    """Shape of the signature: at 0.8 a pair misses all 48 bands of 6 rows 5 times in 10^7."""

    coordinates: int = 288
    bands: int = 48
    shingle: int = 5
    similarity: float = 0.8
    block: int = 1000
    #: documents signed at a time; each throws about k ln k + 2 k darts, however short it is
    signed: int = 100


def shingles(data, offsets, width: int):
    """(document, hash) of the distinct shingles of each document.

    A shorter document has one shingle of all its words, one without words has none.
    """
    starts, ends, first = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends)
    document, complete = within(first, len(hashes), width)
    grams = gram_hashes(hashes, width)
    where = np.flatnonzero(complete)
    documents, values = document[where], grams[where]
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < width))
    if len(short):
        documents = np.concatenate([documents, short])
        values = np.concatenate([values, span_hashes(hashes, first[short], first[short + 1])])
    order = np.lexsort((values, documents))
    documents, values = documents[order], values[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (documents[1:] != documents[:-1])
    return documents[new], values[new]


def _uniform(bits: np.ndarray) -> np.ndarray:
    return (bits >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def _thrown(document, element, weight, theta, k):
    """(document, coordinate, rank, dart) of all darts below weight and ``theta[document]``."""
    parts, level = [], 0
    while True:
        low, width = (0.0, 1.0) if level == 0 else (2.0 ** (level - 1), 2.0 ** (level - 1))
        reach = np.flatnonzero(weight > low)
        if not len(reach):
            break
        cells = np.ceil(theta[document[reach]] * width).astype(np.int64)
        row, cell = expanded(cells)
        owner = reach[row]
        seed = mixed(element[owner] + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & MASK)
                     + mixed(cell.astype(np.uint64)))
        darts = np.searchsorted(_TERMS, _uniform(seed), side="right")
        row, nth = expanded(darts)
        cell, owner = cell[row], owner[row]
        dart = mixed(seed[row] + (nth + 1).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        height = low + width * _uniform(mixed(dart + np.uint64(1)))
        rank = (cell + _uniform(mixed(dart + np.uint64(2)))) / width
        keep = (height < weight[owner]) & (rank < theta[document[owner]])
        dart = dart[keep]
        parts.append((document[owner[keep]], (mixed(dart + np.uint64(3)) % np.uint64(k))
                      .astype(np.int64), rank[keep], dart))
        level += 1
    return [np.concatenate(column) for column in zip(*parts)]


def signatures(document, element, weight, n: int, k: int):
    """(n, k) darts; documents without elements have zeros and False in the second result."""
    total = np.bincount(document, weights=weight, minlength=n)
    best = np.zeros((n, k), dtype=np.uint64)
    filled = total > 0
    waiting = np.flatnonzero(filled)
    factor = np.log(k) + 2.0
    while len(waiting):
        theta = np.zeros(n)
        theta[waiting] = factor * k / total[waiting]
        own = theta[document] > 0
        of, coordinate, rank, dart = _thrown(document[own], element[own], weight[own], theta, k)
        slot = of * k + coordinate
        least = np.full(n * k, np.inf)
        np.minimum.at(least, slot, rank)
        won = rank == least[slot]
        flat = best.reshape(-1)
        flat[slot[won]] = dart[won]
        waiting = waiting[np.isinf(least.reshape(n, k)[waiting]).any(axis=1)]
        factor *= 2.0
    return best, filled


def _banded(darts: Darts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, bands = darts.coordinates, darts.bands
        for batch in batches:
            for piece, data, offsets in slices(batch, "_text", rows=darts.signed):
                document, element = shingles(data, offsets, darts.shingle)
                signed, filled = signatures(document, element, np.ones(len(element)),
                                            piece.num_rows, k)
                keys = np.zeros((piece.num_rows, bands), dtype=np.uint64)
                for column in signed.reshape(piece.num_rows, bands, k // bands).transpose(2, 0, 1):
                    keys = mixed(keys * np.uint64(31) + column)
                keys += np.arange(bands, dtype=np.uint64)
                counts = np.where(filled, bands, 0)
                places = np.zeros(piece.num_rows + 1, dtype=np.int32)
                np.cumsum(counts, out=places[1:])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("_d"), piece.column("_copy"), pa.ListArray.from_arrays(
                        pa.array(places), pa.array(keys[filled].reshape(-1).view(np.int64)))],
                    names=["_d", "_copy", "_bands"])
    return run


def _similar(darts: Darts):
    """Exact Jaccard similarity of the shingle sets of two texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for side in ("_text", "_other"):
                sets = []
                for piece, data, offsets in slices(batch, side):
                    document, element = shingles(data, offsets, darts.shingle)
                    edges = np.searchsorted(document, np.arange(piece.num_rows + 1))
                    sets += [element[a:b] for a, b in zip(edges[:-1], edges[1:])]
                out.append(sets)
            found = []
            for a, b in zip(*out):
                both = len(np.intersect1d(a, b, assume_unique=True))
                found.append(both >= darts.similarity * (len(a) + len(b) - both) and both > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_a"), batch.column("_b"), pa.array(found, pa.bool_())],
                names=["_a", "_b", "_linked"])
    return run


def components(edges: DataFrame) -> DataFrame:
    """(_node, _root): the smallest node of the component of each node that has an edge.

    Large and small stars alternate until nothing changes; each half is a join of the
    edges with one number per node, and every round ends in a written table.
    """
    def state(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("_a", "_b").cast("decimal(38,0)"))).first()

    edges = materialize(edges.select(F.greatest("_a", "_b").alias("_a"),
                                     F.least("_a", "_b").alias("_b"))
                        .where("_a <> _b").distinct(), "edges")
    now = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("_b").alias("_a"), F.col("_a").alias("_b")))
        least = both.groupBy("_a").agg(F.min("_b").alias("_m"))
        large = (both.join(least, "_a").where("_b > _a")
                 .select(F.col("_b").alias("_a"), F.least("_m", "_a").alias("_b")).distinct())
        least = large.groupBy("_a").agg(F.min("_b").alias("_m"))
        small = (large.join(least, "_a").where("_b <> _m")
                 .select(F.col("_b").alias("_a"), F.col("_m").alias("_b"))
                 .unionByName(least.select("_a", F.col("_m").alias("_b"))).distinct())
        edges = materialize(small, "edges")
        before, now = now, state(edges)
        if before == now:
            return edges.select(F.col("_a").alias("_node"), F.col("_b").alias("_root"))


def similar_pairs(sets: list[np.ndarray], roots: np.ndarray, similarity: float) -> np.ndarray:
    """(i, j) of all similar sets of different classes, by products of their incidence matrix."""
    sizes = np.array([len(x) for x in sets], dtype=np.float32)
    owner = np.repeat(np.arange(len(sets)), sizes.astype(np.int64))
    values, element, held = np.unique(np.concatenate(sets), return_inverse=True,
                                      return_counts=True)
    shared = np.cumsum(held > 1) - 1
    used = held[element] > 1
    owner, element = owner[used], shared[element[used]]
    order = np.argsort(element, kind="stable")
    owner, element = owner[order], element[order]
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    edges = np.searchsorted(element, np.arange(0, int(element.max(initial=-1)) + 4097, 4096))
    for low, high in zip(edges[:-1], edges[1:]):
        if high > low:
            block = np.zeros((len(sets), 4096), dtype=np.float32)
            block[owner[low:high], element[low:high] % 4096] = 1.0
            both += block @ block.T
    near = (both >= similarity * (sizes[:, None] + sizes[None, :] - both) - 1e-3) & (both > 0)
    near &= roots[:, None] != roots[None, :]
    return np.argwhere(np.triu(near, 1))


def _forest(darts: Darts):
    """Links that join the classes of one block of a bucket; a chain of links is not repeated."""
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("_d").to_numpy()
        roots = table.column("_root").to_numpy()
        sets = table.column("_set").combine_chunks()
        offsets, flat = sets.offsets.to_numpy(), sets.values.to_numpy()
        sets = [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        parent = {r: r for r in roots.tolist()}

        def top(r):
            while parent[r] != r:
                parent[r] = parent[parent[r]]
                r = parent[r]
            return r
        out = []
        for i, j in similar_pairs(sets, roots, darts.similarity).tolist():
            x, y = top(int(roots[i])), top(int(roots[j]))
            if x != y:
                parent[x] = y
                out.append((int(ids[i]), int(ids[j])))
        return pa.table([pa.array([o[0] for o in out], pa.int64()),
                         pa.array([o[1] for o in out], pa.int64())], names=["_a", "_b"])
    return run


def _sets(darts: Darts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, data, offsets in slices(batch, "_text"):
                document, element = shingles(data, offsets, darts.shingle)
                edges = np.searchsorted(document, np.arange(piece.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("_d"), pa.ListArray.from_arrays(
                        pa.array(edges), pa.array(element.view(np.int64)))], names=["_d", "_set"])
    return run


def links(texts: DataFrame, rows: DataFrame, darts: Darts = Darts(),
          once: bool = False) -> DataFrame:
    """(_a, _b) pairs of similar texts, enough to join all that share a bucket and are similar.

    ``texts`` has (_d, _text), ``rows`` (_d, _bands). First everyone is compared with the smallest
    member of the bucket. Buckets whose members are one class by then need no more, whatever
    their size. In the others, members of different classes are compared all with all,
    as sets of shingles in blocks of about ``block`` members, and only links that join
    classes come out. Pairs of documents are never rows. With ``once``, rows of ``texts``
    that repeat a document are one.
    """
    members = rows.select("_d", F.explode("_bands").alias("_bucket"))
    leads = members.groupBy("_bucket").agg(F.count("*").alias("_n"), F.min("_d").alias("_b"))
    members = materialize(members.join(leads.where("_n > 1"), "_bucket"), "members")
    texts = texts.join(members.select("_d").distinct(), "_d", "left_semi")
    texts = materialize(texts.dropDuplicates(["_d"]) if once else texts, "texts")
    left = texts.select(F.col("_d").alias("_a"), "_text")
    right = texts.select(F.col("_d").alias("_b"), F.col("_text").alias("_other"))
    pairs = members.where("_d <> _b").select(F.col("_d").alias("_a"), "_b").distinct()
    judged = pairs.join(left, "_a").join(right, "_b").select("_a", "_b", "_text", "_other")
    first = materialize(judged.mapInArrow(
        _similar(darts), "_a bigint, _b bigint, _linked boolean").where("_linked")
        .select("_a", "_b"), "linked")

    roots = components(first)
    labelled = members.join(roots, F.col("_d") == F.col("_node"), "left").select(
        "_d", "_bucket", "_n", F.coalesce("_root", "_d").alias("_root"))
    split = labelled.groupBy("_bucket").agg(
        F.min("_root").alias("_low"), F.max("_root").alias("_high")).where("_low <> _high")
    waiting = materialize(labelled.join(split.select("_bucket"), "_bucket"), "open")
    sets = materialize(texts.join(waiting.select("_d").distinct(), "_d", "left_semi").mapInArrow(
        _sets(darts), "_d bigint, _set array<bigint>"), "sets")
    blocks = F.floor(F.col("_n") / darts.block) + 1
    own = F.pmod(F.xxhash64("_d"), blocks)
    dealt = (waiting.withColumn("_own", own)
             .withColumn("_with", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
             .select("_bucket", F.least("_own", "_with").alias("_i"),
                     F.greatest("_own", "_with").alias("_j"), "_d", "_root"))
    more = dealt.join(sets, "_d").groupBy("_bucket", "_i", "_j").applyInArrow(
        _forest(darts), "_a bigint, _b bigint")
    return first.unionByName(materialize(more, "more")).distinct()


def _roots(given: DataFrame, darts: Darts, once: bool = False) -> DataFrame:
    """(_node, _root) of the documents (_d, _text) that are linked."""
    keyed = given.select("_d", F.md5(F.col("_text")).alias("_copy"), "_text")
    signed = keyed.mapInArrow(_banded(darts), "_d bigint, _copy string, _bands array<bigint>")
    signed = materialize(signed.dropDuplicates(["_d"]) if once else signed, "signed")
    # no distinct behind the join: a hot group of copies can then be split
    copies = signed.select("_d", "_copy")
    firsts = copies.groupBy("_copy").agg(F.min("_d").alias("_first"))
    members = materialize(copies.join(firsts, "_copy")
                          .select("_d", F.col("_first").alias("_b")), "copies")
    rows = signed.join(members.where("_d = _b").select("_d"), "_d", "left_semi")
    linked = links(given.select("_d", "_text"), rows, darts, once)
    edges = members.select(F.col("_d").alias("_a"), "_b").unionByName(linked)
    return components(edges)


def _classes(docs: DataFrame, doc_id: str, text: str, darts: Darts) -> DataFrame:
    """(_d, _i, _h, _least) of each document, an id and a text: the smallest pair of its class."""
    given = docs.select(id_key(doc_id).alias("_i"), text_key(text).alias("_h"),
                        whole(text).alias("_text")).select(
        "_i", "_h", F.xxhash64("_i", "_text").alias("_d"), "_text")
    roots = _roots(given.select("_d", "_text"), darts, once=True)
    known = given.select("_d", "_i", "_h").distinct()
    known = known.join(roots, F.col("_d") == F.col("_node"), "left").select(
        "_d", "_i", "_h", F.coalesce("_root", "_d").alias("_class"))
    least = known.groupBy("_class").agg(F.min(F.struct("_i", "_h")).alias("_least"))
    return known.join(least, "_class").drop("_class")


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 darts: Darts = Darts()) -> DataFrame:
    """(doc_id, class_id, kept) of every row; the smallest id names the class.

    A document is an id and a text: rows without an id, or with the same id, are documents of their
    own if their texts differ. Documents are linked if their sets of five-word shingles have a
    Jaccard similarity of 0.8 or more, or their texts are equal. Null texts count as empty;
    texts without words are linked with equal texts only. A null id is the smallest. ``kept``
    is true for the document that stays of its class, the smallest id and of one id the smallest
    text hash; repeated rows are all kept or not. Very long texts are signed whole; an empty
    table gives no rows. A document is numbered by a 64-bit hash of both, so among n documents
    two are taken for one with a probability of about n * n / 2^65.
    """
    classes = _classes(docs, doc_id, text, darts).select(
        "_d", F.col("_least._i").alias("_of"), (F.col("_least") == F.struct("_i", "_h")).alias("kept"))
    ids = docs.select(F.col(doc_id).alias("doc_id"),
                      F.xxhash64(id_key(doc_id), whole(text)).alias("_d"))
    return ids.join(classes, "_d").select(
        "doc_id", F.nullif("_of", F.lit(-(1 << 63))).alias("class_id"), "kept")


def near_dedup_apart(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     darts: Darts = Darts()) -> DataFrame:
    """One row of each class, as ``near_classes`` keeps it, with all columns."""
    names = docs.columns
    pair = (id_key(doc_id).alias("_i"), text_key(text).alias("_h"))
    kept = _classes(docs, doc_id, text, darts).where(
        F.col("_least") == F.struct("_i", "_h")).select("_i", "_h")
    return (docs.select(*aside(docs, names), *pair).join(kept, ["_i", "_h"], "left_semi")
            .dropDuplicates(["_i", "_h"]).select(*back(names)))
