"""Near-duplicate removal: MinHash bands, first sample in order wins.

The rule to reproduce is sequential: walk the samples in order, drop one that
shares a bucket with a sample kept before it, keep it otherwise. What a sample's
fate depends on is connected with it by shared buckets:

* samples with the same buckets fall with or behind their first one, so only
  the first of each such group takes part;
* a sample alone in all its buckets is kept;
* the others are cut into connected components. Components up to a bound are
  settled whole, each by one ordered pass over sorted rows in a task that holds one
  component's closed buckets at a time;
* larger components are settled in rounds: whoever comes first in *all* its buckets
  is kept and closes them, everyone else in a closed bucket is dropped, the others wait.

A long chain of near-duplicates is therefore one pass, not one round per link. Nothing lists
pairs, and every round ends in a table in shared storage.
"""

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftloom.functions.minhash import Banding, buckets
from siftloom.operators.skew import attach
from siftloom.session import materialize

#: Samples of a component that one task settles; its closed buckets take about 1 kB a sample.
SETTLED_WHOLE = 50_000


def bucket_rows(df: DataFrame, text: str = "output", pos: str = "pos",
                banding: Banding = Banding()) -> DataFrame:
    """(pos, buckets) of every sample, computed row by row."""
    return df.select(F.col(pos).alias("pos"), buckets(F.col(text), banding).alias("buckets"))


def first_of_copies(rows: DataFrame) -> DataFrame:
    """First sample of every group with equal buckets, and the size of the group."""
    return rows.groupBy("buckets").agg(F.min("pos").alias("pos"), F.count("*").alias("copies"))


def _bucket_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("bucket").agg(F.count("*").alias("n"))


def contested(firsts: DataFrame, total: int) -> DataFrame:
    """(pos, buckets) of samples that share a bucket, with only the shared buckets."""
    rows = firsts.select("pos", F.explode(F.array_distinct("buckets")).alias("bucket"))
    shared = attach(rows, _bucket_counts(rows).where("n > 1"), "bucket", total)
    # at most one entry per band
    return shared.groupBy("pos").agg(F.collect_list("bucket").alias("buckets"))


def settle(waiting: DataFrame, total: int) -> DataFrame:
    """One round over (pos, buckets): adds ``kept`` (true, false, or null for undecided)."""
    rows = waiting.select("pos", F.size("buckets").alias("held"),
                          F.explode("buckets").alias("bucket"))
    leads = rows.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("pos").alias("lead"),
        F.min_by("held", "pos").alias("held"))
    # a sample leads at most one bucket per band, so these windows are tiny
    led = F.count("*").over(Window.partitionBy("lead"))
    buckets_now = leads.select("bucket", "n", F.when(led == F.col("held"), F.col("lead"))
                               .alias("winner"))
    seen = attach(rows.select("pos", "bucket"), buckets_now, "bucket", total)
    return seen.groupBy("pos").agg(F.collect_list("bucket").alias("buckets"),
                                   F.bool_or(F.col("winner") == F.col("pos")).alias("kept"))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of a batch of edges with the smallest node the batch connects it to."""
    for batch in batches:
        parent: dict[int, int] = {}

        def top(x):
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            low, high = sorted((top(a), top(b)))
            parent[high] = low
        roots = [(x, top(x)) for x in list(parent)]
        roots = [(x, r) for x, r in roots if x != r]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in roots], pa.int64()), pa.array([r for _, r in roots], pa.int64())],
            names=["_a", "_b"])


def _merge(edges: DataFrame) -> DataFrame:
    merged = edges.select("_a", "_b").mapInArrow(_merged, "_a bigint, _b bigint")
    return materialize(merged.distinct(), "edges")


def _open(edges: DataFrame) -> bool:
    """Whether a node still has two parents, or a parent that has one itself."""
    roles = edges.select(F.col("_a").alias("_n"), F.lit(1).alias("_up"), F.lit(0).alias("_down")).unionByName(
        edges.select(F.col("_b").alias("_n"), F.lit(0).alias("_up"), F.lit(1).alias("_down")))
    roles = roles.groupBy("_n").agg(F.sum("_up").alias("_up"), F.max("_down").alias("_down"))
    return not roles.where("_up > 1 OR _up = 1 AND _down = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(_node, _root): the smallest node connected with each node of ``edges`` (_a, _b) but itself.

    Every batch of edges is contracted where it is, which alone settles what lies close together.
    What is left goes through alternating large and small stars, each a join of the edges with
    one number per node, until every node hangs on its root.
    """
    edges = _merge(edges)
    while _open(edges):
        both = edges.unionByName(edges.select(F.col("_b").alias("_a"), F.col("_a").alias("_b")))
        least = both.groupBy("_a").agg(F.min("_b").alias("_m"))
        large = (both.join(least, "_a").where("_b > _a")
                 .select(F.col("_b").alias("_a"), F.least("_m", "_a").alias("_b")))
        least = large.groupBy("_a").agg(F.min("_b").alias("_m"))
        small = (large.join(least, "_a").where("_b <> _m")
                 .select(F.col("_b").alias("_a"), F.col("_m").alias("_b"))
                 .unionByName(least.select("_a", F.col("_m").alias("_b"))))
        edges = _merge(small)
    return edges.select(F.col("_a").alias("_node"), F.col("_b").alias("_root"))


def with_component(waiting: DataFrame) -> DataFrame:
    """The (pos, buckets) rows with ``component``, equal for samples that buckets connect.

    Samples and buckets are the nodes, by 64-bit hashes: a collision would only join two
    components, which changes no decision.
    """
    node = F.xxhash64("pos")
    edges = waiting.select(node.alias("_a"), F.explode("buckets").alias("_bucket")).select(
        "_a", F.xxhash64("_bucket", F.lit("bucket")).alias("_b"))
    return (waiting.withColumn("_node", node).join(components(edges), "_node", "left")
            .select("pos", "buckets", F.coalesce("_root", "_node").alias("component")))


def _settled_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The dropped samples, from rows in the order of (component, pos)."""
    component, closed = None, set()
    for batch in batches:
        lost = []
        for own, held in zip(batch.column("component").to_pylist(), batch.column("buckets").to_pylist()):
            if own != component:
                component, closed = own, set()
            free = closed.isdisjoint(held)
            if free:
                closed.update(held)
            lost.append(not free)
        yield pa.RecordBatch.from_arrays([batch.column("pos").filter(pa.array(lost))], names=["pos"])


def keep_first(rows: DataFrame, bands: int = Banding().bands,
               settled_whole: int = SETTLED_WHOLE) -> DataFrame:
    """(pos, copies) of the samples the sequential rule keeps, given (pos, buckets).

    ``pos`` is of any type that can be ordered. Counts come from the tables just written: a footer
    or one narrow column.
    """
    firsts = materialize(first_of_copies(rows), "firsts")
    waiting = materialize(contested(firsts, firsts.count() * bands), "contested")
    kept = firsts.select("pos", "copies")
    if not (total := waiting.count()):
        return kept
    labelled = materialize(with_component(waiting), "components")
    # fewer than total / settled_whole components are larger than that
    large = materialize(labelled.groupBy("component").agg(F.count("*").alias("n"))
                        .where(F.col("n") > settled_whole).select("component"), "large")
    small = labelled
    losers = []
    if large.count():
        small = labelled.join(F.broadcast(large), "component", "left_anti")
        waiting = labelled.join(F.broadcast(large), "component", "left_semi").select("pos", "buckets")
        left = total
        while left:
            done = materialize(settle(waiting, left * bands), "round")
            losers.append(done.where("NOT kept").select("pos"))
            waiting = done.where("kept IS NULL").drop("kept")
            left = waiting.count()
    schema = small.select("pos").schema
    losers.append(small.repartition("component").sortWithinPartitions("component", "pos")
                  .mapInArrow(_settled_in_order, schema))
    return kept.join(reduce(DataFrame.unionByName, losers), "pos", "left_anti")


def dropped(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """Positions of the (pos, buckets) rows that are not kept, as a rule far fewer than those kept."""
    return rows.select("pos").join(kept.select("pos"), "pos", "left_anti")


def near_dedup(df: DataFrame, text: str = "output", pos: str = "pos",
               banding: Banding = Banding()) -> DataFrame:
    """The samples that survive near-duplicate removal.

    The payload meets the positions of the dropped samples only; while these fit a broadcast by their
    written size, it stays where it is.
    """
    rows = materialize(bucket_rows(df, text, pos, banding), "buckets")
    gone = materialize(dropped(rows, keep_first(rows, banding.bands)), "dropped")
    return df.join(gone.select(F.col("pos").alias(pos)), pos, "left_anti")


def near_dedup_counts(df: DataFrame, text: str = "output", pos: str = "pos",
                      banding: Banding = Banding()) -> DataFrame:
    """``dedup_counts`` of a removal, from positions alone."""
    rows = materialize(bucket_rows(df, text, pos, banding), "buckets")
    return dedup_counts(rows, keep_first(rows, banding.bands))


def dedup_counts(total: DataFrame, unique: DataFrame) -> DataFrame:
    """One row: processed, unique, removed and the percentage removed."""
    counts = (total.agg(F.count("*").alias("processed"), F.lit(0).cast("bigint").alias("unique"))
              .unionByName(unique.agg(F.lit(0).cast("bigint").alias("processed"),
                                      F.count("*").alias("unique")))
              .agg(F.sum("processed").alias("processed"), F.sum("unique").alias("unique")))
    removed = F.col("processed") - F.col("unique")
    return counts.select("processed", "unique", removed.alias("removed"),
                         duplicate_percentage(F.col("processed"), F.col("unique"))
                         .alias("duplicate_percentage"))


def duplicate_percentage(total, unique):
    return F.round(F.when(total > 0, (total - unique) * 100.0 / total).otherwise(0.0), 6)


def matches(queries: DataFrame, index: DataFrame, total: int) -> DataFrame:
    """``pos`` of the (pos, buckets) rows that share a bucket with ``index(bucket)``.

    The index holds each bucket at most once, because a bucket has one kept sample.
    ``total`` is the number of buckets of all query rows together.
    """
    rows = queries.select("pos", F.explode("buckets").alias("bucket"))
    counts = _bucket_counts(rows)
    # the buckets of a small batch are broadcast to the scan of the index, by their size
    known = (index.join(counts.select("bucket"), "bucket", "left_semi")
             .select("bucket", F.lit(True).alias("known")))
    return (attach(rows, counts.join(known, "bucket", "left"), "bucket", total)
            .where("known").select("pos").distinct())
