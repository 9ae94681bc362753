import random

import pytest
from pyspark.sql import functions as F

from siftloom.functions import minhash as M
from siftloom.operators import dedup
from siftloom.operators.skew import attach


def sequential(rows):
    """Walk in order, keep what shares no bucket with a kept row."""
    taken, kept = set(), []
    for pos, buckets in sorted(rows):
        if not taken.intersection(buckets):
            taken.update(buckets)
            kept.append(pos)
    return kept


def random_rows(n, values, seed, bands=5, hot=0.0):
    rng = random.Random(seed)
    return [(pos, [f"{band}:0" if rng.random() < hot else f"{band}:{rng.randrange(values)}"
                   for band in range(bands)]) for pos in rng.sample(range(10 * n), n)]


def kept(spark, rows, **options):
    df = spark.createDataFrame(rows, "pos bigint, buckets array<string>")
    return sorted(r.pos for r in dedup.keep_first(df, **options).collect())


@pytest.mark.parametrize("n,values,hot", [(400, 100, 0), (400, 1000, 0), (300, 400, 0.1),
                                          (300, 5000, 0.4)])
def test_equals_the_sequential_rule(spark, n, values, hot):
    rows = random_rows(n, values, n + values, hot=hot)
    assert kept(spark, rows) == sequential(rows)


def test_hot_buckets_take_the_broadcast_path(spark):
    rows = random_rows(300, 3000, 5, hot=0.2)
    assert kept(spark, rows) == sequential(rows)


def test_chain_keeps_both_ends(spark):
    rows = [(1, ["a", "x"]), (2, ["a", "b"]), (3, ["c", "b"])]
    assert kept(spark, rows) == [1, 3]
    long_chain = [(i, [f"l{i}", f"l{i + 1}"]) for i in range(12)]
    assert kept(spark, long_chain) == sequential(long_chain) == list(range(0, 12, 2))


def test_components_are_the_smallest_connected_nodes(spark):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(300)] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400))
                                                for _ in range(260)] + [(2000, 2000)]
    rng.shuffle(edges)
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        low, high = sorted((top(a), top(b)))
        parent[high] = low
    want = {(x, top(x)) for x in list(parent) if x != top(x)}
    df = spark.createDataFrame(edges, "_a bigint, _b bigint")
    for parts in (1, 40):
        got = dedup.components(df.repartition(parts)).collect()
        assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("bound", [0, 20, 1000])
def test_large_components_take_the_rounds(spark, bound):
    rows = random_rows(300, 300, 21) + [(9000 + i, [f"l{i}", f"l{i + 1}"]) for i in range(40)]
    assert kept(spark, rows, settled_whole=bound) == sequential(rows)


def test_a_chain_takes_few_jobs(spark):
    rows = [(i, [f"l{i}", f"l{i + 1}"]) for i in range(120)]
    df = spark.createDataFrame(rows, "pos bigint, buckets array<string>")
    context = spark.sparkContext
    context.setJobGroup("chain", "chain")
    got = sorted(r.pos for r in dedup.keep_first(df).collect())
    jobs = len(context.statusTracker().getJobIdsForGroup("chain"))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert got == sequential(rows)
    assert jobs < 40, jobs


def test_copies_and_empty_input(spark):
    rows = [(i, ["same"] * 5) for i in (7, 3, 9)] + [(5, list("vwxyz"))]
    assert kept(spark, rows) == [3, 5]
    assert kept(spark, [(1, ["a"])]) == [1]
    empty = spark.createDataFrame([], "pos bigint, buckets array<string>")
    assert dedup.keep_first(empty).count() == 0


def test_copies_are_counted(spark):
    df = spark.createDataFrame([(i, ["s"]) for i in range(4)] + [(9, ["t"])],
                               "pos bigint, buckets array<string>")
    assert sorted((r.pos, r.copies) for r in dedup.keep_first(df).collect()) == [(0, 4), (9, 1)]


def test_same_result_under_any_partitioning(spark):
    rows = random_rows(200, 150, 11)
    df = spark.createDataFrame(rows, "pos bigint, buckets array<string>")
    results = set()
    for parts in (1, 3, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        found = dedup.keep_first(df.repartition(parts, "pos"))
        results.add(tuple(sorted(r.pos for r in found.collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results == {tuple(sequential(rows))}


def test_struct_positions_order_too(spark):
    df = (spark.createDataFrame([(2, ["a"]), (1, ["a"])], "n bigint, buckets array<string>")
          .select(F.struct(F.lit("file").alias("f"), "n").alias("pos"), "buckets"))
    assert [r.pos.n for r in dedup.keep_first(df).collect()] == [1]


def test_signature_is_the_minimum_over_words(spark, column):
    texts = ["a b a c", "", "b c a", "é ü", "w" * 5 + " " + " ".join(map(str, range(40000)))]
    hashes = column(M.word_hashes, texts)
    signatures = column(M.signature, texts)
    expected = [[min([(a * h + b) % M.PRIME for h in row], default=M.PRIME)
                 for a, b in M.permutations()] for row in hashes[:4]]
    assert signatures[:4] == expected and signatures[0] == signatures[2]
    assert signatures[4][:3] == [min((a * h + b) % M.PRIME for h in hashes[4])
                                 for a, b in M.permutations()[:3]]


def test_band_shape():
    assert M.band_shape(0.9, 128) == (5, 25)
    assert M.Banding.for_threshold(0.9) == M.Banding()


def test_similar_texts_fall_together(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(2000)]
    texts = [" ".join(base), " ".join(base[:-1] + ["other"]), " ".join(reversed(base)),
             " ".join(f"v{i}" for i in range(500))]
    df = spark.createDataFrame(list(enumerate(texts)), "pos bigint, output string")
    found = dedup.near_dedup(df)
    assert sorted(r.pos for r in found.collect()) == [0, 3]
    counts = dedup.dedup_counts(df, found).first().asDict()
    assert counts == {"processed": 4, "unique": 2, "removed": 2, "duplicate_percentage": 50.0}


def test_attach_splits_hot_keys(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 2 else f"k{i % 50}") for i in range(1000)],
                                 "i int, k string")
    keys = (rows.groupBy("k").agg(F.count("*").alias("n"))
            .withColumn("v", F.when(F.col("k") != "k4", F.concat(F.lit("v"), "k"))))
    plain = attach(rows, keys, "k", 1000)
    split = attach(rows, keys, "k", 1000, hot_share=10)
    assert sorted(plain.collect(), key=str) == sorted(split.collect(), key=str)
    assert plain.count() == 1000
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_matches_against_an_index(spark):
    queries = spark.createDataFrame([(1, ["a", "b"]), (2, ["c", "d"]), (3, ["a", "z"])],
                                    "pos bigint, buckets array<string>")
    index = spark.createDataFrame([("a",), ("q",)], "bucket string")
    found = dedup.matches(queries, index, 6)
    assert sorted(r.pos for r in found.collect()) == [1, 3]
