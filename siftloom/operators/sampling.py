"""Reproducible split, shuffle and head of a corpus."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftloom.constants import SEED, VALIDATION_FRACTION

_RANGE_DIGITS = 4


def _seeded_md5(seed: int, *columns: Column) -> Column:
    return F.md5(F.concat_ws("\x1f", F.lit(str(seed)), *[c.cast("string") for c in columns]))


def split_name(dataset: Column, id: Column, fraction: float = VALIDATION_FRACTION,
               seed: int = SEED) -> Column:
    """'validation' for a fixed pseudo-random fraction of the ids, else 'train'.

    Depends on the identity of a sample only, so repartitioning, retries and
    later runs never move a sample to the other side.
    """
    draw = F.conv(F.substring(_seeded_md5(seed, dataset, id), 1, 8), 16, 10).cast("bigint")
    return (F.when(draw < int(fraction * (1 << 32)), F.lit("validation"))
            .otherwise(F.lit("train")))


def with_split(df: DataFrame, **options) -> DataFrame:
    return df.withColumn("split", split_name(F.col("dataset"), F.col("id"), **options))


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n"))


def shuffle_key(*unique: Column, seed: int = SEED) -> Column:
    return _seeded_md5(seed, *unique)


def shuffled(df: DataFrame, *unique: str, seed: int = SEED) -> DataFrame:
    """Globally sorted by a seeded hash of the unique columns: a range-partitioned sort."""
    return df.orderBy(shuffle_key(*[F.col(c) for c in unique], seed=seed), *unique)


def shuffle_rank(df: DataFrame, *unique: str, seed: int = SEED) -> DataFrame:
    """Add each row's place (from 1) in the shuffled order, without one global window.

    The leading digits of the hash cut the order into even ranges; rows are numbered
    inside their range and moved by the sizes of the ranges before it.
    """
    key = shuffle_key(*[F.col(c) for c in unique], seed=seed)
    keyed = df.withColumn("_key", key).withColumn("_range", F.substring("_key", 1, _RANGE_DIGITS))
    sizes = keyed.groupBy("_range").agg(F.count("*").alias("_n"))
    # at most 16^4 ranges, whatever the size of the data
    offsets = F.broadcast(sizes.selectExpr(
        "_range", "sum(_n) OVER (ORDER BY _range) - _n AS _before"))
    order = ", ".join(["_key", *unique])
    return (keyed.selectExpr("*", f"row_number() OVER (PARTITION BY _range ORDER BY {order}) AS _i")
            .join(offsets, "_range")
            .withColumn("shuffle_rank", F.col("_before") + F.col("_i"))
            .drop("_key", "_range", "_i", "_before"))


def head(df: DataFrame, n: int = 5, order: str = "pos") -> DataFrame:
    return df.orderBy(order).limit(n)
