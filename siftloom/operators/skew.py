"""Joining a value to rows by a key of which a few may hold a large part of all rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# a key with more than total/HOT_SHARE rows is hot; there are fewer than HOT_SHARE of them
HOT_SHARE = 1000


def attach(rows: DataFrame, keys: DataFrame, key: str, total: int,
           hot_share: int = HOT_SHARE) -> DataFrame:
    """Inner join of ``rows`` with ``keys``, which lists a key at most once.

    ``keys`` carries the number ``n`` of rows with each key, and ``total`` is the
    number of all rows. The counts add up to at most ``total``, so fewer than
    ``hot_share`` keys can exceed ``total / hot_share``: these are broadcast, however
    large the data. The remaining keys are light enough to shuffle.
    """
    limit = max(1, total // hot_share)
    hot = F.broadcast(keys.where(F.col("n") > limit).drop("n"))
    light = keys.where(F.col("n") <= limit).drop("n")
    others = rows.join(hot.select(key), key, "left_anti")
    return rows.join(hot, key).unionByName(others.join(light, key))
