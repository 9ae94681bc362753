"""The stored index of kept buckets: folders by bucket prefix, listed by versioned manifests.

``data/part=<name>/prefix=<hex digits>`` holds buckets, ``manifest/version=<n>`` the names of
the parts that count as of version n. Nothing that a manifest names is ever changed, so a reader
of version n and a writer of version n + 1 do not meet, and writing a version again replaces
only what that version wrote. When ``live`` parts have come together, a version merges them
into one part of its own; the parts it replaces stay for readers of earlier versions.

A lookup reads the folders of the prefixes it asks for, 256 at most by default, and no others.
"""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = "bucket binary, part string, prefix string"


def prefix_of(bucket: Column, digits: int = 2) -> Column:
    return F.lower(F.substring(F.hex(bucket), 1, digits))


def numbers_below(spark: SparkSession, folder: str, name: str, complete: bool = True) -> list[int]:
    """The n of the folders ``name``=n below ``folder``, ascending; with ``complete`` only of
    those whose write has ended."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    found = []
    for status in files.listStatus(path):
        match = re.fullmatch(rf"{name}=(\d+)", status.getPath().getName())
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if match and (not complete or files.exists(done)):
            found.append(int(match[1]))
    return sorted(found)


class BucketIndex:
    """Buckets below one folder; see the module.

    ``live`` is the number of parts a lookup may meet, ``digits`` the length of a prefix, which
    must stay as it is for the life of the folder.
    """

    def __init__(self, spark: SparkSession, folder: str, live: int = 8, digits: int = 2):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.live, self.digits = live, digits

    def _prefix(self) -> Column:
        return prefix_of(F.col("bucket"), self.digits)

    def parts(self, before: int = None) -> list[str]:
        """Names of the parts as of the last version, or of the last one below ``before``."""
        versions = [v for v in numbers_below(self.spark, f"{self.folder}/manifest", "version")
                    if before is None or v < before]
        if not versions:
            return []
        rows = self.spark.read.schema("name string").json(
            f"{self.folder}/manifest/version={versions[-1]}").collect()
        return sorted(r["name"] for r in rows)

    def _read(self, parts: list[str]) -> DataFrame:
        paths = [f"{self.folder}/data/part={p}" for p in parts]
        return (self.spark.read.schema(ROWS).option("basePath", f"{self.folder}/data").parquet(*paths))

    def lookup(self, queries: DataFrame, before: int = None) -> DataFrame:
        """Buckets of the index that can be among ``queries`` (bucket): those with their prefixes.

        None if there is no earlier version.
        """
        parts = self.parts(before)
        if not parts:
            return None
        wanted = [r[0] for r in queries.select(self._prefix()).distinct().collect()]
        return self._read(parts).where(F.col("prefix").isin(wanted)).select("bucket")

    def add(self, version: int, buckets: DataFrame) -> None:
        """Make ``version`` of the latest earlier one and ``buckets`` (bucket)."""
        parts, name = self.parts(version), str(version)
        rows = buckets.select("bucket", self._prefix().alias("prefix"))
        if len(parts) + 1 > self.live:
            rows = rows.unionByName(self._read(parts).select("bucket", "prefix"))
            parts = []
        # a prefix is an even share of all buckets, as they are digests
        (rows.repartition("prefix").write.mode("overwrite").partitionBy("prefix")
         .parquet(f"{self.folder}/data/part={name}"))
        names = self.spark.createDataFrame([(p,) for p in [*parts, name]], "name string")
        names.coalesce(1).write.mode("overwrite").json(f"{self.folder}/manifest/version={version}")
