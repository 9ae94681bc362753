"""Incremental runs with Structured Streaming.

Everything of a run lives below one folder: the stream's checkpoint, the index of
kept buckets, a version per micro-batch, and the output, a sub-folder per micro-batch.
A batch only reads the version that the batch before it left, of that the folders of its own
buckets' prefixes, and replaces what it wrote itself, so replaying it after a failure
changes nothing.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftloom.functions.minhash import Banding
from siftloom.operators import dedup
from siftloom.operators.index import BucketIndex
from siftloom.session import materialize


def _batch(folder: str, batch_id: int) -> str:
    return f"{folder}/batch_id={batch_id}"


def write_stream(df: DataFrame, out: str, checkpoint: str, fmt: str = "parquet"):
    """Append a stateless stream to files, taking all data now available, then stop."""
    return (df.writeStream.format(fmt).option("path", out)
            .option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())


def unknown(rows: DataFrame, index: BucketIndex, before: int = None,
            bands: int = Banding().bands) -> DataFrame:
    """The (pos, buckets) rows that share no bucket with the index."""
    asked = materialize(rows.select(F.explode("buckets").alias("bucket")).distinct(), "asked")
    stored = index.lookup(asked, before)
    if stored is None:
        return rows
    return rows.join(dedup.matches(rows, stored, rows.count() * bands), "pos", "left_anti")


def dedup_batch(batch: DataFrame, batch_id: int, run_dir: str, text: str = "output",
                pos: str = "pos", banding: Banding = Banding(), **shape) -> None:
    """Keep what neither the index nor an earlier sample of the batch covers; ``shape`` is that of
    the ``BucketIndex``."""
    index = BucketIndex(batch.sparkSession, f"{run_dir}/index", **shape)
    samples = materialize(batch.withColumn("_buckets", dedup.buckets(F.col(text), banding)),
                          "batch")
    rows = samples.select(F.col(pos).alias("pos"), F.col("_buckets").alias("buckets"))
    kept = dedup.keep_first(unknown(rows, index, batch_id, banding.bands), banding.bands)
    kept = materialize(samples.join(kept.select(F.col("pos").alias(pos)), pos, "left_semi"), "kept")
    kept.drop("_buckets").write.mode("overwrite").parquet(_batch(f"{run_dir}/out", batch_id))
    index.add(batch_id, kept.select(F.explode("_buckets").alias("bucket")))


def dedup_stream(stream: DataFrame, run_dir: str, text: str = "output", pos: str = "pos",
                 banding: Banding = Banding(), **shape):
    """Deduplicate a stream against everything it has kept so far."""
    return (stream.writeStream
            .foreachBatch(lambda df, i: dedup_batch(df, i, run_dir, text, pos, banding, **shape))
            .option("checkpointLocation", f"{run_dir}/checkpoint")
            .trigger(availableNow=True).start())


def deduplicated(spark: SparkSession, run_dir: str, schema) -> DataFrame:
    """The samples kept by the batches so far."""
    return spark.read.schema(schema).parquet(f"{run_dir}/out")
