"""Writing the corpus: formats, codecs, split outputs, and what was written."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftloom.operators.unify import export_form

Writer = Callable[..., None]
WRITERS: dict[str, Writer] = {}
# writers that can lay out folders by a column in one pass
FOLDERS: set[str] = set()


def register_writer(*names: str, folders: bool = False):
    """Decorator: make ``write(df, path, mode, compression)`` the writer for these formats.

    With ``folders`` it also takes ``partition_by``, a column with a folder for each value.
    """
    def add(writer: Writer) -> Writer:
        WRITERS.update(dict.fromkeys(names, writer))
        if folders:
            FOLDERS.update(names)
        return writer
    return add


def _laid_out(df: DataFrame, mode: str, partition_by):
    writer = df.write.mode(mode)
    return writer.partitionBy(partition_by) if partition_by else writer


@register_writer("jsonl", "json", folders=True)
def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite",
                compression: str = None, partition_by: str = None) -> None:
    """One JSON object per line, non-ASCII text as is, null fields kept."""
    (_laid_out(df, mode, partition_by).option("compression", compression or "none")
     .option("ignoreNullFields", "false").json(path))


@register_writer("parquet", folders=True)
def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  compression: str = None, partition_by: str = None) -> None:
    _laid_out(df, mode, partition_by).option("compression", compression or "snappy").parquet(path)


def write_corpus(df: DataFrame, fmt: str, path: str, mode: str = "overwrite",
                 compression: str = None, **options) -> None:
    """Write in a format by name; an unknown name is an error."""
    writer = WRITERS.get(fmt.lower())
    if writer is None:
        raise ValueError(f"unknown export format {fmt!r}, expected one of {sorted(WRITERS)}")
    writer(df, path, mode=mode, compression=compression, **options)


def write_split(df: DataFrame, out: str, form: str = "instruction", fmt: str = "jsonl",
                mode: str = "overwrite", compression: str = None, even: bool = False) -> None:
    """Write ``out/split=train`` and ``out/split=validation`` from a frame with ``split``.

    One pass over the frame: every task writes its rows where they are, a file per split. With
    ``even`` the rows are dealt out by split first, in partitions of the advised size however
    uneven the splits are; that moves the whole payload and pays off for frames in many
    small partitions. A writer without folders is called for each split.
    """
    if fmt.lower() not in FOLDERS:
        for split in ("train", "validation"):
            part = df.where(F.col("split") == split)
            write_corpus(export_form(part, form), fmt, f"{out}/split={split}", mode, compression)
        return
    rows = df.hint("rebalance", "split") if even else df
    write_corpus(export_form(rows, form, "split"), fmt, out, mode, compression, partition_by="split")


def read_back(spark: SparkSession, fmt: str, path: str, schema) -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.parquet(path) if fmt == "parquet" else reader.json(path)


# codecs by the ending that Spark and Hadoop give a file before or after its format
CODECS = {"snappy": "snappy", "zstd": "zstd", "zst": "zstd", "gz": "gzip", "lz4": "lz4",
          "lz4hadoop": "lz4", "lz4raw": "lz4_raw", "bz2": "bzip2", "deflate": "deflate", "br": "brotli"}


def file_codec(path: Column) -> Column:
    """Codec that a file's name states, 'none' if it states none."""
    ending = F.regexp_extract(path, r"\.([a-z0-9]+)(?:\.(?:parquet|json|txt|csv))?$", 1)
    names = F.create_map(*[F.lit(x) for pair in CODECS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, ending), F.lit("none"))


def export_files(spark: SparkSession, fmt: str, path: str, schema) -> DataFrame:
    """(file, rows, size, compression) of every file with rows, in one job."""
    kind = "parquet" if fmt == "parquet" else "json"
    return (read_back(spark, kind, path, schema)
            .groupBy(F.col("_metadata.file_path").alias("file"))
            .agg(F.count("*").alias("rows"), F.first(F.col("_metadata.file_size")).alias("size"))
            .withColumn("compression", file_codec(F.col("file"))))


def export_info(spark: SparkSession, fmt: str, path: str, schema) -> DataFrame:
    """One row: format, path, samples, the files' codecs and their total size."""
    codecs = F.array_join(F.array_sort(F.collect_set("compression")), ",")
    return export_files(spark, fmt, path, schema).agg(
        F.lit(fmt).alias("format"), F.lit(path).alias("path"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("samples"), codecs.alias("compression"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("file_size"))


def write_statistics(summary: DataFrame, path: str) -> None:
    """The one-row summary as JSON."""
    summary.coalesce(1).write.mode("overwrite").json(path)
