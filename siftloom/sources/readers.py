"""Reading one source: format by suffix, split pruning, schema checks, row order."""

import functools
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftloom.constants import READER_BY_SUFFIX
from siftloom.schema import OPTIONAL, RAW, TYPED
from siftloom.session import materialize
from siftloom.sources.registry import Source

ROW_BITS, FILE_BITS = 34, 22
# the listing and the metadata column differ in the slashes after the scheme
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):/+"


def reader_for(path: str) -> str | None:
    return READER_BY_SUFFIX.get(path.rsplit(".", 1)[-1].lower())


def _suffixes(fmt: str) -> str:
    return ",".join(s for s, f in READER_BY_SUFFIX.items() if f == fmt)


def _below(reader, path: str, fmt: str) -> DataFrame:
    """All data files of a format below a folder, as one table."""
    return (_with_options(reader, fmt).option("recursiveFileLookup", "true")
            .option("pathGlobFilter", f"*.{{{_suffixes(fmt)}}}").format(fmt).load(path))


def _root(path: str) -> str:
    return re.sub(_SCHEME, "/", path).rstrip("/") + "/"


def _of_split(files: list[str], path: str, split: str) -> list[str]:
    """The files that name the split somewhere below the source's folder."""
    return [f for f in files if split in f.split(_root(path), 1)[-1].lower()]


def find_files(spark: SparkSession, path: str, split: str, schema) -> tuple[str, list[str]]:
    """(format, files): the preferred format present, pruned to the split if it is laid out so.

    The names come from the listing Spark makes for a scan anyway.
    """
    if reader_for(path):
        return reader_for(path), [path]
    for fmt in dict.fromkeys(READER_BY_SUFFIX.values()):
        files = sorted(_below(spark.read.schema(schema), path, fmt).inputFiles())
        if files:
            return fmt, _of_split(files, path, split) or files
    raise FileNotFoundError(f"no {'/'.join(READER_BY_SUFFIX)} files below {path}")


def _with_options(reader, fmt: str, layout: str = "lines"):
    """Text formats stop at the first record they cannot read instead of nulling it.

    A quoted CSV field may hold line breaks, so such files are read whole; JSON files are only
    if the source says that each is one array.
    """
    if fmt == "csv":
        return (reader.option("header", "true").option("escape", '"').option("multiLine", "true")
                .option("enforceSchema", "false").option("mode", "FAILFAST"))
    if fmt == "json":
        return (reader.option("multiLine", str(layout == "array").lower())
                .option("mode", "FAILFAST"))
    return reader


def _wider(a: T.DataType, b: T.DataType, name: str) -> T.DataType:
    """The type that holds both; numbers of another width are the only ones that may differ."""
    for order in ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.FloatType, T.DoubleType)):
        if isinstance(a, order) and isinstance(b, order):
            return max(a, b, key=lambda kind: order.index(type(kind)))
    if a == b:
        return a
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(_wider(a.elementType, b.elementType, name))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _joined(a, b)
    raise ValueError(f"column {name} is {a.simpleString()} in one file, {b.simpleString()} in another")


def _joined(a: T.StructType, b: T.StructType) -> T.StructType:
    """The fields of both, in the order in which they are met."""
    fields = {f.name: f.dataType for f in a}
    for field in b:
        own = fields.get(field.name, field.dataType)
        fields[field.name] = _wider(own, field.dataType, field.name)
    return T.StructType([T.StructField(n, kind) for n, kind in fields.items()])


def file_schema(spark: SparkSession, fmt: str, files: list[str], source: Source) -> T.StructType:
    """What the files declare together: all footers or headers, or the fields of JSON records.

    Footers are merged by one job; one by one only if widths differ between files. JSON files
    are read up to the one by which no required field is missing, and optional fields count as
    declared, since a record without one is null there anyway.
    """
    kind = source.adapter or source.id
    reader = _with_options(spark.read, fmt, source.layout).format(fmt)
    found = T.StructType()
    if fmt == "parquet":
        try:
            found = reader.option("mergeSchema", "true").load(files).schema
        except Exception as error:
            if "MERGE" not in str(error).upper():
                raise
            reader = spark.read.format(fmt)
            for file in files:
                found = _joined(found, reader.load(file).schema)
    else:
        for file in files:
            found = _joined(found, reader.load(file).schema) if fmt == "csv" else T.StructType(
                [*found, *[f for f in reader.load(file).schema if f.name not in found.names]])
            if fmt == "json" and found.fields and not (kind in RAW and problems_of(found, kind)):
                break
    if not found.fields:
        # no record anywhere, so nothing contradicts the adapter
        return RAW.get(kind, found)
    if fmt == "json" and kind in RAW:
        return T.StructType([*found, *[f for f in RAW[kind] if f.name not in found.names
                                       and f.name in OPTIONAL.get(kind, ())]])
    return found


def _by_header(spark: SparkSession, files: list[str]) -> DataFrame | None:
    """CSV files read by their own headers; a column that a file lacks is null there.

    Files without a header have no rows; None if all are like that.
    """
    groups = {}
    for file in files:
        own = _with_options(spark.read, "csv").format("csv").load(file).schema
        if own.fields:
            groups.setdefault(tuple(own.names), (own, []))[1].append(file)
    parts = [_with_options(spark.read, "csv").format("csv").schema(own).load(group)
             for own, group in groups.values()]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                            parts) if parts else None


def load(spark: SparkSession, source: Source, schema: T.StructType = None) -> DataFrame:
    """The raw table of a source, lazily: a stream if the source says so.

    Columns are bound by name and keep the type of the files, the widest of their numbers; JSON
    fields are read as the types the adapter declares. Fields the adapter does not know are
    left out, and one that only some files have is null in the others.
    """
    kind = source.adapter or source.id
    schema = schema or RAW[kind]
    path = f"{source.path}/{source.config}" if source.config else source.path
    fmt, files = find_files(spark, path, source.split, schema)
    found = file_schema(spark, fmt, files, source)
    problems = problems_of(found, kind) if kind in RAW else []
    if problems:
        raise ValueError(f"{source.id}: " + "; ".join(problems))
    names = [f.name for f in schema if f.name in found.names]
    # a CSV file is read by its own header, so its columns may come in any order
    declared = schema if fmt == "json" else found
    if source.streaming:
        reader = _with_options(spark.readStream.schema(declared), fmt, source.layout)
        root = reader_for(path)
        if not root:
            reader = reader.option("recursiveFileLookup", "true").option(
                "pathGlobFilter", f"*.{{{_suffixes(fmt)}}}")
        raw = reader.format(fmt).load(path)
        if not root and _of_split(files, path, source.split):
            name = F.lower(F.substring_index(F.col("_metadata.file_path"),
                                             _root(path), -1))
            raw = raw.where(F.contains(name, F.lit(source.split)))
        return raw.select(*names)
    if fmt == "csv" and len(files) > 1 and names:
        table = _by_header(spark, files)
        if table is not None:
            return table.select(*names)
    reader = _with_options(spark.read, fmt, source.layout).format(fmt)
    return reader.schema(declared).load(files).select(*names)


def load_all(spark: SparkSession, sources):
    """(source, checked raw table) pairs in registry order."""
    for source in sources:
        raw = load(spark, source)
        check(raw, source.adapter or source.id)
        yield source, raw


def inspect_schema(df: DataFrame) -> DataFrame:
    """(field, type) rows of a table's schema."""
    return df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in sorted(df.schema, key=lambda f: f.name)],
        "field string, type string")


def schema_problems(df: DataFrame, kind: str) -> list[str]:
    """Differences from the declared raw schema: missing columns, other types."""
    return problems_of(df.schema, kind)


def problems_of(schema: T.StructType, kind: str) -> list[str]:
    actual = {f.name: f.dataType for f in schema}
    problems = []
    for field in RAW[kind]:
        if field.name not in actual:
            if field.name not in OPTIONAL.get(kind, ()):
                problems.append(f"missing column {field.name}")
        elif field.name not in TYPED and isinstance(field.dataType, T.ArrayType) != isinstance(
                actual[field.name], T.ArrayType):
            problems.append(f"column {field.name} is {actual[field.name].simpleString()}, "
                            f"expected {field.dataType.simpleString()}")
    return problems


def check(df: DataFrame, kind: str) -> DataFrame:
    """The table itself if an adapter of this kind can read it, an error otherwise."""
    if df is None:
        raise ValueError(f"no table for {kind}")
    problems = schema_problems(df, kind)
    if problems:
        raise ValueError(f"{kind}: " + "; ".join(problems))
    return df


def _below_limit(place, bits: int):
    """The place itself; an error, not a collision, if it needs more bits than it has."""
    return F.when((place >= 0) & (place < (1 << bits)), place).otherwise(F.raise_error(
        F.concat(F.lit(f"a position needs more than {bits} bits: "), place.cast("string"))))


def with_file_position(df: DataFrame, dataset_ord: int = 0) -> DataFrame:
    """Add ``pos``: files in name order, rows in file order (Parquet sources).

    The place does not depend on how the scan is split into partitions.
    """
    files = sorted(re.sub(_SCHEME, r"\1:/", f) for f in df.inputFiles())
    if len(files) >= 1 << FILE_BITS:
        raise ValueError("too many files for a packed position; give the source an order column")
    # at most 2^22 short rows; the join goes by their size
    ordinals = df.sparkSession.createDataFrame(
        [(f, i) for i, f in enumerate(files)], "_file string, _ord bigint")
    placed = df.withColumns({"_file": F.regexp_replace("_metadata.file_path", _SCHEME, "$1:/"),
                             "_row": F.col("_metadata.row_index")})
    base = F.lit(dataset_ord).cast("bigint") * (1 << (ROW_BITS + FILE_BITS))
    return (placed.join(ordinals, "_file")
            .withColumn("pos", base + F.col("_ord") * (1 << ROW_BITS)
                        + _below_limit(F.col("_row"), ROW_BITS))
            .drop("_file", "_row", "_ord"))


def with_position(df: DataFrame, source: Source, dataset_ord: int) -> DataFrame:
    """Add ``dataset_ord`` and ``pos``, the unique place in the overall arrival order.

    The order column of the source decides; without one, Parquet rows take their
    place in the files. Rows of text formats have no place of their own: they are
    staged as Parquet once, and their place in the staged table stands.
    """
    if source.order_by:
        base = F.lit(dataset_ord).cast("bigint") * (1 << (ROW_BITS + FILE_BITS))
        placed = df.withColumn("pos", base + _below_limit(
            F.col(source.order_by).cast("bigint"), ROW_BITS + FILE_BITS))
    elif df.isStreaming:
        raise ValueError(f"{source.id}: a stream needs an order column")
    else:
        if any(reader_for(f) != "parquet" for f in df.inputFiles()):
            df = materialize(df, "staged")
        placed = with_file_position(df, dataset_ord)
    return placed.withColumn("dataset_ord", F.lit(dataset_ord))
