"""Corpus statistics, rejection tables and ranked reports."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftloom.functions.text import is_blank
from siftloom.operators.validation import error_code
from siftloom.session import materialize

DIMENSIONS = ("dataset", "language", "license", "difficulty")


def _mean(c: Column) -> Column:
    return F.round(F.coalesce(F.avg(c), F.lit(0.0)), 6)


def run_statistics(df: DataFrame, tokens: str = "token_count") -> DataFrame:
    """One row: samples, tokens, their mean, longest and shortest (0 when empty)."""
    t = F.col(tokens)

    def filled(c):
        return F.coalesce(c, F.lit(0)).cast("bigint")

    return df.agg(F.count("*").alias("samples"), filled(F.sum(t)).alias("tokens"),
                  _mean(t).alias("average_tokens"), filled(F.max(t)).alias("longest"),
                  filled(F.min(t)).alias("shortest"))


def cells(df: DataFrame, *dimensions: str, metrics: list[Column] = ()) -> DataFrame:
    """One pass: the dimensions (null is 'unknown'), ``n`` and additive metrics of each combination.

    Reports are rolled up from these few rows, so the samples are read and aggregated once.
    """
    return (df.withColumns({f"_d{i}": F.coalesce(d, F.lit("unknown")) for i, d in enumerate(dimensions)})
            .groupBy(*[F.col(f"_d{i}").alias(d) for i, d in enumerate(dimensions)])
            .agg(F.count("*").alias("n"), *metrics))


def by_dimension(cube: DataFrame, *dimensions: str) -> DataFrame:
    """(dimension, value, n) for each of the given columns of ``cells``."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in dimensions])
    return (cube.select("n", F.inline(pairs)).groupBy("dimension", "value")
            .agg(F.sum("n").alias("n")))


def count_by(df: DataFrame, *dimensions: str) -> DataFrame:
    """One pass: (dimension, value, n) for each of the given columns; null is 'unknown'."""
    return by_dimension(cells(df, *dimensions), *dimensions)


def per_dataset(df: DataFrame) -> DataFrame:
    """(dataset, dimension, value, n) for languages and licenses within each dataset."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value"))
                      for d in ("language", "license")])
    cube = cells(df, "dataset", "language", "license")
    return (cube.select("dataset", "n", F.inline(pairs)).groupBy("dataset", "dimension", "value")
            .agg(F.sum("n").alias("n")))


LENGTHS = ("instruction", "output", "input")
EMPTY = ("instruction", "output")


def _additive(tokens: str) -> list[Column]:
    """What ``cells`` needs for all metrics of a summary."""
    t = F.col(tokens)
    return [F.sum(t).alias("tokens"), F.count(t).alias("counted"), F.min(t).alias("least"),
            F.max(t).alias("most"), F.count_if(F.size("tests") > 0).alias("tested"),
            *[f(F.length(name)).alias(f"{kind}_{name}") for name in LENGTHS
              for kind, f in (("sum", F.sum), ("count", F.count))],
            *[F.count_if(is_blank(F.col(name))).alias(f"empty_{name}") for name in EMPTY]]


def _ratio(total: Column, count: Column) -> Column:
    return F.round(F.coalesce(F.try_divide(total.cast("double"), count), F.lit(0.0)), 6)


def _totals() -> list[Column]:
    """The metrics over all cells."""
    def whole(c):
        return F.coalesce(c, F.lit(0)).cast("bigint")
    return [
        whole(F.sum("n")).alias("total_samples"),
        _ratio(F.sum("tokens"), F.sum("counted")).alias("average_tokens"),
        whole(F.min("least")).alias("min_tokens"), whole(F.max("most")).alias("max_tokens"),
        *[_ratio(F.sum(f"sum_{n}"), F.sum(f"count_{n}")).alias(f"average_{n}_length") for n in LENGTHS],
        whole(F.sum("tested")).alias("samples_with_tests"),
        *[whole(F.sum(f"empty_{n}")).alias(f"empty_{n}") for n in EMPTY]]


def corpus_statistics(df: DataFrame, tokens: str = "token_count") -> DataFrame:
    """One row of totals, token and length means, test and empty-field counts."""
    return df.agg(F.count("*").alias("n"), *_additive(tokens)).agg(*_totals())


def summary_record(df: DataFrame, duplicates: DataFrame = None,
                   tokens: str = "token_count") -> DataFrame:
    """One row with every metric; distributions are maps over a small set of names.

    The samples are aggregated once, by all four dimensions; what the maps and totals read is
    that table. Datasets come from the registry and languages, licenses and difficulties
    from closed lists, so it stays small. ``duplicates`` is the one row of
    ``dedup.dedup_counts`` of the removal the samples went through, or None for 0.
    """
    cube = materialize(cells(df, *DIMENSIONS, metrics=_additive(tokens)), "cells")
    maps = by_dimension(cube, *DIMENSIONS).agg(*[
        F.map_from_entries(F.array_sort(F.collect_list(
            F.when(F.col("dimension") == d, F.struct("value", "n"))))).alias(name)
        for d, name in zip(DIMENSIONS, ("samples_per_dataset", "language_distribution",
                                        "license_distribution", "difficulty_distribution"))])
    percentage = F.lit(0.0) if duplicates is None else F.coalesce(
        duplicates.select("duplicate_percentage").scalar(), F.lit(0.0))
    distributions = maps.select(F.struct("*")).scalar()
    return cube.agg(*_totals()).withColumns(
        {"maps": distributions, "duplicate_percentage": percentage}).select(
        "total_samples", "maps.samples_per_dataset", "maps.language_distribution",
        "maps.license_distribution", "maps.difficulty_distribution",
        "average_tokens", "min_tokens", "max_tokens",
        "average_instruction_length", "average_output_length", "average_input_length",
        "samples_with_tests", "duplicate_percentage",
        F.create_map(F.lit("instruction"), F.col("empty_instruction"),
                     F.lit("output"), F.col("empty_output")).alias("empty_fields"))


def with_share(counts: DataFrame, n: str = "n", into: str = "percent") -> DataFrame:
    """Add each count's percentage of the total of all counts."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.withColumn(into, F.round(F.col(n) * 100.0 / total, 6))


def ranked(counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """Largest count first, ties by name."""
    return counts.orderBy(F.desc(n), F.asc(key))


def top_with_share(df: DataFrame, column: str, limit: int = 10) -> DataFrame:
    counts = (df.groupBy(F.coalesce(column, F.lit("unknown")).alias(column))
              .agg(F.count("*").alias("n")))
    return ranked(with_share(counts), column).limit(limit)


def rejection_counts(decided: DataFrame, reasons: str = "reasons") -> DataFrame:
    """(reason, n, percent): recorded rejections by stable code, share of all recorded."""
    counts = (decided.select(F.explode(reasons).alias("message"))
              .groupBy(error_code(F.col("message")).alias("reason"))
              .agg(F.count("*").alias("n")))
    return with_share(counts)


def decision_counts(decided: DataFrame, reasons: str = "reasons") -> DataFrame:
    """One row: accepted and rejected samples, and the recorded rejections."""
    size = F.size(reasons)
    return decided.agg(F.count_if(size == 0).alias("accepted"),
                       F.count_if(size > 0).alias("rejected"),
                       F.coalesce(F.sum(size.cast("bigint")), F.lit(0)).alias("recorded"))
