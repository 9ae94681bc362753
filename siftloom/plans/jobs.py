"""The composed jobs: read and unify, filter, deduplicate, report and write.

A run writes below ``out``: its train and validation sets in ``run=<n>``, its reports in
``_reports/run=<n>``, what it has decided in ``_state/run=<n>`` and the buckets it has kept as a
version of ``_state/index``. Last comes ``_commits/run=<n>``; without it nothing of the run counts,
and the next run takes its number and replaces it.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftloom.functions.minhash import Banding
from siftloom.functions.rows import settled
from siftloom.functions.text import clean_sample
from siftloom.functions.tokens import count_tokens, sample_tokens
from siftloom.operators import dedup, filters, statistics, validation
from siftloom.operators.index import BucketIndex, numbers_below
from siftloom.operators.sampling import split_counts, with_split
from siftloom.schema import TEXT_FIELDS
from siftloom.session import clear, materialize
from siftloom.sinks.reports import markdown, write_text
from siftloom.sinks.writers import write_split, write_statistics
from siftloom.sources.adapters import ADAPTERS, with_defaults
from siftloom.sources.readers import load_all, with_position
from siftloom.streaming.incremental import unknown


def adapt(raw: DataFrame, source, dataset_ord: int) -> DataFrame:
    """One source in unified form, with its defaults and its place in the arrival order."""
    adapted = ADAPTERS[source.adapter or source.id](with_position(raw, source, dataset_ord))
    return with_defaults(adapted, source)


def unified(spark: SparkSession, sources) -> DataFrame:
    """All sources in registry order, with defaults filled in."""
    sources = list(sources)
    parts = [adapt(raw, source, i) for i, (source, raw) in enumerate(load_all(spark, sources))]
    return reduce(DataFrame.unionByName, parts)


def not_yet_written(df: DataFrame, written: DataFrame) -> DataFrame:
    """Samples a previous run has not written, by dataset and id."""
    return df.join(written.select("dataset", "id").distinct(), ["dataset", "id"], "left_anti")


def decided(df: DataFrame, counter=count_tokens, **toggles) -> DataFrame:
    """Cleaned samples with ``token_count`` and the ``reasons`` against each; none means accepted.

    A filter gives one reason; only samples that pass all filters are validated,
    and those may have several.
    """
    cleaned = settled(filters.normalize_names(clean_sample(df)), *TEXT_FIELDS)
    filtered = cleaned.withColumn("_filter", filters.filter_reason(**toggles))
    passed = F.col("_filter").isNull()
    counted = filtered.withColumn("token_count", F.when(passed, sample_tokens(counter)))
    errors = validation.sample_errors(counted)
    judged = (counted.withColumn("reasons", F.when(passed, errors)
                                 .otherwise(F.array("_filter")))
              .drop("_filter"))
    return settled(judged, "reasons", "token_count")


def prepared(df: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of one decision frame."""
    frame = decided(df, **options)
    accepted = frame.where(F.size("reasons") == 0).drop("reasons")
    return accepted, frame.where(F.size("reasons") > 0)


@dataclass
class Outcome:
    """What a run leaves behind; every table is small except ``corpus``, the samples it adds."""

    corpus: DataFrame
    run_statistics: DataFrame
    by_language: DataFrame
    by_dataset: DataFrame
    rejections: DataFrame
    decisions: DataFrame
    duplicates: DataFrame
    splits: DataFrame
    run: int = 0


SAMPLE_KEY = "dataset string, id string"


def committed_runs(spark: SparkSession, out: str) -> list[int]:
    return numbers_below(spark, f"{out}/_commits", "run")


def decided_before(spark: SparkSession, out: str) -> DataFrame:
    """(dataset, id) of the samples that committed runs below ``out`` have decided, kept or not."""
    paths = [f"{out}/_state/run={n}" for n in committed_runs(spark, out)]
    if not paths:
        return spark.createDataFrame([], SAMPLE_KEY)
    return spark.read.schema(SAMPLE_KEY).parquet(*paths)


def committed(spark: SparkSession, out: str, schema: str, fmt: str = "json") -> DataFrame:
    """The corpus of all committed runs; ``schema`` may name the folders' columns run and split."""
    paths = [f"{out}/run={n}" for n in committed_runs(spark, out)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", out).format(fmt).load(paths)


def _commit(spark: SparkSession, out: str, run: int) -> None:
    spark.createDataFrame([(run,)], "run int").coalesce(1).write.mode("overwrite").json(
        f"{out}/_commits/run={run}")


def _write_reports(spark: SparkSession, outcome: Outcome, out: str) -> None:
    """The summary as JSON and the report as Markdown."""
    summary = materialize(statistics.summary_record(outcome.corpus, outcome.duplicates), "summary")
    folder = f"{out}/_reports/run={outcome.run}"
    write_statistics(summary, f"{folder}/statistics")
    write_text(spark, markdown(summary), f"{folder}/report")


def run(spark: SparkSession, sources, out: str, form: str = "instruction",
        banding: Banding = Banding(), counter=count_tokens, resume: bool = False) -> Outcome:
    """Unify, filter, deduplicate, write the train and validation sets, and report.

    The decision and the kept corpus are each written once to shared storage; the
    reports and the two output sets are read from there. Of rejected samples only
    the reasons are stored; ``prepared`` gives them in full.

    With ``resume`` the samples that committed runs have decided are left out, and near-duplicates
    of what they kept are dropped; without it ``out`` is started anew. A run that broke off before
    its commit is replaced in either case.
    """
    before = committed_runs(spark, out) if resume else []
    number = before[-1] + 1 if before else 0
    index = BucketIndex(spark, f"{out}/_state/index")
    accepts = F.size("reasons") == 0
    samples = unified(spark, sources)
    if before:
        samples = not_yet_written(samples, decided_before(spark, out))
    frame = decided(samples, counter)
    frame = materialize(frame.withColumns({name: F.when(accepts, F.col(name))
                                           for name in (*TEXT_FIELDS, "tests", "metadata")}),
                        "decided")
    accepted = frame.where(accepts).drop("reasons")
    rows = materialize(dedup.bucket_rows(accepted, banding=banding), "buckets")
    fresh = unknown(rows, index, number, banding.bands) if before else rows
    first = materialize(dedup.keep_first(fresh, banding.bands).select("pos"), "kept")
    gone = materialize(dedup.dropped(rows, first), "dropped")
    corpus = materialize(with_split(accepted.join(gone, "pos", "left_anti")), "corpus")
    if not before:
        clear(spark, out)
    write_split(corpus, f"{out}/run={number}", form)
    frame.select("dataset", "id").distinct().write.mode("overwrite").parquet(
        f"{out}/_state/run={number}")
    index.add(number, rows.join(first, "pos", "left_semi").select(F.explode("buckets").alias("bucket")))
    outcome = Outcome(
        corpus=corpus,
        run_statistics=statistics.run_statistics(corpus),
        by_language=statistics.ranked(statistics.count_by(corpus, "language"), "value"),
        by_dataset=statistics.ranked(statistics.count_by(corpus, "dataset"), "value"),
        rejections=statistics.ranked(statistics.rejection_counts(frame), "reason"),
        decisions=statistics.decision_counts(frame),
        duplicates=dedup.dedup_counts(accepted, corpus),
        splits=split_counts(corpus),
        run=number,
    )
    _write_reports(spark, outcome, out)
    _commit(spark, out, number)
    return outcome
