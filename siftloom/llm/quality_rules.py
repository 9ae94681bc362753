"""Operator 8: quality rules whose cutoffs come from the data, per language and source.

Each measure is a ratio. A quantile sketch of it is a histogram over logarithmic buckets of
relative width ``accuracy``: sketches of partitions, days or sources merge by adding
counts, give the same quantiles in whatever order they are merged, and never exceed a few
thousand rows. A group's cutoff lies as far above its 90th percentile as ``reach`` times
the distance between median and 90th percentile, so it adapts to how the source
writes and only rejects what lies clearly outside. A group with fewer than ``least_rows``
documents uses the sketch of its language, and that of all documents if that is small too.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftloom.llm.rows import (SPACES, gram_hashes, slices, whole, within, word_bounds,
                               word_hashes)
from siftloom.session import materialize

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
MEASURES = ("word_length", "symbol_ratio", "dup_line_ratio", "repeat_ratio")


@dataclass(frozen=True)
class Rules:
    accuracy: float = 0.02
    reach: float = 4.0
    # distance that is kept even where a group hardly varies, per measure; that of
    # repeat_ratio lies below the base limit, beyond which no document gets here
    slack: tuple = (0.75, 0.2, 0.35, 0.1)
    least_rows: int = 200
    least_words: int = 10
    repeat_percent: int = 20
    window: int = 5


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated_words(hashes: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    """Words of each document in windows that its text holds twice or more."""
    document, complete = within(first, len(hashes), width)
    grams = gram_hashes(hashes, width)
    where = np.flatnonzero(complete)
    order = where[np.lexsort((grams[where], document[where]))]
    same = (grams[order[1:]] == grams[order[:-1]]) & (document[order[1:]] == document[order[:-1]])
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    steps = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(steps, order[twice], 1)
    np.add.at(steps, order[twice] + width, -1)
    return _sums(np.cumsum(steps)[:-1] > 0, first)


def duplicate_lines(text: bytes) -> tuple[int, int]:
    """(lines with a word, those equal to an earlier line)."""
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c")]
    return len(lines), len(lines) - len(set(lines))


def measured(docs: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The documents' other columns with n_words, word_chars, n_symbols, n_lines, n_dup_lines
    and n_repeat_words (long)."""
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    kept = [c for c in docs.columns if c != text and c not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, data, offsets in slices(batch, "_text"):
                starts, ends, first = word_bounds(data, offsets)
                hashes = word_hashes(data, starts, ends)
                lines = np.array([duplicate_lines(data[a:b].tobytes())
                                  for a, b in zip(offsets[:-1], offsets[1:])],
                                 dtype=np.int64).reshape(-1, 2)
                columns = (np.diff(first),
                           _sums(~SPACES[data] & ((data & 0xC0) != 0x80), offsets),
                           _sums(SYMBOLS[data], offsets), lines[:, 0], lines[:, 1],
                           repeated_words(hashes, first, rules.window))
                yield pa.RecordBatch.from_arrays(
                    [*[piece.column(n) for n in kept],
                     *[pa.array(c.astype(np.int64)) for c in columns]], names=[*kept, *names])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema
                        if f.name in kept] + [f"{n} bigint" for n in names])
    return docs.select(*kept, whole(text).alias("_text")).mapInArrow(run, schema)


def base_failed(rules: Rules = Rules()) -> Column:
    return ((F.col("n_words") < rules.least_words)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.repeat_percent))


def measures() -> Column:
    """(measure, value) of a document, as an array; no words give zeros."""
    def ratio(part, of):
        return F.coalesce(F.col(part).cast("double") / F.nullif(F.col(of), F.lit(0)), F.lit(0.0))
    values = (ratio("word_chars", "n_words"), ratio("n_symbols", "n_words"),
              ratio("n_dup_lines", "n_lines"), ratio("n_repeat_words", "n_words"))
    return F.array(*[F.struct(F.lit(n).alias("measure"), v.alias("value"))
                     for n, v in zip(MEASURES, values)])


def sketch(values: DataFrame, keys: list[str], accuracy: float) -> DataFrame:
    """A mergeable sketch of ``value`` for each key: (keys, bucket, n).

    Bucket 0 holds zeros, bucket b the values up to ``(1 + accuracy) ** b / 1000``.
    """
    bucket = F.when(F.col("value") <= 0.001, F.when(F.col("value") > 0, 1).otherwise(0)).otherwise(
        F.ceil(F.log(F.col("value") * 1000) / float(np.log1p(accuracy))) + 1)
    return (values.groupBy(*keys, bucket.cast("int").alias("bucket"))
            .agg(F.count("*").alias("n")))


def merged(sketches: DataFrame, keys: list[str]) -> DataFrame:
    return sketches.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, keys: list[str], shares: dict, accuracy: float) -> DataFrame:
    """One row per key with its number of rows and the named quantiles.

    A sketch has at most a few thousand buckets, so the windows are small.
    """
    w = Window.partitionBy(*keys)
    placed = sketches.withColumns({
        "_below": F.sum("n").over(w.orderBy("bucket")), "_rows": F.sum("n").over(w)})
    value = F.when(F.col("bucket") == 0, 0.0).otherwise(
        F.pow(F.lit(1 + accuracy), F.col("bucket") - 1) / 1000)
    return placed.groupBy(*keys).agg(
        F.max("_rows").alias("rows"),
        *[F.min(F.when(F.col("_below") >= F.col("_rows") * s, value)).alias(n)
          for n, s in shares.items()])


def cutoffs(values: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(lang, source, measure, least, most) for every group that occurs.

    Null languages and sources are groups of their own.
    """
    shares = {"low": 0.1, "middle": 0.5, "high": 0.9}
    groups = materialize(sketch(values, ["lang", "source", "measure"], rules.accuracy), "sketch")
    fine = quantiles(groups, ["lang", "source", "measure"], shares, rules.accuracy)
    wide = quantiles(merged(groups, ["lang", "measure"]), ["lang", "measure"], shares,
                     rules.accuracy)
    full = quantiles(merged(groups, ["measure"]), ["measure"], shares, rules.accuracy)

    def named(df, prefix, keys):
        return df.select(*[F.col(k).alias(f"_{prefix}_{k}") for k in keys],
                         F.struct("rows", *shares).alias(prefix))

    joined = (named(fine, "fine", ["lang", "source", "measure"])
              .join(named(wide, "wide", ["lang", "measure"]),
                    F.col("_fine_lang").eqNullSafe(F.col("_wide_lang"))
                    & (F.col("_fine_measure") == F.col("_wide_measure")))
              .join(named(full, "full", ["measure"]),
                    F.col("_fine_measure") == F.col("_full_measure")))
    used = F.when(F.col("fine.rows") >= rules.least_rows, F.col("fine")).when(
        F.col("wide.rows") >= rules.least_rows, F.col("wide")).otherwise(F.col("full"))
    slack = F.element_at(F.create_map(*[F.lit(x) for pair in zip(MEASURES, rules.slack)
                                        for x in pair]), F.col("_fine_measure"))
    return joined.withColumn("_q", used).select(
        F.col("_fine_lang").alias("lang"), F.col("_fine_source").alias("source"),
        F.col("_fine_measure").alias("measure"),
        (F.col("_q.low") - slack - rules.reach * (F.col("_q.middle") - F.col("_q.low")))
        .alias("least"),
        (F.col("_q.high") + slack + rules.reach * (F.col("_q.high") - F.col("_q.middle")))
        .alias("most"))


def quality(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang",
            source: str = "source") -> DataFrame:
    """(doc_id, measures of the text, base_failed, kept) of every document.

    The measures are computed once and written; sketches and verdicts read them. A null text has
    no words and fails the base rules. Documents that fail these do not shape the
    cutoffs. Null labels are labels of their own. Repeated rows count as often as they occur; very long
    texts are measured whole; an empty table gives no rows.
    """
    given = docs.select("doc_id", F.col(lang).alias("lang"), F.col(source).alias("source"),
                        F.col(text).alias("text"))
    rows = materialize(measured(given, "text", rules).withColumn("base_failed",
                                                                 base_failed(rules)), "measured")
    values = (rows.where("NOT base_failed").select("lang", "source", F.inline(measures())))
    limits = (cutoffs(values, rules).groupBy("lang", "source").agg(F.map_from_entries(
        F.collect_list(F.struct("measure", F.struct("least", "most")))).alias("_limits")))
    limits = limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"),
                           "_limits")
    joined = rows.join(limits, F.col("lang").eqNullSafe(F.col("_lang"))
                       & F.col("source").eqNullSafe(F.col("_source")), "left")
    outside = F.exists(measures(), lambda m: F.coalesce(
        (m["value"] < F.col("_limits")[m["measure"]]["least"])
        | (m["value"] > F.col("_limits")[m["measure"]]["most"]), F.lit(False)))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & ~outside).alias("kept"))
