"""What the operators share: row keys, Arrow slices, word boundaries and rolling hashes.

A document is known by ``_d``, its id (null: the smallest long, so it comes first), and
``_h``, a hash of its text, which tells repeated ids with different texts apart.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_ID = -(1 << 63)
SLICE_BYTES = 1 << 21
LONG_WORD = 64
SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
BASE, STEP = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def id_key(doc_id) -> Column:
    """The id as a long; a missing one sorts first."""
    return F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID))


def text_key(text) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def whole(text) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def hex_sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def aside(docs: DataFrame, names: list[str]) -> list[Column]:
    """The named columns under positional names, so that no name of an operator meets them."""
    return [F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(names)]


def back(names: list[str]) -> list[Column]:
    return [F.col(f"__{i}").alias(c) for i, c in enumerate(names)]


def aside_schema(docs: DataFrame, names: list[str]) -> str:
    return ", ".join(f"__{i} {docs.schema[c].dataType.simpleString()}"
                     for i, c in enumerate(names))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES, rows: int = 1 << 30):
    """Pieces of a batch with at most ``limit`` bytes of text and ``rows`` rows, or a single row.

    Yields (piece, bytes of its texts, offsets of the texts in them).
    """
    texts = batch.column(column)
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
        texts, kind = texts.cast(pa.large_binary()), np.int64
    else:
        texts, kind = texts.cast(pa.binary()), np.int32
    offsets = np.frombuffer(texts.buffers()[1], dtype=kind)[
        texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), first + rows, len(texts))
        yield (batch.slice(first, last - first), data[offsets[first]:offsets[last]],
               offsets[first:last + 1] - offsets[first])
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACES):
    """(starts, ends, first): bytes of each word, and each document's first word and end.

    Words are maximal runs without bytes marked in ``between``, as a rule the six ASCII
    white-space characters.
    """
    inside = ~between[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    before[edges] = False
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(values: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    v = values ^ (values >> np.uint64(30))
    v = v * np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v = v * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                base: int = BASE) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for every pair, by one pass over the values."""
    n = len(values)
    inverse = powers(pow(base, -1, 1 << 64), n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(base, n), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts]
                 + (ends - starts).astype(np.uint64) * np.uint64(STEP))


def word_hashes(data, starts, ends) -> np.ndarray:
    """A 64-bit hash of every word.

    Sums modulo 2^64 collide for certain strings of 1,024 symbols and more, whatever the base, so
    words longer than ``LONG_WORD`` bytes are hashed one by one.
    """
    out = span_hashes(data, starts, ends)
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        digest = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return np.where((data >= 65) & (data <= 90), data | 32, data)


def gram_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive hashes."""
    n = max(0, len(hashes) - width + 1)
    first = np.arange(n)
    return span_hashes(hashes, first, first + width, STEP)


def within(first: np.ndarray, n: int, width: int):
    """(document of each word, whether ``width`` words of that document start there)."""
    counts = np.diff(first)
    document = np.repeat(np.arange(len(counts)), counts)
    return document, np.arange(n) + width <= first[document + 1]


def slid_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` consecutive values, by doubling."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def expanded(counts: np.ndarray):
    """(row, number within the row) of ``counts[row]`` entries for every row."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
