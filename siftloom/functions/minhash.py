"""MinHash signatures and band buckets.

Word hashes are made by built-in expressions; one Arrow UDF turns a batch of
hash lists into signatures with numpy. Nothing is exploded or shuffled: a
signature needs only its own row.
"""

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from siftloom.constants import NUM_PERMUTATIONS, SEED, SIMILARITY_THRESHOLD
from siftloom.functions.text import words

PRIME = (1 << 31) - 1
_CHUNK = 1 << 15


def permutations(num_perm: int = NUM_PERMUTATIONS, seed: int = SEED):
    """(a, b) pairs of the hash family (a*h + b) mod PRIME, drawn from md5 of the seed."""
    def draw(name, i, bound):
        return int(hashlib.md5(f"{seed}:{name}:{i}".encode()).hexdigest()[:8], 16) % bound
    return [(1 + draw("a", i, PRIME - 1), draw("b", i, PRIME)) for i in range(num_perm)]


def band_shape(threshold: float = SIMILARITY_THRESHOLD, num_perm: int = NUM_PERMUTATIONS,
               steps: int = 1000):
    """(bands, rows) with the least equally weighted false-positive and
    false-negative area around the threshold."""
    s = (np.arange(steps) + 0.5) / steps
    best = None
    for bands in range(1, num_perm + 1):
        for rows in range(1, num_perm // bands + 1):
            hit = 1 - (1 - s ** rows) ** bands
            error = np.where(s < threshold, hit, 1 - hit).sum()
            if best is None or error < best[0]:
                best = (error, bands, rows)
    return best[1], best[2]


@dataclass(frozen=True)
class Banding:
    """Shape of the index; `bands * rows` may not exceed `num_perm`."""

    num_perm: int = NUM_PERMUTATIONS
    bands: int = 5
    rows: int = 25
    seed: int = SEED

    @classmethod
    def for_threshold(cls, threshold: float, num_perm: int = NUM_PERMUTATIONS, seed: int = SEED):
        return cls(num_perm, *band_shape(threshold, num_perm), seed)


def word_hashes(text: Column) -> Column:
    """31-bit hashes of the distinct words."""
    return F.transform(
        F.array_distinct(words(text)),
        lambda w: F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint") % PRIME)


def packed_hashes(text: Column) -> Column:
    """The same before the modulus, four bytes each, one after another."""
    heads = F.transform(F.array_distinct(words(text)), lambda w: F.substring(F.md5(w), 1, 8))
    return F.unhex(F.array_join(heads, ""))


def _spans(offsets, limit):
    """Row ranges of about ``limit`` values each; a longer row stands alone."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), rows)
        yield start, end
        start = end


def _signatures(values, offsets, pairs):
    """(rows, len(pairs)) minima; a row without words keeps PRIME everywhere."""
    out = np.full((len(offsets) - 1, len(pairs)), PRIME, dtype=np.int64)
    for start, end in _spans(offsets, _CHUNK):
        filled = np.flatnonzero(np.diff(offsets[start:end + 1])) + start
        if not len(filled):
            continue
        chunk = values[offsets[start]:offsets[end]]
        heads = offsets[filled] - offsets[start]
        for i, (a, b) in enumerate(pairs):
            x = chunk * np.uint64(a) + np.uint64(b)
            # two folds reduce modulo the Mersenne prime 2^31 - 1
            x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
            x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
            x[x == np.uint64(PRIME)] = 0
            out[filled, i] = np.minimum.reduceat(x, heads)
    return out


def signature(text: Column, num_perm: int = NUM_PERMUTATIONS, seed: int = SEED) -> Column:
    """array<bigint> of ``num_perm`` minima over the set of words."""
    pairs = permutations(num_perm, seed)

    @F.arrow_udf("array<bigint>")
    def minima(hashes: pa.Array) -> pa.Array:
        data = hashes.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(data.buffers()[1], dtype=np.int64)[
            data.offset:data.offset + len(data) + 1]
        joined = data.buffers()[2] if offsets[-1] > offsets[0] else b""
        values = np.frombuffer(joined, dtype=">u4", offset=offsets[0],
                               count=(offsets[-1] - offsets[0]) // 4).astype(np.uint64) % np.uint64(PRIME)
        offsets = (offsets - offsets[0]) // 4
        flat = _signatures(values, offsets, pairs).reshape(-1)
        bounds = np.arange(0, len(flat) + 1, num_perm, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))

    return minima(packed_hashes(text))


def band_keys(sig: Column, banding: Banding = Banding()) -> Column:
    """One md5 per band over the band number and its slice of the signature."""
    return F.array(*[
        F.md5(F.concat_ws(",", F.lit(str(band)),
                          F.slice(sig, band * banding.rows + 1, banding.rows)
                          .cast("array<string>")))
        for band in range(banding.bands)])


def buckets(text: Column, banding: Banding = Banding()) -> Column:
    """The 16-byte bucket ids of a text, one per band."""
    keys = band_keys(signature(text, banding.num_perm, banding.seed), banding)
    return F.transform(keys, F.unhex)
