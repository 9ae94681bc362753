"""Where texts repeat: what the two exact substring operators share.

Every window of the wanted length has an anchor, the shorter run in it with the smallest
hash (leftmost on ties), so equal windows have equal anchors wherever they occur. Windows
that follow each other and share an anchor form a segment. Only anchors that occur twice
can belong to repeated windows; their segments go to the shard of the anchor, and equal windows
meet there. A shard is searched with the operator's own index.

Equal texts are searched once, by the smallest id: what their copies lose follows from that alone.

An anchor with very many occurrences is spread over several shards. These report every distinct
window once, by a digest of 128 bits, and a last grouping joins what the shards could not see.

Nothing here grows with a group: a slice of documents sends an anchor once, a shard gets
equal segments of a slice once, and both are bounded by the number of shards and salts.
"""

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftloom.llm.rows import (aside, aside_schema, back, gram_hashes, id_key, mixed, slices,
                               slid_minima, text_key, whole, within, word_bounds, word_hashes)

PLACE = np.uint64((1 << 28) - 1)
#: end of a span that covers a whole text
WHOLE = (1 << 31) - 1


@dataclass(frozen=True)
class Search:
    """What repeats: windows of ``window`` bytes or words, anchored at runs of ``anchor``.

    ``first_stays``: a window is only removed if a smaller id has it too. ``index`` maps the
    distinct segments of a shard, with the smallest id of each, to a flag for every window.
    """

    by_words: bool
    window: int
    anchor: int
    first_stays: bool
    index: Callable
    salted_beyond: int = 4000
    shard_bytes: int = 2 << 20


def units(data: np.ndarray, offsets: np.ndarray, by_words: bool):
    """(hash or value, start byte, end byte) of each unit and each document's first unit."""
    if by_words:
        starts, ends, first = word_bounds(data, offsets)
        return word_hashes(data, starts, ends), starts, ends, first
    place = np.arange(len(data))
    return data, place, place + 1, offsets


def segments(values: np.ndarray, first: np.ndarray, window: int, anchor: int):
    """(document, anchor hash, first window, last window, anchors) of all segments, in order.

    A segment has two or more anchors where the text is periodic; its windows may then repeat
    within it.
    """
    document, complete = within(first, len(values), window)
    starts = np.flatnonzero(complete)
    if not len(starts):
        none = np.zeros(0, dtype=np.int64)
        return none, none.astype(np.uint64), none, none, none
    grams = gram_hashes(values, anchor)
    packed = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
    chosen = (slid_minima(packed, window - anchor + 1)[starts] & PLACE).astype(np.int64)
    keys = grams[chosen]
    new = np.ones(len(starts), dtype=bool)
    # windows of one document are consecutive, those of two never are
    new[1:] = (keys[1:] != keys[:-1]) | (starts[1:] != starts[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(starts)) - 1
    of = document[starts[begin]]
    several = 1 + (chosen[begin] != chosen[end])
    return of, keys[begin], starts[begin] - first[of], starts[end] - first[of], several


def _lists(order_keys: np.ndarray):
    """Stable order of equal keys, and the places in it where a key begins."""
    order = np.argsort(order_keys, kind="stable")
    ordered = order_keys[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return order, np.flatnonzero(new)


def _anchors(search: Search):
    """(anchor, text that has it, further texts of the slice or null) once for every slice.

    Texts are known by their hash, and copies in a slice are one; a text that has the anchor more
    than once is listed twice.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, data, offsets in slices(batch, "_text"):
                values, _, _, first = units(data, offsets, search.by_words)
                of, keys, _, _, several = segments(values, first, search.window, search.anchor)
                texts = piece.column("_t").to_numpy()
                once = np.zeros(len(texts), dtype=bool)
                once[np.unique(texts, return_index=True)[1]] = True
                several = several * once[of]
                of, keys = of.repeat(several), keys.repeat(several)
                order, begins = _lists(keys)
                keys, of = keys[order], of[order]
                # the order is stable, so a document's occurrences follow each other
                third = np.zeros(len(of), dtype=bool)
                third[2:] = (keys[2:] == keys[:-2]) & (of[2:] == of[:-2])
                further = ~third
                further[begins] = False
                sizes = np.add.reduceat(further.astype(np.int64), begins) if len(begins) else begins
                edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                # most anchors occur once in a slice; these have no list
                more = pa.ListArray.from_arrays(pa.array(edges), pa.array(texts[of[further]]),
                                                mask=pa.array(sizes == 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[begins].view(np.int64)), pa.array(texts[of[begins]]), more],
                    names=["_key", "_t", "_more"])
    return run


def _segment_rows(search: Search, shards: int):
    """Segments with a repeated anchor; equal ones of a slice are one row with all places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, data, offsets in slices(batch, "_text"):
                values, begin, end, first = units(data, offsets, search.by_words)
                of, keys, low, high, _ = segments(values, first, search.window, search.anchor)
                wanted = piece.column("_keys")
                counts = np.diff(wanted.offsets.to_numpy())
                flat = wanted.flatten()
                known = mixed(flat.field("_key").to_numpy().view(np.uint64)
                              + np.repeat(np.arange(len(counts)), counts).astype(np.uint64))
                total = flat.field("_total").to_numpy()
                order = np.argsort(known)
                asked = mixed(keys + of.astype(np.uint64))
                at = np.searchsorted(known[order], asked)
                at = np.minimum(at, len(order) - 1)
                hit = known[order][at] == asked if len(order) else np.zeros(len(of), bool)
                of, keys, low, high = of[hit], keys[hit], low[hit], high[hit]
                if not len(of):
                    continue
                salts = total[order][at[hit]] // search.salted_beyond + 1
                row = piece.column("_row").to_numpy()[of]
                ids = piece.column("_d").to_numpy()[of]
                salt = mixed(row.view(np.uint64)) % salts.astype(np.uint64)
                shard = (mixed(keys + mixed(salt)) % np.uint64(shards)).astype(np.int64)
                start, stop = begin[first[of] + low], end[first[of] + high + search.window - 1]
                text = [data[a:b].tobytes() for a, b in zip(start, stop)]
                if search.by_words:
                    text = [b" ".join(t.split()) for t in text]
                groups: dict = {}
                for i, content in enumerate(text):
                    groups.setdefault((int(shard[i]), int(salts[i]) > 1, content), []).append(i)
                places = np.column_stack([ids, row, low])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in groups], pa.int32()),
                     pa.array([k[1] for k in groups], pa.bool_()),
                     pa.array([k[2] for k in groups], pa.binary()),
                     pa.array([places[g].tobytes() for g in groups.values()], pa.binary())],
                    names=["_shard", "_salted", "_content", "_places"])
    return run


def _runs(flags: np.ndarray):
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def window_digests(content: bytes, search: Search) -> np.ndarray:
    """(windows, 2) longs: the 128-bit digest of every window of a segment."""
    if search.by_words:
        words = content.split()
        parts = (b" ".join(words[i:i + search.window]) for i in range(len(words) - search.window + 1))
    else:
        parts = (content[i:i + search.window] for i in range(len(content) - search.window + 1))
    digests = b"".join(hashlib.blake2b(p, digest_size=16).digest() for p in parts)
    return np.frombuffer(digests, dtype=np.int64).reshape(-1, 2)


def _windows(opened: list, search: Search) -> list[np.ndarray]:
    """The distinct windows of a shard's spread anchors, from (digests, flags, id, row, start).

    Of equal windows the first is reported, and with it those that have the same id.
    """
    sizes = np.array([len(o[0]) for o in opened])
    values, flags = (np.concatenate([o[i] for o in opened]) for i in (0, 1))
    number, row, start = (np.repeat(np.array([o[i] for o in opened], dtype=np.int64), sizes)
                          for i in (2, 3, 4))
    low = start + np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = np.lexsort((np.arange(len(values)), values[:, 1], values[:, 0]))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (values[order][1:] != values[order][:-1]).any(axis=1)
    first = np.empty(len(order), dtype=np.int64)
    first[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    if search.first_stays:
        shown = np.flatnonzero(number == number[first])
    else:
        shown = np.flatnonzero(first == np.arange(len(first)))
    return [values[shown, 0], values[shown, 1], np.ones(len(shown), dtype=bool), number[shown],
            row[shown], low[shown], low[shown] + search.window, flags[shown]]


def _searched(search: Search):
    """Spans to remove, and the distinct windows of spread anchors, of one shard."""
    width = search.window

    def run(table: pa.Table) -> pa.Table:
        merged: dict = {}
        columns = [table.column(c).to_pylist() for c in ("_content", "_salted", "_places")]
        for content, salted, places in zip(*columns):
            merged.setdefault((salted, content), []).extend(
                np.frombuffer(places, dtype=np.int64).reshape(-1, 3).tolist())
        # in ascending order of the smallest id, then of the text, whatever came first
        found = sorted(((min(p[0] for p in places), key[1], key[0], places)
                        for key, places in merged.items()), key=lambda f: f[:3])
        contents = [f[1] for f in found]
        flags = search.index(contents, [f[0] for f in found], search)
        spans, opened = [], []
        for (least, content, salted, places), flag in zip(found, flags):
            if not search.first_stays and len(places) > 1:
                flag = np.ones(len(flag), dtype=bool)
            runs = [(int(a), int(b) + width - 1) for a, b in zip(*_runs(flag))]
            whole_segment = [(0, len(flag) + width - 1)]
            for number, row, start in places:
                later = search.first_stays and number > least
                spans += [(row, start + low, start + high)
                          for low, high in (whole_segment if later else runs)]
            if salted:
                # of equal segments, those of the smallest id stand for the others
                own = [p for p in places if p[0] == least] if search.first_stays else places[:1]
                digests = window_digests(content, search)
                opened += [(digests, flag, *p) for p in own]
        rows, lows, highs = (np.array([x[i] for x in spans], dtype=np.int64) for i in range(3))
        none = np.zeros(len(rows), dtype=np.int64)
        out = [rows, none, none.astype(bool), none, rows, lows, highs, none.astype(bool)]
        if opened:
            out = [np.concatenate(pair) for pair in zip(out, _windows(opened, search))]
        return pa.table([pa.array(column) for column in out],
                        names=["_part", "_rest", "_open", "_d", "_row", "_low", "_high", "_done"])
    return run


def _cut(search: Search, names: list[str], kept: str, counts: tuple[str, str, str]):
    """The documents with what is left and how much went."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, data, offsets in slices(batch, "_text"):
                _, begin, end, first = units(data, offsets, search.by_words)
                spans = piece.column("_spans").to_pylist()
                text, removed, pieces = [], [], []
                for i, own in enumerate(spans):
                    n = int(first[i + 1] - first[i])
                    gone = np.zeros(n + 1, dtype=np.int32)
                    for span in own or ():
                        if span["_high"] == WHOLE:
                            # equal to another text in all its windows, if it has any
                            gone[0] += n >= search.window
                        else:
                            gone[span["_low"]] += 1
                            gone[span["_high"]] -= 1
                    stays = np.cumsum(gone)[:n] == 0
                    removed.append(n - int(stays.sum()))
                    pieces.append(len(_runs(~stays)[0]))
                    if search.by_words:
                        at = np.flatnonzero(stays) + first[i]
                        text.append(b" ".join([data[a:b].tobytes()
                                               for a, b in zip(begin[at], end[at])]))
                    else:
                        text.append(data[offsets[i]:offsets[i + 1]][stays].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [*[piece.column(n) for n in names], pa.array(text, pa.binary()),
                     pa.array(np.diff(first).astype(np.int64)), pa.array(removed, pa.int64()),
                     pa.array(pieces, pa.int64())], names=[*names, kept, *counts])
    return run


def without_repeats(docs: DataFrame, search: Search, kept: str, counts: tuple[str, str, str],
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns with ``kept`` (binary) and the counts (units, removed, runs).

    One plan: the documents are dealt out by row key once, for both joins.
    """
    names = [c for c in docs.columns if c not in (kept, *counts)]
    safe = [f"__{i}" for i in range(len(names))]
    row = F.xxhash64(id_key(doc_id), text_key(text)).alias("_row")
    keyed = docs.select(*aside(docs, names), id_key(doc_id).alias("_d"), row,
                        whole(text).alias("_text"))
    size = docs.agg(F.sum(F.octet_length(whole(text)))).first()[0] or 0
    shards = int(size // search.shard_bytes) + 1

    # of equal texts the one with the smallest id is searched
    narrow = docs.select(text_key(text).alias("_t"), id_key(doc_id).alias("_d"), row)
    firsts = narrow.groupBy("_t").agg(F.min(F.struct("_d", "_row")).alias("_first"),
                                      F.count("*").alias("_n"))
    anchors = docs.select(text_key(text).alias("_t"), whole(text).alias("_text")).mapInArrow(
        _anchors(search), "_key bigint, _t bigint, _more array<bigint>")
    all_of = Window.partitionBy("_key")
    more = F.coalesce("_more", F.array().cast("array<bigint>"))
    several = (F.min(F.least("_t", F.array_min(more))).over(all_of)
               < F.max(F.greatest("_t", F.array_max(more))).over(all_of))
    if not search.first_stays:
        twice = F.size(F.array_distinct(F.array_append(more, F.col("_t")))) <= F.size(more)
        several = several | F.bool_or(twice).over(all_of)
    counted = anchors.withColumns({"_total": F.sum(F.size(more) + 1).over(all_of), "_several": several})
    wanted = (counted.where("_several")
              .select(F.explode(F.array_distinct(F.array_append(more, F.col("_t")))).alias("_t"),
                      "_key", "_total")
              .groupBy("_t").agg(F.collect_set(F.struct("_key", "_total")).alias("_keys"))
              .join(firsts, "_t").select(F.col("_first._row").alias("_row"), "_keys"))
    rows = keyed.join(wanted, "_row")
    found = rows.mapInArrow(_segment_rows(search, shards), (
        "_shard int, _salted boolean, _content binary, _places binary"))
    spans = found.groupBy("_shard").applyInArrow(_searched(search), (
        "_part bigint, _rest bigint, _open boolean, _d bigint, _row bigint, _low bigint, "
        "_high bigint, _done boolean"))
    same = Window.partitionBy("_part", "_rest", "_open")
    elsewhere = (F.min("_d").over(same) < F.col("_d")) if search.first_stays else \
        (F.count("*").over(same) > 1) & ~F.col("_done")
    spans = spans.withColumn("_remove", ~F.col("_open") | elsewhere).where("_remove")
    lost = F.col("_d") > F.col("_first._d") if search.first_stays else F.col("_n") > 1
    copies = narrow.join(firsts, "_t").where(lost).select(
        "_row", F.lit(0).cast("bigint").alias("_low"), F.lit(WHOLE).cast("bigint").alias("_high")).distinct()
    spans = spans.select("_row", "_low", "_high").unionByName(copies).groupBy("_row").agg(
        F.collect_list(F.struct("_low", "_high")).alias("_spans"))
    cut = keyed.join(spans, "_row", "left").mapInArrow(
        _cut(search, safe, "_kept", ("_n", "_removed", "_runs")),
        ", ".join([*filter(None, [aside_schema(docs, names)]), "_kept binary, _n bigint, "
                   "_removed bigint, _runs bigint"]))
    return cut.select(*back(names), F.col("_kept").alias(kept),
                      *[F.col(c).alias(n) for c, n in zip(("_n", "_removed", "_runs"), counts)])
