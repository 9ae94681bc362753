"""Operator 7: bytes inside repeated long strings, found with suffix arrays by induced sorting.

A shard's distinct segments form one string. Its suffixes are classified as smaller or larger than
the one behind; the leftmost smaller ones are sorted by their substrings up to the
next, which a first induction orders, and named; the string of names is sorted by doubling
prefixes, which a constant string does not slow down. From these the whole array is
induced in two passes, bucket by bucket: what a bucket holds puts the suffixes one place
to the left in order. Neighbours in the array then give every place its common prefix with the
suffixes closest to it, and a window repeats if either is as long as the window.

All steps work on whole buckets with numpy. Common prefixes are found for all neighbours together, by
halving steps over hashed stretches, instead of one after the other in the order of the text.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftloom.llm.repeats import Search, without_repeats
from siftloom.llm.rows import BASE, aside, back, mixed, powers, span_hashes


def smaller_types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one behind it; the last symbol is the least."""
    n = len(s)
    step = np.zeros(n, dtype=np.int8)
    step[:-1] = (s[1:] > s[:-1]).astype(np.int8) - (s[1:] < s[:-1])
    step[-1] = 1
    # equal symbols take the type of the next different one
    decides = np.where(step != 0, np.arange(n, dtype=np.int32), np.int32(n))
    decides = np.minimum.accumulate(decides[::-1])[::-1]
    return step[decides] > 0


def leftmost(smaller: np.ndarray) -> np.ndarray:
    return np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1


def ordered_names(s: np.ndarray) -> np.ndarray:
    """Suffix ranks of a string of names whose last one is the least and unique.

    A suffix is ranked by its first 1, 2, 4, ... names, by the ranks of its two halves; only what
    still ties is sorted on, so a constant string takes as many rounds as its length has bits.
    """
    n = len(s)
    order = np.argsort(s, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    new = np.ones(n, dtype=bool)
    new[1:] = s[order][1:] != s[order][:-1]
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    tied = np.append(~new[1:], False) | ~new
    open_, width = order[tied], 1
    while len(open_):
        # the last name is unique, so tied suffixes are longer than what they agree in
        first, second = rank[open_], rank[open_ + width]
        by = np.lexsort((second, first))
        open_, first, second = open_[by], first[by], second[by]
        outer = np.ones(len(open_), dtype=bool)
        outer[1:] = first[1:] != first[:-1]
        new = outer.copy()
        new[1:] |= second[1:] != second[:-1]
        place = np.arange(len(open_))
        rank[open_] = first + (np.maximum.accumulate(np.where(new, place, 0))
                               - np.maximum.accumulate(np.where(outer, place, 0)))
        open_ = open_[np.append(~new[1:], False) | ~new]
        width *= 2
    return rank


class Buckets:
    """Suffixes grouped by their first symbol; larger ones fill from the left."""

    def __init__(self, s: np.ndarray, smaller: np.ndarray):
        self.s, self.smaller = s, smaller
        counts = np.bincount(s)
        self.tail = np.cumsum(counts)
        self.head = self.tail - counts
        self.symbols = np.flatnonzero(counts)

    def induced(self, marks: np.ndarray) -> np.ndarray:
        """All suffixes in order, given the leftmost smaller ones in order."""
        s, smaller = self.s, self.smaller
        array = np.full(len(s), -1, dtype=np.int32)
        symbol = s[marks]
        order = np.argsort(symbol, kind="stable")
        counts = np.bincount(symbol, minlength=len(self.head))
        rank = np.arange(len(marks)) - np.repeat(np.cumsum(counts) - counts, counts)
        array[self.tail[symbol[order]] - counts[symbol[order]] + rank] = marks[order]

        def left_of(items, wanted, own):
            before = items[items > 0] - 1
            before = before[smaller[before] == wanted]
            symbols = s[before]
            same = symbols == own
            others, theirs = before[~same], symbols[~same]
            if len(others):
                by = np.argsort(theirs, kind="stable")
                others, theirs = others[by], theirs[by]
                begins = np.flatnonzero(np.diff(theirs, prepend=-1))
                sizes = np.diff(np.append(begins, len(theirs)))
                rank = np.arange(len(theirs)) - np.repeat(begins, sizes)
                if wanted:
                    array[last[theirs] - rank - 1] = others
                    last[theirs[begins]] -= sizes
                else:
                    array[next_[theirs] + rank] = others
                    next_[theirs[begins]] += sizes
            return before[same]

        next_ = self.head.copy()
        for own in self.symbols:
            done = self.head[own]
            while done < next_[own]:
                items = array[done:next_[own]]
                done = next_[own]
                more = left_of(items, False, own)
                array[done:done + len(more)] = more
                next_[own] += len(more)
            left_of(array[self.tail[own] - counts[own]:self.tail[own]], False, own)
        last = self.tail.copy()
        for own in self.symbols[::-1]:
            done = self.tail[own]
            # the leftmost smaller ones were only seeds; their places are filled anew
            while done > last[own]:
                items = array[last[own]:done][::-1]
                done = last[own]
                more = left_of(items, True, own)
                array[done - len(more):done] = more[::-1]
                last[own] -= len(more)
            left_of(array[self.head[own]:next_[own]][::-1], True, own)
        if self.tail[0] == 1:
            array[0] = len(s) - 1
        return array


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffixes of a string of small numbers that ends with its only 0, in order."""
    if len(s) < 2:
        return np.zeros(len(s), dtype=np.int32)
    smaller = smaller_types(s)
    marks = leftmost(smaller)
    buckets = Buckets(s, smaller)
    if not len(marks):
        return np.argsort(s, kind="stable").astype(np.int32)
    # first pass: the substrings in order, then their names in the order of the text
    array = buckets.induced(marks)
    is_mark = np.zeros(len(s), dtype=bool)
    is_mark[marks] = True
    inorder = array[is_mark[array]]
    ends = np.append(marks[1:] + 1, len(s))
    end_of = np.zeros(len(s), dtype=np.int32)
    end_of[marks] = ends
    shape = span_hashes(s, inorder.astype(np.int64), end_of[inorder])
    fresh = np.ones(len(inorder), dtype=np.int64)
    fresh[1:] = (shape[1:] != shape[:-1]) | (
        end_of[inorder[1:]] - inorder[1:] != end_of[inorder[:-1]] - inorder[:-1])
    name_at = np.zeros(len(s), dtype=np.int32)
    name_at[inorder] = np.cumsum(fresh) - 1
    sorted_marks = inorder
    if fresh.sum() < len(marks):
        sorted_marks = np.empty(len(marks), dtype=marks.dtype)
        sorted_marks[ordered_names(name_at[marks])] = marks
    return buckets.induced(sorted_marks)


def common_prefixes(s: np.ndarray, array: np.ndarray, limit: np.ndarray, most: int) -> np.ndarray:
    """Longest common prefix of each place with its neighbours in the array, by place.

    Prefixes end with the text, ``limit`` symbols on; lengths beyond ``most`` are not told apart.
    Halving steps compare whole stretches by their hashes.
    """
    best = np.zeros(len(s), dtype=np.int32)
    a, b = array[:-1], array[1:]
    room = np.minimum(np.minimum(limit[a], limit[b]), most)
    live = np.flatnonzero(room > 0)
    a, b, room = a[live], b[live], room[live]
    length = np.zeros(len(a), dtype=np.int32)
    step = 1 << int(most).bit_length() - 1
    sums, inverse = _prefix_sums(s)
    while step:
        fits = np.flatnonzero(length + step <= room)
        x, y = a[fits] + length[fits], b[fits] + length[fits]
        equal = (sums[x + step] - sums[x]) * inverse[x] == (sums[y + step] - sums[y]) * inverse[y]
        length[fits[equal]] += step
        step >>= 1
    best[b] = length
    np.maximum.at(best, a, length)
    return best


def _prefix_sums(s: np.ndarray):
    sums = np.zeros(len(s) + 1, dtype=np.uint64)
    np.cumsum(mixed(s.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(s)), out=sums[1:])
    return sums, powers(pow(BASE, -1, 1 << 64), len(s) + 1)


def repeated_windows(contents: list[bytes], least: list[int], search: Search) -> list[np.ndarray]:
    """Windows of distinct segments that the shard holds anywhere else."""
    lengths = np.array([len(c) + 1 for c in contents], dtype=np.int64)
    s = np.frombuffer(b"\0".join(contents) + b"\0", dtype=np.uint8).astype(np.int16) + 2
    ends = np.cumsum(lengths)
    s[ends - 1] = 1  # smaller than every byte, and no window reaches across it
    s = np.append(s, np.int16(0))
    limit = np.append(np.repeat(ends - 1, lengths) - np.arange(len(s) - 1), 0)
    limit = np.where(limit >= search.window, limit, 0)
    prefix = common_prefixes(s, suffix_array(s), limit, search.window)
    flags = prefix >= search.window
    return [flags[end - length:end - search.window]
            for end, length in zip(ends.tolist(), lengths.tolist())]


BROKEN = "\ufffd"
BY_BYTES = Search(by_words=False, window=200, anchor=64, first_stays=False,
                  index=repeated_windows)


def suffix_dedup(docs: DataFrame, search: Search = BY_BYTES, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """The documents with ``kept`` (binary: the bytes that stay), n_bytes, n_removed and n_spans.

    Null texts count as empty. Both rows of an equal pair lose their common strings, also if they
    have the same id; strings that repeat within a document count, so a very long periodic text
    goes. An empty table gives no rows.
    """
    return without_repeats(docs, search, "kept", ("n_bytes", "n_removed", "n_spans"),
                           doc_id, text)


def without_repeated_strings(docs: DataFrame, search: Search = BY_BYTES, doc_id: str = "doc_id",
                             text: str = "text") -> DataFrame:
    """The documents with their columns, the text without its repeated strings.

    Characters that a cut leaves incomplete are dropped, and with them replacement characters
    of the cut texts. A null text stays null.
    """
    names = docs.columns
    given = docs.select(*aside(docs, names), F.col(doc_id).alias("id"), F.col(text).alias("body"))
    cut = suffix_dedup(given, search, "id", "body")
    left = F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), BROKEN, "")
    changed = F.when(F.col("body").isNull() | (F.col("n_removed") == 0), F.col("body")).otherwise(left)
    return cut.select(*[changed.alias(c) if c == text else column
                        for c, column in zip(names, back(names))])
