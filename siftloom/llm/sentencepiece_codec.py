"""Operator 6: exact merge-type encoding by backtracking, and decoding.

A text is cut where no piece can reach across (before a run of spaces, and between letters and
other characters if no piece has both side by side), and every word is
encoded once per task as long as a cache holds it. In a word, the longest piece that matches at
the current place is tried (one pass of an Aho-Corasick automaton finds these). It
may follow the piece before it only if merging both together again leaves these two; if it
does not, the next shorter piece is tried; if none is left, the place is marked as failed
in a bitfield and the piece before is shortened. The result is the one merging
would give, without a queue of merges for the whole text.
"""

import heapq
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftloom.llm.rows import aside, aside_schema, back, whole

SPACE = "▁"
WORDS = regex.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
# used where no piece of the model holds a letter next to another character
LETTER_WORDS = regex.compile(rf"{SPACE}*[\p{{L}}\p{{M}}]+|{SPACE}*[^\p{{L}}\p{{M}}{SPACE}]+|{SPACE}+")
ACROSS = regex.compile(rf"[\p{{L}}\p{{M}}][^\p{{L}}\p{{M}}{SPACE}]|[^\p{{L}}\p{{M}}{SPACE}][\p{{L}}\p{{M}}]")
CACHED_WORDS, CACHED_PAIRS, CACHED_LENGTH = 400_000, 1_000_000, 40


class Codec:
    """Encoder of one merge-type model; ``model`` holds the bytes of its file."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.library.get_piece_size()
        self.rank, self.bytes, self.reserved = {}, {}, set()
        automaton = ahocorasick.Automaton()
        for i in range(size):
            piece = self.library.id_to_piece(i)
            if self.library.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (self.library.is_control(i) or self.library.is_unknown(i)
                      or self.library.is_unused(i)):
                self.rank[piece] = (-self.library.get_score(i), i)
                automaton.add_word(piece, (len(piece) - 1, piece))
        automaton.make_automaton()
        self.automaton = automaton
        # the next shorter piece that starts alike; at last the first character, piece or not
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 1, -1) if p[:k] in self.rank),
                                p[0]) for p in self.rank if len(p) > 1}
        self.cut = WORDS if any(map(ACROSS.search, self.rank)) else LETTER_WORDS
        self.words, self.older, self.pairs, self.edges = {}, {}, {}, {}

    def merged(self, text: str, log: list | None = None) -> list[str]:
        """The pieces that merging the best-scored neighbours, leftmost first, ends with.

        ``log`` receives (rank, place, piece) of each merge.
        """
        parts = list(text)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []

        def offer(i):
            j = after[i]
            if j < n:
                found = self.rank.get(parts[i] + parts[j])
                if found is not None:
                    queue.append((found[0], i, parts[i], parts[j])) if not started else \
                        heapq.heappush(queue, (found[0], i, parts[i], parts[j]))

        started = False
        for i in range(n - 1):
            offer(i)
        heapq.heapify(queue)
        started = True
        while queue:
            rank, i, left, right = heapq.heappop(queue)
            j = after[i] if i < n else n
            if parts[i] != left or j >= n or parts[j] != right:
                continue
            parts[i], parts[j] = left + right, None
            if log is not None:
                log.append((rank, i, parts[i]))
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p is not None]

    def edge_parts(self, piece: str):
        """How merging builds a piece at its two ends.

        Gives (first parts, last parts), each a list of (part, rank of the merge that takes it
        in); None if merging does not give the piece, False if it does, but with ranks
        that fall on the way, so that they do not tell the order of merges.
        """
        log: list = []
        if self.merged(piece, log) != [piece]:
            return None
        ranks = [rank for rank, _, _ in log]
        if ranks != sorted(ranks):
            return False
        ends = []
        for part, at_end in ((piece[0], lambda i, p: i == 0),
                             (piece[-1], lambda i, p: i + len(p) == len(piece))):
            parts = []
            for rank, i, grown in log:
                if at_end(i, grown):
                    parts.append((part, rank))
                    part = grown
            ends.append([*parts, (part, float("inf"))])
        return ends

    def edges_of(self, piece: str):
        found = self.edges.get(piece, self)
        if found is self:
            found = self.edges[piece] = self.edge_parts(piece)
            if len(self.edges) > CACHED_PAIRS:
                self.edges.clear()
        return found

    def stands(self, piece: str) -> bool:
        """Whether merging the piece's own characters gives the piece."""
        return self.edges_of(piece) is not None

    def fits(self, left: str, right: str) -> bool:
        """Whether merging both together leaves exactly these two.

        Merges across the border are the only ones that can change the outcome: the parts that
        lie at the border at the same time are merged if that ranks before the
        merge that takes the left one in, and not after that of the right one.
        """
        key = (left, right)
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            found = self.pairs[key] = self.remerged(left, right)
        return found

    def remerged(self, left: str, right: str) -> bool:
        before, after = self.edges_of(left), self.edges_of(right)
        if before is None or after is None:
            return False
        if before is False or after is False:
            return self.merged(left + right) == [left, right]
        lasts, firsts, i, j, rank = before[1], after[0], 0, 0, self.rank
        while True:
            (last, left_until), (first, right_until) = lasts[i], firsts[j]
            across = rank.get(last + first)
            if across is not None and across[0] < left_until and across[0] <= right_until:
                return False
            if left_until <= right_until:
                i += 1
                if i == len(lasts):
                    return True
            else:
                j += 1

    def backtracked(self, word: str) -> list[str]:
        """The pieces of a word; single characters that no piece covers stand for themselves."""
        longest = list(word)
        for end, (back, piece) in self.automaton.iter(word):
            # of the pieces that start at a place, longer ones end later
            longest[end - back] = piece
        shorter, pairs, n = self.shorter, self.pairs, len(word)
        chosen, place, piece, failed = [], 0, longest[0], 0
        while True:
            if chosen:
                fits = pairs.get((chosen[-1], piece))
                if fits is None:
                    fits = self.fits(chosen[-1], piece)
            else:
                fits = self.stands(piece)
            if fits and not (failed and failed >> (place + len(piece)) & 1):
                chosen.append(piece)
                place += len(piece)
                if place == n:
                    return chosen
                piece = longest[place]
                continue
            piece = shorter[piece] if len(piece) > 1 else None
            while piece is None:
                failed |= 1 << place
                last = chosen.pop()
                place -= len(last)
                piece = shorter[last] if len(last) > 1 else None

    def ids_of(self, word: str) -> tuple[int, ...]:
        # pieces of spaces only have one score in common, so the order of merges decides
        pieces = self.merged(word) if SPACE + SPACE in word else self.backtracked(word)
        out = []
        for piece in pieces:
            found = self.rank.get(piece)
            if found is not None:
                out.append(found[1])
            else:
                out.extend(self.bytes[b] for b in piece.encode())
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        cache, out = self.words, []
        for word in self.cut.findall(SPACE + text.replace(" ", SPACE)):
            ids = cache.get(word)
            if ids is None:
                ids = self.older.get(word) or self.ids_of(word)
                if len(word) <= CACHED_LENGTH:
                    if len(cache) >= CACHED_WORDS:
                        self.older, self.words = cache, {}
                        cache = self.words
                    cache[word] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids) if ids else ""


def encode_documents(docs: DataFrame, model: bytes, text: str = "text",
                     ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """The documents with ``token_ids`` and the text they decode to.

    Null texts count as empty and have no ids. Columns of the input with these names are
    replaced. Each row is independent, so repeated rows give equal results. Very long texts are
    encoded whole; an empty table gives no rows.
    """
    model = bytes(model)
    kept = [c for c in docs.columns if c not in (ids, decoded)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                coded = [codec.encode(t) for t in part.column("_text").to_pylist()]
                decodings = [codec.decode(i) for i in coded]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(f"__{i}") for i in range(len(kept))],
                     pa.array(coded, pa.list_(pa.int32())), pa.array(decodings, pa.string())],
                    names=[*[f"__{i}" for i in range(len(kept))], "_ids", "_decoded"])

    schema = ", ".join([*filter(None, [aside_schema(docs, kept)]),
                        "_ids array<int>, _decoded string"])
    coded = docs.select(*aside(docs, kept), whole(text).alias("_text")).mapInArrow(run, schema)
    return coded.select(*back(kept), F.col("_ids").alias(ids), F.col("_decoded").alias(decoded))
