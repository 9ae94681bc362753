"""Operator 1: word sequences that an earlier document has, found with suffix automata.

Each shard builds one automaton over its reference, the distinct segments in ascending order
of their smallest id, so the first end of a state is the smallest document that holds
its strings. The shard's documents are then streamed through it: at every word the
automaton knows the longest match that ends there, and cut back to the threshold length
it knows who had those words first. Windows that a smaller id has are removed.

An automaton of all documents cannot be sent to every task, and sending each shard's to all
documents would compare every document with every shard. So the automata stay in the tasks
that built them, and each gets just the stretches of the documents whose windows it can hold.
"""

import numpy as np
from pyspark.sql import DataFrame

from siftloom.llm.repeats import Search, without_repeats


class SuffixAutomaton:
    """Automaton of several word sequences, added in ascending order of their owners."""

    def __init__(self):
        self.next, self.link, self.length, self.owner = [{}], [-1], [0], [None]

    def _state(self, length, link, after, owner) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        self.owner.append(owner)
        return len(self.next) - 1

    def _split(self, state: int, word, child: int) -> int:
        """A state for the strings of ``child`` that are one longer than those of ``state``."""
        copy = self._state(self.length[state] + 1, self.link[child], dict(self.next[child]),
                           self.owner[child])
        self.link[child] = copy
        while state >= 0 and self.next[state].get(word) == child:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def add(self, words: list, owner) -> None:
        after, link, length = self.next, self.link, self.length
        last = 0
        for word in words:
            child = after[last].get(word)
            if child is not None:
                last = child if length[child] == length[last] + 1 else \
                    self._split(last, word, child)
                continue
            new = self._state(length[last] + 1, 0, {}, owner)
            state = last
            while state >= 0 and word not in after[state]:
                after[state][word] = new
                state = link[state]
            if state >= 0:
                child = after[state][word]
                link[new] = child if length[child] == length[state] + 1 else \
                    self._split(state, word, child)
            last = new

    def owners(self, words: list, width: int):
        """Who had each run of ``width`` words first, or None, in the order of the runs."""
        after, link, length = self.next, self.link, self.length
        state, matched, out = 0, 0, []
        for n, word in enumerate(words, 1):
            while state and word not in after[state]:
                state = link[state]
                matched = length[state]
            if word in after[state]:
                state = after[state][word]
                matched += 1
            while length[link[state]] >= width if state else False:
                state = link[state]
                matched = length[state]
            if n >= width:
                out.append(self.owner[state] if matched >= width else None)
        return out


def owned_earlier(contents: list[bytes], least: list[int], search: Search) -> list[np.ndarray]:
    automaton = SuffixAutomaton()
    for content, owner in zip(contents, least):
        automaton.add(content.split(), owner)
    return [np.array([first < owner for first in automaton.owners(content.split(), search.window)],
                     dtype=bool) for content, owner in zip(contents, least)]


BY_WORDS = Search(by_words=True, window=13, anchor=4, first_stays=True, index=owned_earlier)


def substring_dedup(docs: DataFrame, search: Search = BY_WORDS, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """The documents with ``kept`` (binary: the words that stay, joined by one space), n_words,
    n_removed and n_spans.

    Null texts and texts without words keep nothing and lose nothing. A null id is the smallest.
    Rows that repeat an id do not count as smaller than each other. Very long texts are cut whole,
    whatever they repeat. An empty table gives no rows.
    """
    return without_repeats(docs, search, "kept", ("n_words", "n_removed", "n_spans"),
                           doc_id, text)
