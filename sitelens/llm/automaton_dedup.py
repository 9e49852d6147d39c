"""Substring dedup with suffix automata of reference shards.

Reference shards are made by content (``repeats``), so a document's windows only stream past the
automata that can know them.  A shard's automaton is built over the words of its segments in the
order of documents; every state remembers the first document that reached it.  The segments then
stream through it for their matching statistics: the state that holds exactly the last ``WINDOW`` words
tells the first document that has them.  Words covered by a window whose first document has a
smaller doc_id are removed.

Defined cases: a null text has no words; a null doc_id is smaller than any other; rows with one
doc_id are one document as far as "smaller" goes; texts of fewer than ``WINDOW`` words keep all; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sitelens.llm import repeats

WINDOW = 13
GRAM = 6


class SuffixAutomaton:
    """Of several word sequences, added one after the other; ``first`` is the mark of the earliest that reached a state."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.size, self.first = [-1], [0], [None]

    def _state(self, size, edges, link, first) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.size.append(size)
        self.first.append(first)
        return len(self.size) - 1

    def _split(self, p: int, q: int, word) -> int:
        """State q holds longer sequences than the edge from p allows: give the short ones a state of their own."""
        clone = self._state(self.size[p] + 1, self.next[q].copy(), self.link[q], self.first[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words, mark) -> None:
        nxt, link, size = self.next, self.link, self.size
        last = 0
        for word in words:
            q = nxt[last].get(word)
            if q is not None:
                last = q if size[q] == size[last] + 1 else self._split(last, q, word)
                continue
            new = self._state(size[last] + 1, {}, 0, mark)
            p = last
            while p >= 0 and word not in nxt[p]:
                nxt[p][word] = new
                p = link[p]
            if p >= 0:
                q = nxt[p][word]
                link[new] = q if size[q] == size[p] + 1 else self._split(p, q, word)
            last = new

    def matches(self, words, window: int):
        """For each word: the mark of the first sequence with the ``window`` words that end there, or None."""
        nxt, link, size = self.next, self.link, self.size
        state = length = 0
        out = []
        for word in words:
            while state and word not in nxt[state]:
                state = link[state]
                length = size[state]
            if word in nxt[state]:
                state = nxt[state][word]
                length += 1
                while size[link[state]] >= window:
                    state = link[state]
                    length = size[state]
            out.append(self.first[state] if length >= window else None)
        return out


def judge(segments: list[bytes], doc_ids: list[int]) -> list[np.ndarray]:
    """For every window of every segment the first of ``doc_ids`` (ascending) whose segment has it."""
    automaton = SuffixAutomaton()
    ids: dict[bytes, int] = {}
    words = [[ids.setdefault(w, len(ids)) for w in s.split()] for s in segments]
    for w, doc in zip(words, doc_ids):
        automaton.add(w, doc)
    return [np.array(automaton.matches(w, WINDOW)[WINDOW - 1:], np.int64) for w in words]


UNITS = repeats.Units(
    window=WINDOW, gram=GRAM, same_document=False,
    tokens=lambda text: text.encode("utf-8").split(),
    hashes=lambda words: np.fromiter(map(zlib.crc32, words), np.uint64, len(words)),   # equal words have to agree, no more
    cut=lambda words, a, b: b" ".join(words[a:b]), count=lambda part: part.count(b" ") + 1)

SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])


def _finish(doc_id, words, removed):
    return doc_id, len(words), int(removed.sum()), b" ".join([w for w, r in zip(words, removed.tolist()) if not r])


def remove_repeated_words(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): kept are the words that stay, joined by one blank, in UTF-8."""
    return repeats.remove_repeats(docs, UNITS, judge, _finish, SCHEMA, "doc_id long, n_words long, n_removed long, kept binary")
