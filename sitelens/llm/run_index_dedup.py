"""Suffix-array dedup with a run-length index.

Shards of the corpus are made by content (``repeats``).  For a shard's segments, in the order of
documents, the index keeps the runs of the Burrows-Wheeler transform (letter and first row) and the
text positions at the first and last row of every run, with the length of the match across the
run's border.  Inside a run the match of a position with its neighbour in suffix order is the match
of the position before, one byte shorter and moved by one; so the samples alone give, for a stream
of positions, both neighbours and both match lengths (matching statistics).  Positions whose match is
``WINDOW`` bytes or more are chained to their neighbours, and all but the first of a chain are removed.

Defined cases: a null text is empty; a null doc_id comes before any other; rows with one doc_id are
documents one after the other, in the order of their text hash; texts shorter than ``WINDOW`` keep
all; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sitelens.llm import repeats

WINDOW = 100
GRAM = 32
COMPARED = 1 << 16


def _ascending(major: np.ndarray, minor: np.ndarray, bits: int) -> np.ndarray:
    """Places in the order of (major, minor, place).  Three numbers that fit into 64 bits are sorted as one."""
    place = np.arange(len(major))
    if 3 * bits > 64:
        return np.lexsort((place, minor, major))
    b = np.uint64(bits)
    packed = (major.astype(np.uint64) << b | minor.astype(np.uint64)) << b | place.astype(np.uint64)
    packed.sort()
    return (packed & np.uint64((1 << bits) - 1)).astype(np.int64)


def suffix_array(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Suffixes in order; ``left``: symbols up to the end of the position's string, its end mark included.

    Prefix doubling over the suffixes that are still tied.  Nothing beyond an end mark is compared;
    suffixes that are equal up to it are in the order of their strings.
    """
    n = len(text)
    bits = (n + 1).bit_length()
    wide = [text.astype(np.int64)]
    for k in (1, 2, 3):
        wide.append(np.where(left[:n - k] > k, wide[0][k:], 0) if k < n else np.zeros(0, np.int64))
        wide[k] = np.pad(wide[k], (0, n - len(wide[k])))
    major, minor = wide[0] << 9 | wide[1], wide[2] << 9 | wide[3]
    order = _ascending(major, minor, max(bits, 18))
    key = (major << 18 | minor)[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    size = len(wide)
    row = np.arange(n)                         # rows whose suffixes may still be tied
    while True:
        tied = np.zeros(len(row), bool)
        tied[1:] = ~new[row[1:]] & (row[1:] == row[:-1] + 1)
        tied[:-1] |= tied[1:]
        row = row[tied]
        at = order[row]
        more = left[at] > size
        if not more.any():
            return order
        first, second = rank[at], np.where(more, rank[np.minimum(at + size, n - 1)] + 1, 0)
        by = _ascending(first, second, bits)
        at, first, second = at[by], first[by], second[by]
        order[row] = at
        new[row[1:]] |= (second[1:] != second[:-1]) | (first[1:] != first[:-1])
        rank[at] = np.maximum.accumulate(np.where(new[row], row, -1))
        size *= 2


@dataclass
class RunIndex:
    letters: np.ndarray        # of the runs of the transform
    first_row: np.ndarray
    up: tuple                  # samples at first rows: position (ascending), neighbour above, match length
    down: tuple                # samples at last rows: position (ascending), neighbour below, match length
    n: int

    @classmethod
    def build(cls, text: np.ndarray, left: np.ndarray) -> RunIndex:
        n = len(text)
        order = suffix_array(text, left)
        letter = np.where(order > 0, text[order - 1], 0)
        border = np.ones(n + 1, bool)
        border[1:n] = (letter[1:] != letter[:-1]) | (letter[1:] == 0)     # end marks are all different
        rows = np.flatnonzero(border[:n])
        inner = rows[rows > 0]
        match = cls._match(text, left, order[inner - 1], order[inner])
        above = np.argsort(order[inner])
        below = np.argsort(order[inner - 1])
        return cls(letter[rows], rows,
                   (order[inner][above], order[inner - 1][above], match[above]),
                   (order[inner - 1][below], order[inner][below], match[below]), n)

    @staticmethod
    def _match(text, left, a, b) -> np.ndarray:
        """Length of the common beginning of suffixes, end marks not counted."""
        out = np.minimum(left[a], left[b]) - 1
        step = np.arange(16)
        for at in range(0, len(a), COMPARED):
            todo = np.arange(at, min(at + COMPARED, len(a)))
            size = np.zeros(len(todo), np.int64)
            while len(todo):
                x, y = a[todo] + size, b[todo] + size
                last = len(text) - 1
                differ = text[np.minimum(x[:, None] + step, last)] != text[np.minimum(y[:, None] + step, last)]
                differ |= (size[:, None] + step) >= out[todo][:, None]
                some = differ.any(1)
                out[todo[some]] = np.minimum(out[todo[some]], size[some] + differ[some].argmax(1))
                todo, size = todo[~some], size[~some] + 16
        return out

    @staticmethod
    def _stream(samples: tuple, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For ascending positions: neighbour and match length, from the last sample at or before each."""
        position, neighbour, match = samples
        if not len(position):
            return at.copy(), np.zeros(len(at), np.int64)
        k = np.searchsorted(position, at, "right") - 1
        moved = at - position[np.maximum(k, 0)]
        length = np.where(k >= 0, match[np.maximum(k, 0)] - moved, 0)
        return np.where(length > 0, neighbour[np.maximum(k, 0)] + moved, at), length

    def matching_statistics(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Neighbours above and below in suffix order, and the lengths of the matches with them."""
        up, up_length = self._stream(self.up, at)
        down, down_length = self._stream(self.down, at)
        return up, up_length, down, down_length

    def earliest(self, window: int) -> np.ndarray:
        """For every position the first one that starts with the same ``window`` bytes (itself, if none does)."""
        at = np.arange(self.n)
        up, up_length, down, down_length = self.matching_statistics(at)
        best = at.copy()
        for neighbour, length in ((up, up_length), (down, down_length)):
            jump, least = np.where(length >= window, neighbour, at), at.copy()
            while True:
                least = np.minimum(least, least[jump])
                further = jump[jump]
                if (further == jump).all():
                    break
                jump = further
            best = np.minimum(best, np.minimum(least, least[jump]))
        return best


def judge(segments: list[bytes], doc_ids: list[int]) -> list[np.ndarray]:
    """The windows of every segment that start earlier, too, in the order of the segments."""
    sizes = np.array([len(s) for s in segments])
    ends = np.cumsum(sizes + 1) - 1
    data = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8)
    text = data.astype(np.int16) + 1
    text[ends] = 0
    left = np.repeat(ends, sizes + 1) - np.arange(len(text)) + 1
    again = np.flatnonzero((left > WINDOW) & (RunIndex.build(text, left).earliest(WINDOW) < np.arange(len(text))))
    starts = ends - sizes
    cut = np.searchsorted(again, np.append(starts, len(text)))
    return [again[cut[k]:cut[k + 1]] - starts[k] for k in range(len(segments))]


_TABLE = np.random.default_rng(20).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)

UNITS = repeats.Units(
    window=WINDOW, gram=GRAM, same_document=True,
    tokens=lambda text: text.encode("utf-8"),
    hashes=lambda data: _TABLE[np.frombuffer(data, np.uint8)],
    cut=lambda data, a, b: data[a:b], count=len)

SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                    ("kept", pa.binary())])


def _finish(doc_id, data, removed):
    spans = int(np.count_nonzero(np.diff(removed.astype(np.int8), prepend=0) == 1))
    return doc_id, len(data), int(removed.sum()), spans, np.frombuffer(data, np.uint8)[~removed].tobytes()


def remove_repeated_bytes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): kept are the bytes that stay."""
    return repeats.remove_repeats(docs, UNITS, judge, _finish, SCHEMA,
                                  "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
