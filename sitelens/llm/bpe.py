"""Byte-level BPE by monoid tree reduction.

A piece's halves are encoded recursively and joined: the bytes around the seam are encoded again in
a window that grows until the tokens outside it provably stay.  The proof is pairwise: a sequence of
BPE outputs is the encoding of its concatenation exactly when every two neighbours, encoded
together, give those two tokens back.  Inside each half that already holds, so only the two edges of
the window are asked.  Decoding concatenates the tokens' bytes up a tree.

Defined cases: a null text is empty; an empty text has no ids; repeated rows are encoded each on its
own; ids that no rank has raise an error in ``decode``; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from functools import cached_property, lru_cache
from itertools import chain, islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm import common

LEAF = 16            # bytes of a leaf of the encoding tree
FANOUT = 256         # children of a node of the decoding tree
CACHED_PAIRS = 150_000
CACHED_BYTES = 64 << 20      # of each of the three caches: nodes, pieces, cuts
ENTRY_BYTES = 250            # of an entry besides its text and ids
LONGEST_CUT = 1024           # characters; a longer one is matched piece by piece and not remembered
PIECES_AT_ONCE = 1 << 16
TEXTS_AT_ONCE = 512
CHARACTERS_AT_ONCE = 4 << 20
NO_PAIR = np.uint64((1 << 64) - 1)


def parse_ranks(blob: bytes) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: one base64 token and its rank a line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in blob.splitlines() if line)}


class TreeBpe:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.none = max(ranks.values(), default=0) + 1
        self.token = {i: b for b, i in ranks.items()}
        self._nodes: dict[bytes, list[int]] = {}
        self._nodes_bytes = 0
        self._stable: dict[tuple[int, int], bool] = {}

    def merge(self, data: bytes) -> list[int]:
        """The plain definition: merge the neighbours of lowest rank, leftmost first, until none is left."""
        return self._merge_heap(data) if len(data) > 48 else self._merge_list(data)

    def _merge_list(self, data: bytes) -> list[int]:
        ranks, none = self.ranks, self.none
        parts = [data[i:i + 1] for i in range(len(data))]
        pair = [ranks.get(data[i:i + 2], none) for i in range(len(data) - 1)]
        while pair and (low := min(pair)) != none:
            i = pair.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pair[i]
            if i < len(pair):
                pair[i] = ranks.get(parts[i] + parts[i + 1], none)
            if i:
                pair[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        return [ranks[p] for p in parts]

    def _merge_heap(self, data: bytes) -> list[int]:
        ranks, n = self.ranks, len(data)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))    # the part at i ends at nxt[i]
        alive = [True] * n
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = nxt[i]
            if not alive[i] or j >= n or nxt[j] - i != size:
                continue                       # one of the two parts has changed meanwhile
            alive[j] = False
            k = nxt[i] = nxt[j]
            if k < n:
                prv[k] = i
                if (r := ranks.get(data[i:nxt[k]])) is not None:
                    heapq.heappush(heap, (r, i, nxt[k] - i))
            if (p := prv[i]) >= 0 and (r := ranks.get(data[p:k])) is not None:
                heapq.heappush(heap, (r, p, k - p))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i:nxt[i]]])
            i = nxt[i]
        return out

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """An open hash table of all pairs of tokens that merge: their key and the merged token."""
        keys, merged = [], []
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                a, b = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    merged.append(rank)
        size = 1 << max(4, (4 * len(keys)).bit_length())
        table, value = np.full(size, NO_PAIR), np.zeros(size, np.int64)
        todo, key, val = np.arange(len(keys)), np.array(keys, np.uint64), np.array(merged, np.int64)
        slot = self._slot(key, size)
        while len(todo):
            at = slot[todo]
            free = table[at] == NO_PAIR
            table[at[free]], value[at[free]] = key[todo[free]], val[todo[free]]   # of two, the last one stays
            todo = todo[table[at] != key[todo]]
            slot[todo] = (slot[todo] + 1) % size
        return table, value

    @staticmethod
    def _slot(key: np.ndarray, size: int) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - size.bit_length())).astype(np.int64)

    def _merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens the token they merge to, or ``none``."""
        table, value = self.pairs
        key = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        slot = self._slot(key, len(table))
        out = np.full(key.shape, self.none, np.int64)
        found = table[slot]
        hit = found == key
        out[hit] = value[slot[hit]]
        todo = np.nonzero(~hit & (found != NO_PAIR))
        while len(todo[0]):
            slot[todo] = at = (slot[todo] + 1) % len(table)
            found = table[at]
            hit = found == key[todo]
            out[tuple(t[hit] for t in todo)] = value[at[hit]]
            todo = tuple(t[~hit & (found != NO_PAIR)] for t in todo)
        return out

    def merge_many(self, leaves: list[bytes]) -> list[list[int]]:
        """``merge`` of many short strings, one merge of every string at a time."""
        n, width = len(leaves), max(map(len, leaves))
        lens = np.fromiter(map(len, leaves), np.int64, n)
        single = np.array([self.ranks.get(bytes([i]), self.none) for i in range(256)])
        ids = single[np.frombuffer(b"".join(x.ljust(width, b"\0") for x in leaves), np.uint8).reshape(n, width)]
        columns = np.arange(width + 1)
        ids = np.concatenate([np.where(columns[:width] < lens[:, None], ids, self.none), np.full((n, 1), self.none)], 1)
        rank = np.concatenate([self._merged(ids[:, :-1], ids[:, 1:]), np.full((n, 1), self.none)], 1)
        out: list = [None] * n
        at = np.arange(n)
        while True:
            m = rank.argmin(1)
            low = rank[np.arange(len(at)), m]
            going = low < self.none
            for k in np.flatnonzero(~going):
                out[at[k]] = ids[k, :lens[k]].tolist()
            if not going.any():
                return out
            at, m, low, lens = at[going], m[going], low[going], lens[going] - 1
            shifted = np.minimum(columns + (columns > m[:, None]), width)
            ids = np.take_along_axis(ids[going], shifted, 1)
            rank = np.take_along_axis(rank[going], shifted, 1)
            rows = np.arange(len(at))
            ids[rows, m] = low
            rank[rows, m] = self._merged(low, ids[rows, m + 1])
            before = m > 0
            rank[rows[before], m[before] - 1] = self._merged(ids[rows[before], m[before] - 1], low[before])

    def prepare(self, pieces: list[bytes]) -> None:
        """Encode the leaves of many pieces at once, so that ``tree`` finds them."""
        self._trim()
        leaves = {leaf for p in pieces for leaf in (self._leaves(p) if len(p) > LEAF else (p,)) if len(leaf) > 1}
        leaves = sorted(leaves.difference(self._nodes), key=len)
        for k in range(0, len(leaves), 8192):
            some = leaves[k:k + 8192]
            ids = self.merge_many(some)
            self._nodes.update(zip(some, ids))
            self._nodes_bytes += len(some) * ENTRY_BYTES + sum(map(len, some)) + 36 * sum(map(len, ids))

    def _trim(self) -> None:
        if self._nodes_bytes >= CACHED_BYTES:
            self._nodes.clear()
            self._nodes_bytes = 0

    def _leaves(self, data: bytes) -> list[bytes]:
        return [data[k:k + LEAF] for k in range(0, len(data), LEAF)]

    def stable(self, a: int, b: int) -> bool:
        """Encoded together, the neighbours a and b give a and b again."""
        known = self._stable.get((a, b))
        if known is None:
            if len(self._stable) >= CACHED_PAIRS:
                self._stable.clear()
            known = self._stable[a, b] = self.merge(self.token[a] + self.token[b]) == [a, b]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        i, j, step = len(left) - 1, 1, 1
        while True:
            window = self.merge(b"".join(self.token[t] for t in left[i:] + right[:j]))
            fixed_left = i == 0 or self.stable(left[i - 1], window[0])
            fixed_right = j == len(right) or self.stable(window[-1], right[j])
            if fixed_left and fixed_right:
                return left[:i] + window + right[j:]
            if not fixed_left:
                i = max(0, i - step)
            if not fixed_right:
                j = min(len(right), j + step)
            step *= 2

    def tree(self, data: bytes) -> list[int]:
        """Leaves are encoded plainly; short nodes, which many words share, are remembered."""
        known = self._nodes.get(data)
        if known is not None:
            return known
        if len(data) <= LEAF:
            out = self.merge(data)
        else:
            half = LEAF << max(0, (len(data) - 1).bit_length() - LEAF.bit_length())   # whole leaves to the left
            out = self.join(self.tree(data[:half]), self.tree(data[half:]))
        if len(data) <= 2 * LEAF:
            self._trim()
            self._nodes[data] = out
            self._nodes_bytes += ENTRY_BYTES + len(data) + 36 * len(out)
        return out

    def piece(self, data: bytes) -> list[int]:
        """A piece that is itself a token is that token; every other piece goes through the tree."""
        whole = self.ranks.get(data)
        return self.tree(data) if whole is None else [whole]

    def decode(self, ids: list[int]) -> bytes:
        parts = list(map(self.token.__getitem__, ids))
        while len(parts) > 1:
            parts = [b"".join(parts[k:k + FANOUT]) for k in range(0, len(parts), FANOUT)]
        return parts[0] if parts else b""


class Encoder:
    """Whole texts to ids.

    A match of the pattern never runs over a blank that stands alone between two other characters:
    it ends before that blank.  Texts are therefore cut there, and the ids of a cut are remembered,
    up to ``CACHED_BYTES``.  Text without blanks, as many scripts write it, makes long cuts: it is matched
    piece by piece.
    That needs every alternative of the pattern to take white space only in front; ``encode`` says so.
    """

    def __init__(self, blob: bytes, pattern: str):
        import regex
        self.bpe = TreeBpe(parse_ranks(blob))
        self.find = regex.compile(pattern)
        self.piece: dict[str, bytes] = {}
        self.cut: dict[str, bytes | None] = {}     # None: it begins or ends with white space
        self.piece_bytes = self.cut_bytes = 0

    def _learn(self, pieces: set[str]) -> None:
        if self.piece_bytes >= CACHED_BYTES:
            self.piece.clear()
            self.piece_bytes = 0
        data = {p: p.encode("utf-8") for p in pieces.difference(self.piece)}
        self.bpe.prepare([d for d in data.values() if d not in self.bpe.ranks])
        for p, d in data.items():
            self.piece[p] = ids = array("I", self.bpe.piece(d)).tobytes()
            self.piece_bytes += ENTRY_BYTES + 2 * len(d) + len(ids)

    def _learn_cuts(self, cuts: set[str], firsts: set[str]) -> None:
        """``firsts``: texts' beginnings, which no blank precedes; they are kept with a blank behind."""
        if self.cut_bytes >= CACHED_BYTES:
            self.cut.clear()
            self.cut_bytes = 0
        found = {c: None if not c or c[0].isspace() or c[-1].isspace() else self.find.findall(" " + c)
                 for c in cuts.difference(self.cut)}
        found |= {f: None if f == " " or f[-2].isspace() else self.find.findall(f[:-1]) for f in firsts}
        self._learn({p for m in found.values() if m for p in m})
        for c, m in found.items():
            self.cut[c] = ids = m and b"".join([self.piece[p] for p in m])
            self.cut_bytes += ENTRY_BYTES + 4 * len(c) + len(ids or b"")

    def _matches(self, text: str) -> bytes:
        """Match by match, at most ``PIECES_AT_ONCE`` of them at a time."""
        matches, out = (m.group() for m in self.find.finditer(text)), []
        while some := list(islice(matches, PIECES_AT_ONCE)):
            self._learn(set(some))
            out += map(self.piece.__getitem__, some)
        return b"".join(out)

    def batch(self, texts: list[str]) -> list[bytes]:
        cuts = [t.split(" ") for t in texts]
        for c in cuts:
            c[0] += " "
        firsts = {c[0] for c in cuts if len(c[0]) <= LONGEST_CUT}
        others = {c for c in set(chain.from_iterable(cuts)).difference(firsts) if len(c) <= LONGEST_CUT}
        self._learn_cuts(others, firsts)
        out = []
        for text, cut in zip(texts, cuts):
            ids = list(map(self.cut.get, cut))
            out.append(self._matches(text) if None in ids else b"".join(ids))
        return out


def slices(texts: list[str]):
    """(from, to): at most ``TEXTS_AT_ONCE`` texts and, but for a single longer one, ``CHARACTERS_AT_ONCE`` characters."""
    start = size = 0
    for k, text in enumerate(texts):
        if k > start and (k - start == TEXTS_AT_ONCE or size + len(text) > CHARACTERS_AT_ONCE):
            yield start, k
            start, size = k, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


@lru_cache(maxsize=1)
def worker_encoder(blob: bytes, pattern: str) -> Encoder:
    """One for each Python worker; it outlives a task, and so do the remembered pieces."""
    return Encoder(blob, pattern)


ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
TOKEN_LISTS = pa.schema([("doc_id", pa.int64()), ("token_ids", pa.list_(pa.int32())), ("decoded_sha256", pa.string())])
DECODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])


def broadcast_ranks(spark: SparkSession, path: str):
    """The rank file, read by the driver from ``path`` and sent once; a vocabulary's size is fixed, not the data's."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def decoded_digests(bpe: TreeBpe, values: np.ndarray, ends: np.ndarray) -> list[str]:
    """SHA-256 of the decoded bytes of each list of ids; lists lie in ``values`` from one of ``ends`` to the next."""
    return [hashlib.sha256(bpe.decode(values[a:b].tolist())).hexdigest() for a, b in pairwise(ends)]


def encode(docs: DataFrame, ranks_path: str, pattern: str, lists: bool = False) -> DataFrame:
    """(doc_id, ids): each match of ``pattern`` in a whole text encoded on its own; ids as little-endian uint32.

    With ``lists`` the second column is token_ids array<int> instead, for training jobs that read Parquet,
    and a third, decoded_sha256, is the digest of the bytes that ``decode`` makes of those ids.
    The pattern must cover every character and, as the usual splitting patterns do, take a blank only
    as the first character of a match or inside a match that is all white space.
    """
    blob = broadcast_ranks(common.session(docs), ranks_path)

    def task(batches):
        encoder = worker_encoder(blob.value, pattern)
        for ids, texts in common.arrow_rows(batches, ("doc_id", "text")):
            for a, b in slices(texts):
                packed = encoder.batch(texts[a:b])
                if not lists:
                    yield common.record_batch(ENCODED, ids[a:b], packed)
                else:
                    ends = np.cumsum([0] + [len(p) // 4 for p in packed], dtype=np.int32)
                    values = np.frombuffer(b"".join(packed), "<i4")
                    yield common.record_batch(TOKEN_LISTS, ids[a:b],
                                              pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                                              decoded_digests(encoder.bpe, values, ends))

    ddl = "doc_id long, token_ids array<int>, decoded_sha256 string" if lists else "doc_id long, ids binary"
    return common.id_text(docs).mapInArrow(task, ddl)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, ids, decoded): the bytes of the ids, concatenated up a tree."""
    blob = broadcast_ranks(common.session(encoded), ranks_path)

    def task(batches):
        bpe = TreeBpe(parse_ranks(blob.value))
        for ids, packed in common.arrow_rows(batches, ("doc_id", "ids")):
            yield common.record_batch(DECODED, ids, packed, [
                bpe.decode(np.frombuffer(p or b"", "<u4").tolist()) for p in packed])

    return encoded.select("doc_id", "ids").mapInArrow(task, "doc_id long, ids binary, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
