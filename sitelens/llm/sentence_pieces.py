"""SentencePiece BPE encoding that keeps offsets, and decoding.

A text is normalised by the longest prefix that the model's compiled character map has; every byte of the
normalised text remembers the byte of the source it came from, so each piece is projected to a span of original
bytes.  The normalised text is cut wherever no piece holds the two characters at the cut (a merge can never
reach over it), and each segment is merged by score, leftmost first.  A segment's pieces are remembered in a
cache that is bounded in bytes.

Defined cases: a null or empty text has no ids; repeated rows are encoded each on its own; a character that no piece
has becomes its bytes, the last of which carries the whole span; ids outside the vocabulary raise an error in
``decode``; other columns of the input are ignored.  A run that no cut splits, such as one letter repeated for
megabytes, is merged as a whole in memory in proportion to it.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections import Counter
from functools import lru_cache
from itertools import accumulate, chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm import common

SPACE = "▁"
REPLACEMENT = "�"
CACHE_BYTES = 160 << 20
ENTRY_BYTES = 320             # of a cached segment, besides its text and pieces
SHORT = 32                    # characters of segments that are merged together
MERGED_AT_ONCE = 8192
TEXTS_AT_ONCE, CHARS_AT_ONCE = 256, 1 << 20
LONG_TEXT, SEGMENTS_AT_ONCE = 1 << 20, 1 << 16
EMPTY = np.uint64((1 << 64) - 1)
# Fixed values of the model format: types of pieces, and field numbers.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
MODEL_TYPE, BPE, SUFFIX, BYTE_FALLBACK, UNK_SURFACE = 3, 2, 24, 35, 44
CHARSMAP, DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE = 2, 3, 4, 5


def fields(message: bytes) -> list[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol-buffer message: varints as int, others as bytes."""
    out, at = [], 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            out.append((tag >> 3, varint()))
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        out.append((tag >> 3, message[at:at + size]))
        at += size
    return out


class CharacterMap:
    """The compiled character map: a double-array trie whose values point at replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.texts = blob[4 + size:] if size else b""
        self.starts: set[int] = {b for b in range(256) if self.units and self._step(self._offset(self.units[0]), b) is not None}

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def _step(self, node: int, byte: int) -> int | None:
        at = node ^ byte
        return at if at < len(self.units) and self.units[at] & 0x800000FF == byte else None

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest prefix of ``data`` from ``at`` that the map has, and that prefix's length."""
        if not self.units or data[at] not in self.starts:
            return None
        node, found = self._offset(self.units[0]), None
        for k in range(at, len(data)):
            step = self._step(node, data[k])
            if step is None:
                break
            unit = self.units[step]
            node = step ^ self._offset(unit)
            if unit >> 8 & 1:
                found = self.units[node] & 0x7FFFFFFF, k + 1 - at
        if found is None:
            return None
        return self.texts[found[0]:self.texts.index(0, found[0])], found[1]


class Normalizer:
    """Normalised text with the source byte of each of its bytes."""

    def __init__(self, charsmap: bytes, dummy_prefix: bool, remove_extra: bool, escape: bool, suffix: bool, symbols: list[str]):
        self.map = CharacterMap(charsmap)
        self.dummy_prefix, self.remove_extra, self.suffix = dummy_prefix, remove_extra, suffix
        self.space = SPACE.encode() if escape else b" "
        self.symbols = symbols and re.compile(b"|".join(re.escape(s.encode()) for s in sorted(symbols, key=len, reverse=True)))
        self.plain = not (self.map.units or remove_extra or suffix or symbols) and dummy_prefix and escape

    def _parts(self, data: bytes):
        """(replacement, start, length) of every part of the source, longest prefix first."""
        at = 0
        while at < len(data):
            symbol = self.symbols.match(data, at) if self.symbols else None
            if symbol:
                yield symbol.group(), at, len(symbol.group())
                at = symbol.end()
                continue
            found = self.map.longest(data, at)
            if found is None:
                size = 1
                while at + size < len(data) and data[at + size] & 0xC0 == 0x80:
                    size += 1
                found = data[at:at + size], size
            yield found[0], at, found[1]
            at += found[1]

    def normalize(self, text: str) -> tuple[bytes, list[int]]:
        """The normalised bytes, and for each of them and for the end the place in the source's bytes."""
        data = text.encode()
        out, source = bytearray(), []

        def put(piece: bytes, at: int) -> None:
            out.extend(piece)
            source.extend([at] * len(piece))

        after_space, begun, end = self.remove_extra, False, 0
        for part, at, size in self._parts(data):
            if self.remove_extra and not begun and part == b" ":
                end = at + size
                continue
            if not begun:
                begun = True
                if self.dummy_prefix and not self.suffix:
                    put(self.space, at)
            if after_space:
                part = part.lstrip(b" ")
            if part:
                put(part.replace(b" ", self.space), at)
            if self.remove_extra:
                after_space = part.endswith(b" ") if part else after_space
            end = at + size
        while self.remove_extra and out.endswith(self.space):
            end = source[-len(self.space)]
            del out[-len(self.space):], source[-len(self.space):]
        if begun and self.dummy_prefix and self.suffix:
            put(self.space, end)
        return bytes(out), source + [end]


class PairTable:
    """All pairs of symbols that merge, in an open hash table, so that many short strings are merged at once.

    Symbols are numbered by score, best first, so that the least number of a row's merged pairs is its best one; a
    character that is no piece comes behind them, as the number of pieces plus its code point.  Scores must differ (``_scores_differ``).
    """

    def __init__(self, pieces: list[str], ids: dict[str, int], cost: dict[str, float]):
        n = self.size = len(ids)
        best = sorted(ids, key=cost.__getitem__)
        number = {p: k for k, p in enumerate(best)}
        self.ids = np.array([ids[p] for p in best], "<i4")
        self.sizes = np.array([min(65535, len(p.encode()) - 2 * p.count(SPACE)) for p in best], "<u2")
        self.symbol = np.arange(n, n + 0x110000, dtype=np.int32)
        for p, k in number.items():
            if len(p) == 1:
                self.symbol[ord(p)] = k
        self.none = np.int32(n + 0x110000)
        of = lambda p: number.get(p, n + ord(p) if len(p) == 1 else None)
        pairs = {(a << 32 | b): k for p, k in number.items() for j in range(1, len(p))
                 if (a := of(p[:j])) is not None and (b := of(p[j:])) is not None}
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys, self.merged = np.full(1 << self.bits, EMPTY), np.full(1 << self.bits, self.none, np.int32)
        key, value = np.array(list(pairs), np.uint64), np.array(list(pairs.values()), np.int32)
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            free = todo[self.keys[slot[todo]] == EMPTY]
            self.keys[slot[free]], self.merged[slot[free]] = key[free], value[free]
            todo = todo[self.keys[slot[todo]] != key[todo]]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """What two symbols merge to, or ``none``."""
        key = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where(found == key, self.merged[slot], self.none)
        todo = np.flatnonzero((found != key) & (found != EMPTY))
        while len(todo):
            slot[todo] = at = (slot[todo] + 1) & ((1 << self.bits) - 1)
            found = self.keys[at]
            hit = found == key[todo]
            out[todo[hit]] = self.merged[at[hit]]
            todo = todo[~hit & (found != EMPTY)]
        return out

    def merge_many(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all strings behind each other, and how many each has; every round merges one pair of every string.

        A blank counts as the mark that normalisation makes of it.  Each round makes the rows one symbol shorter.
        """
        n, width = len(strings), max(map(len, strings))
        left = np.fromiter(map(len, strings), np.int64, n)
        codes = np.frombuffer("".join([x.ljust(width) for x in strings]).replace(" ", SPACE).encode("utf-32-le"), "<u4").reshape(n, width)
        ids = self.symbol[codes]
        columns = np.arange(width)
        merged = np.full((n, width), self.none)
        merged[:, :-1] = self.pair(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        merged[columns >= left[:, None] - 1] = self.none
        done, rows, count = ids.copy(), np.arange(n), left.copy()
        while len(rows):
            line, at = np.arange(len(rows)), merged.argmin(1)
            whole = merged[line, at]
            going = whole < self.none
            if not going.all():
                stay = rows[~going]
                done[stay, :ids.shape[1]], left[stay] = ids[~going], count[~going]
                rows, ids, merged, at, count, whole = rows[going], ids[going], merged[going], at[going], count[going], whole[going]
                if not len(rows):
                    break
                line = np.arange(len(rows))
            width = ids.shape[1] - 1
            kept = columns[:width + 1] != at[:, None] + 1
            ids, merged, count = ids[kept].reshape(-1, width), merged[kept].reshape(-1, width), count - 1
            ids[line, at] = whole
            merged[line, at] = np.where(at + 1 < count, self.pair(whole, ids[line, np.minimum(at + 1, width - 1)]), self.none)
            some = np.flatnonzero(at)
            merged[some, at[some] - 1] = self.pair(ids[some, at[some] - 1], whole[some])
        return done[columns < left[:, None]], left


class Model:
    """A SentencePiece BPE model, read from its file."""

    def __init__(self, blob: bytes):
        parts: dict[int, list] = {}
        for number, value in fields(blob):
            parts.setdefault(number, []).append(value)
        trainer = dict(fields(parts.get(TRAINER, [b""])[0]))
        norm = dict(fields(parts.get(NORMALIZER, [b""])[0]))
        if trainer.get(MODEL_TYPE, 1) != BPE:
            raise ValueError("not a BPE model")
        self.pieces, self.kinds, scores = [], [], []
        for p in map(dict, map(fields, parts[PIECES])):
            self.pieces.append(p.get(PIECE_TEXT, b"").decode())
            self.kinds.append(p.get(PIECE_TYPE, NORMAL))
            scores.append(struct.unpack("<f", p.get(PIECE_SCORE, bytes(4)))[0])
        self.fallback = bool(trainer.get(BYTE_FALLBACK, 0))
        self.unk = self.kinds.index(UNKNOWN)
        self.unk_surface = trainer.get(UNK_SURFACE, " ⁇ ".encode()).decode()
        symbols = [p for p, k in zip(self.pieces, self.kinds) if k == USER_DEFINED]
        self.normalizer = Normalizer(norm.get(CHARSMAP, b""), bool(norm.get(DUMMY_PREFIX, 1)), bool(norm.get(REMOVE_EXTRA, 1)),
                                     bool(norm.get(ESCAPE, 1)), bool(trainer.get(SUFFIX, 0)), symbols)
        self.strips_first = self.normalizer.dummy_prefix or self.normalizer.remove_extra
        self.symbols = symbols and re.compile("(" + "|".join(map(re.escape, sorted(symbols, key=len, reverse=True))) + ")")
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in (NORMAL, USER_DEFINED, UNUSED)}
        self.cost = {p: -scores[i] for p, i in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.pairs = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.by_spaces = not any(p[1] == SPACE and p[0] != SPACE for p in self.pairs)
        self.surface = [b"" if k == CONTROL else self.unk_surface.encode() if k == UNKNOWN else bytes([int(p[3:5], 16)]) if k == BYTE
                        else p.replace(SPACE, " ").encode() for p, k in zip(self.pieces, self.kinds)]
        self.raw = {i for i, k in enumerate(self.kinds) if k == BYTE}
        self.control = {i for i, k in enumerate(self.kinds) if k == CONTROL}
        self.is_control = np.array(self.kinds) == CONTROL
        self.quick = self.normalizer.plain and self.by_spaces and self.fallback and UNUSED not in self.kinds \
            and self._scores_differ()
        self.table = PairTable(self.pieces, self.ids, self.cost)
        self.cache: dict[str, tuple[bytes, bytes]] = {}
        self.cached = 0

    def _scores_differ(self) -> bool:
        """Of all pieces that a merge can make, but for runs of blanks, which ``learn`` leaves to ``merge``."""
        made = [c for p, c in self.cost.items() if len(p) > 1]
        runs = {c for p, c in self.cost.items() if len(p) > 1 and not p.strip(SPACE)}
        return all(n == 1 or c in runs for c, n in Counter(made).items()) and \
            runs.isdisjoint(c for p, c in self.cost.items() if len(p) > 1 and p.strip(SPACE))

    # -------------------------------------------------------------- encoding

    def merge(self, segment: str) -> list[str]:
        """The pair of neighbours of the best score is merged, the leftmost of several, until none is a piece."""
        cost, n = self.cost, len(segment)
        part = list(segment)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        made: dict[str, tuple[str, str]] = {}
        heap: list = []

        def offer(i: int, j: int) -> None:
            both = part[i] + part[j]
            if both in cost:
                heapq.heappush(heap, (cost[both], i, j, len(both)))
                if self.kinds[self.ids[both]] == UNUSED:
                    made[both] = part[i], part[j]

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, size = heapq.heappop(heap)
            if not part[i] or not part[j] or len(part[i]) + len(part[j]) != size or following[i] != j:
                continue
            part[i] += part[j]
            part[j] = ""
            k = following[i] = following[j]
            if k < n:
                before[k] = i
                offer(i, k)
            if before[i] >= 0:
                offer(before[i], i)
        out = [p for p in part if p]

        def parts_of(p: str) -> list[str]:
            return list(chain.from_iterable(map(parts_of, made[p]))) if p in made else [p]

        return list(chain.from_iterable(map(parts_of, out))) if made else out

    def cuts(self, text: str) -> list[str]:
        """The text, cut between characters that stand beside each other in no piece."""
        at = [0, *[k + 1 for k in range(len(text) - 1) if text[k:k + 2] not in self.pairs], len(text)]
        return [text[a:b] for a, b in zip(at, at[1:])] if text else []

    def _numbers(self, piece: str) -> tuple[list[int], list[int]]:
        """Ids of a piece and the normalised bytes that each of them covers."""
        data = piece.encode()
        known = self.ids.get(piece)
        if known is not None:
            return [known], [len(data)]
        if self.fallback:
            return [self.bytes[b] for b in data], [0] * (len(data) - 1) + [len(data)]
        return [self.unk], [len(data)]

    def encode_normalized(self, text: str) -> tuple[list[int], list[int]]:
        """Ids, and the normalised bytes that each covers; neighbours without a piece are one unknown."""
        ids: list[int] = []
        sizes: list[int] = []
        for k, part in enumerate(self.symbols.split(text) if self.symbols else [text]):
            pieces = [part] if k % 2 else [p for cut in self.cuts(part) for p in (self.merge(cut) if len(cut) > 1 else [cut])]
            for piece in pieces:
                i, s = self._numbers(piece)
                if i == [self.unk] and ids and ids[-1] == self.unk:
                    sizes[-1] += s[0]
                else:
                    ids += i
                    sizes += s
        return ids, sizes

    def _keep(self, segment: str, ids: bytes, sizes: bytes) -> None:
        self.cached += ENTRY_BYTES + 4 * len(segment) + len(ids) + len(sizes)
        self.cache[segment] = ids, sizes

    def learn(self, segments: set[str]) -> None:
        """Packed ids and source bytes a piece of segments (blanks and what follows them, as a plainly normalised text has them)."""
        if self.cached > CACHE_BYTES:
            self.cache.clear()
            self.cached = 0
        new = segments.difference(self.cache)
        short = sorted([s for s in new if len(s) <= SHORT and "  " not in s], key=len)
        for k in range(0, len(short), MERGED_AT_ONCE):
            self._learn_short(short[k:k + MERGED_AT_ONCE])
        for segment in new.difference(short):
            ids, sizes = self.encode_normalized(segment.replace(" ", SPACE))
            sizes = [s - 2 * self.pieces[i].count(SPACE) for s, i in zip(sizes, ids)]
            self._keep(segment, np.array(ids, "<i4").tobytes(), np.array(sizes, "<u2").tobytes())

    def _learn_short(self, segments: list[str]) -> None:
        table = self.table
        found, counts = table.merge_many(segments)
        ends = counts.cumsum()
        odd = set(np.searchsorted(ends, np.flatnonzero(found >= table.size), side="right").tolist())
        known = np.minimum(found, table.size - 1)
        ids, sizes = table.ids[known].tobytes(), table.sizes[known].tobytes()
        begin = 0
        for k, (segment, end) in enumerate(zip(segments, ends.tolist())):
            if k in odd:
                numbers, widths = [], []
                for symbol in found[begin:end].tolist():
                    i, size = ([int(table.ids[symbol])], [int(table.sizes[symbol])]) if symbol < table.size else self._numbers(chr(symbol - table.size))
                    numbers += i
                    widths += size
                self._keep(segment, np.array(numbers, "<i4").tobytes(), np.array(widths, "<u2").tobytes())
            else:
                self._keep(segment, ids[4 * begin:4 * end], sizes[2 * begin:2 * end])
            begin = end

    def _joined(self, segments: list[str]) -> tuple[bytes, bytes]:
        found = list(map(self.cache.__getitem__, segments))
        return b"".join([f[0] for f in found]), b"".join([f[1] for f in found])

    def _in_parts(self, text: str) -> tuple[bytes, bytes]:
        """A long text, some segments at a time."""
        matches, out = (m.group() for m in SEGMENT.finditer(" " + text)), []
        while some := list(islice(matches, SEGMENTS_AT_ONCE)):
            self.learn(set(some))
            out.append(self._joined(some))
        return b"".join([f[0] for f in out]), b"".join([f[1] for f in out])

    def batch(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids, and where each piece ends in the text's bytes; it starts where the one before ends."""
        plain = [self.quick and SPACE not in t for t in texts]
        segments = [SEGMENT.findall(" " + t) if p and 0 < len(t) <= LONG_TEXT else [] for t, p in zip(texts, plain)]
        self.learn(set(chain.from_iterable(segments)))
        packed = [self._joined(s) if s else None for s in segments]      # before another text's parts may clear the cache
        out = []
        for text, is_plain, found in zip(texts, plain, packed):
            if is_plain and len(text) > LONG_TEXT:
                found = self._in_parts(text)
            out.append(self._any(text) if found is None else
                       (np.frombuffer(found[0], "<i4"), np.frombuffer(found[1], "<u2").cumsum(dtype=np.int32) - 1))
        return out

    def _any(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        data, source = self.normalizer.normalize(text)
        ids, sizes = self.encode_normalized(data.decode())
        return np.array(ids, np.int32), np.array([source[k] for k in accumulate(sizes)], np.int32)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return self.batch([text])[0]

    # -------------------------------------------------------------- decoding

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        if len(ids) and ids.min() < 0:
            raise IndexError("ids are not negative")
        plain = not self.is_control[ids].any()
        ids = ids.tolist()
        parts = list(map(self.surface.__getitem__, ids))
        seen = False
        for k, i in enumerate(ids):          # the first piece loses the blank that encoding put before the text
            if i in self.raw:
                break
            if self.strips_first and not seen and i not in self.control and i != self.unk and parts[k][:1] == b" ":
                parts[k] = parts[k][1:]
                seen = not self.normalizer.remove_extra
            if seen or parts[k]:
                break
        if not plain:
            return self._decode_runs(ids, parts)
        try:
            return b"".join(parts).decode()
        except UnicodeDecodeError:
            return self._decode_runs(ids, parts)

    def _decode_runs(self, ids: list[int], parts: list[bytes]) -> str:
        out, run = [], bytearray()
        for i, part in zip(ids, parts):
            if i in self.raw:
                run += part
            else:
                out.append(run.decode(errors="bytewise"))
                run.clear()
                out.append(part.decode())
        return "".join(out) + run.decode(errors="bytewise")


#: Blanks with the word behind them.
SEGMENT = re.compile(" *[^ ]+| +")


def _bytewise(error):
    """One replacement character for each byte that is not part of a character."""
    return REPLACEMENT, error.start + 1


def _register() -> None:
    import codecs
    codecs.register_error("bytewise", _bytewise)


_register()


@lru_cache(maxsize=1)
def worker_model(blob: bytes) -> Model:
    """One for each Python worker; it outlives a task, and so do the remembered segments."""
    return Model(blob)


ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])
DECODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def broadcast_model(spark: SparkSession, path: str):
    """The model file, read by the driver and sent once; a vocabulary's size is fixed, not the data's."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *values]).astype(np.int32)))


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, ends): ids of every whole text, and the byte of the text's UTF-8 at which each piece ends."""
    blob = broadcast_model(common.session(docs), model_path)

    def task(batches):
        model = worker_model(blob.value)
        for doc_ids, texts in common.arrow_rows(batches, ("doc_id", "text")):
            begin = chars = 0
            for k, text in enumerate(texts, 1):
                chars += len(text)
                if chars > CHARS_AT_ONCE or k - begin == TEXTS_AT_ONCE or k == len(texts):
                    found = model.batch(texts[begin:k])
                    yield common.record_batch(ENCODED, doc_ids[begin:k], _lists([f[0] for f in found]), _lists([f[1] for f in found]))
                    begin, chars = k, 0

    return common.id_text(docs).mapInArrow(task, "doc_id long, ids array<int>, ends array<int>")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, decoded): the text of the ids; null ids are none."""
    blob = broadcast_model(common.session(encoded), model_path)

    def task(batches):
        model = worker_model(blob.value)
        for batch in batches:
            ids = batch.column("ids")
            for k in range(0, batch.num_rows, TEXTS_AT_ONCE):
                some = ids.slice(k, TEXTS_AT_ONCE)
                values, lengths = some.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(some).fill_null(0).to_numpy()
                yield common.record_batch(DECODED, batch.column("doc_id").slice(k, TEXTS_AT_ONCE), some,
                                          list(map(model.decode, np.split(values, lengths.cumsum()[:-1]))))

    return encoded.select("doc_id", "ids").mapInArrow(task, "doc_id long, ids array<int>, decoded string")


def digests(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the ids in decimal, comma-joined, and of the decoded text."""
    return decode(encoded, model_path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
