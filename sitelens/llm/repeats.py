"""Repeated windows of a corpus: the distribution that suffix-array and substring dedup share.

A window is ``units.window`` consecutive tokens of one document (bytes, or words).  Comparing every
document with an index of every other would cost the square of the corpus; instead equal windows are
brought together by content:

1. Documents go to blocks by the hash of their id; this is the only shuffle of the text, and all
   later steps read that one exchange.
2. Each window's anchor is the run of ``units.gram`` tokens in it with the smallest hash.  Equal windows
   have equal anchors.  Blocks send their distinct anchors, packed by bucket; a bucket tells each
   block which of its anchors occur in other blocks, too, and which are hot.
3. Consecutive windows with one anchor form a segment.  Segments whose anchor is repeated go to the
   shard of the anchor, one row for all equal segments of a block.  Segments of a hot anchor go as
   single windows to the shards of the windows' own hashes, one row for all equal windows of a block,
   so neither an anchor nor a window fills one task.
4. A shard holds an index of its segments that share their anchor with a different one, and reports the windows that occur
   earlier (``judge``).
5. Blocks apply the reported ranges to their documents.

Nothing is capped or sampled: every window that occurs twice has a repeated anchor, and all its
occurrences meet in one shard.

Order of documents: by doc_id (null first), then text hash; rows repeated with all values are
documents one after the other.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm import common

BLOCK_BYTES = 8 << 20      # of text in a block
SHARD_BYTES = 1 << 19      # of text for each shard; what reaches a shard is of that order
HOT = 4096                 # occurrences from which an anchor's windows are spread by their own hash
CHUNK = 1 << 20            # windows of a document that are hashed at once
NULL_ID = -(1 << 63)
MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                              0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


@dataclass(frozen=True)
class Units:
    """What a token is.  ``tokens``: text -> sequence; ``hashes``: sequence -> uint64 array; ``cut``: bytes of a part;
    ``count``: tokens in the bytes of a part."""
    window: int
    gram: int
    same_document: bool           # does an earlier start in the same document count?
    tokens: Callable
    hashes: Callable
    cut: Callable
    count: Callable

    def windows(self, part: bytes) -> int:
        return self.count(part) - self.window + 1


def grams(h: np.ndarray, m: int) -> np.ndarray:
    """Hashes of all runs of m tokens, by doubling."""
    out, size, done = None, 1, 0
    level = 0
    while True:
        if m & size:
            out = h[:len(h)] if out is None else out[:len(h) - done] * MIX[7 - level] + h[done:]
            done += size
            out = out[:max(0, len(out))]
        if size * 2 > m:
            break
        h = h[:-size] * MIX[level] + h[size:]
        size, level = size * 2, level + 1
    out = out ^ (out >> np.uint64(31))
    out *= MIX[1]
    return out ^ (out >> np.uint64(29))


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    size = 1
    while size * 2 <= w:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    return np.minimum(v[:len(v) - (w - size)], v[w - size:]) if w > size else v


def segments(h: np.ndarray, units: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor) of the segments of a document's token hashes."""
    window, m = units.window, units.gram
    first, count, anchor = [], [], []
    for at in range(0, len(h) - window + 1, CHUNK):
        g = grams(h[at:at + CHUNK + window - 1], m)
        packed = (g & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(g), dtype=np.uint64)
        place = (sliding_min(packed, window - m + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
        s = np.flatnonzero(np.diff(place, prepend=-1))
        first.append(at + s)
        count.append(np.diff(s, append=len(place)))
        anchor.append(g[place[s]])
    if not first:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(first), np.concatenate(count), np.concatenate(anchor)


def documents(block: pa.Table) -> list[tuple]:
    """(doc_id, text hash, text) of a block, in the order of documents."""
    rows = zip(block.column("doc_id").to_pylist(), block.column("text_hash").to_pylist(), block.column("text").to_pylist())
    return sorted((NULL_ID if i is None else i, x, t) for i, x, t in rows)


def runs(windows: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of the runs of ascending numbers."""
    if not len(windows):
        return []
    cut = np.flatnonzero(np.diff(windows) > 1)
    return list(zip(windows[np.r_[0, cut + 1]].tolist(), windows[np.r_[cut, len(windows) - 1]].tolist()))


def _in(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)] == x


def _local_counts(found: list, units: Units) -> tuple[np.ndarray, np.ndarray]:
    """A block's anchors and in how many places (or documents, if only those count) they are."""
    anchors = [a if units.same_document else np.unique(a) for _, _, a in found]
    return np.unique(np.concatenate(anchors) if anchors else np.zeros(0, np.uint64), return_counts=True)


ANCHORS = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("anchors", pa.binary()), ("counts", pa.binary())])
REPEATED = pa.schema([("block", pa.int32()), ("anchors", pa.binary()), ("hot", pa.binary())])
SEGMENTS = pa.schema([("shard", pa.int64()), ("anchor", pa.int64()), ("block", pa.int32()), ("doc_id", pa.int64()), ("text_hash", pa.int64()),
                      ("places", pa.binary()), ("segment", pa.binary()), ("ranges", pa.binary())])
RANGES = pa.schema([("block", pa.int32()), ("ranges", pa.binary())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def send_anchors(units: Units, buckets: int):
    def task(block: pa.Table) -> pa.Table:
        found = [segments(units.hashes(units.tokens(t)), units) for _, _, t in documents(block)]
        anchors, counts = _local_counts(found, units)
        bucket = (anchors >> np.uint64(33)).astype(np.int64) % buckets
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        used = np.flatnonzero(np.diff(starts))
        nr = block.column("block")[0].as_py()
        parts = [order[starts[b]:starts[b + 1]] for b in used]
        return pa.table([pa.array(used, pa.int32()), pa.array([nr] * len(used), pa.int32()),
                         pa.array([anchors[p].tobytes() for p in parts], pa.binary()),
                         pa.array([counts[p].astype(np.uint32).tobytes() for p in parts], pa.binary())], schema=ANCHORS)
    return task


def find_repeated(limit: int):
    """Each block's anchors that occur in another block, too, ascending; and whether they are hot."""
    return lambda bucket: _repeated(bucket, limit)


def _repeated(bucket: pa.Table, limit: int) -> pa.Table:
    blocks = bucket.column("block").to_pylist()
    parts = [np.frombuffer(b, np.uint64) for b in bucket.column("anchors").to_pylist()]
    anchors = np.concatenate(parts)
    counts = np.concatenate([np.frombuffer(b, np.uint32) for b in bucket.column("counts").to_pylist()])
    value, where = np.unique(anchors, return_inverse=True)
    times = np.bincount(where, minlength=len(value))[where]
    hot = np.bincount(where, counts, len(value))[where] >= limit
    out, at = [], 0
    for nr, p in zip(blocks, parts):
        keep = at + np.flatnonzero(times[at:at + len(p)] > 1)
        at += len(p)
        if len(keep):
            keep = keep[np.argsort(anchors[keep])]
            out.append((nr, anchors[keep].tobytes(), hot[keep].tobytes()))
    return pa.table([list(c) for c in zip(*out)] if out else [[], [], []], schema=REPEATED)


def send_segments(units: Units, shards: int, limit: int):
    def task(block: pa.Table, repeated: pa.Table) -> pa.Table:
        import xxhash
        out: list[tuple] = []
        if not block.num_rows:
            return pa.table([[] for _ in SEGMENTS], schema=SEGMENTS)
        nr = block.column("block")[0].as_py()
        shared = [np.frombuffer(b, np.uint64) for b in repeated.column("anchors").to_pylist()]
        shared = np.concatenate(shared) if shared else np.zeros(0, np.uint64)
        is_hot = [np.frombuffer(b, bool) for b in repeated.column("hot").to_pylist()]
        hot = np.sort(shared[np.concatenate(is_hot)]) if is_hot else np.zeros(0, np.uint64)
        docs = documents(block)
        tokens = [units.tokens(t) for _, _, t in docs]
        found = [segments(units.hashes(x), units) for x in tokens]
        own, counts = _local_counts(found, units)
        hot = np.union1d(hot, own[counts >= limit])     # if other blocks have one of them, it is hot there, too
        known = np.union1d(shared, own[counts > 1])
        first_at: dict[bytes, list] = {}
        local: list[tuple[int, int, int]] = []

        def place(found: dict, part: bytes, a: int | None, places: list, n: int) -> bool:
            """Enter ``part`` at its places (in documents of one id); True, if an earlier document of this block decides them."""
            before = found.get(part)
            if before is None:
                found[part] = [a, places, part, n]
                return False
            doc_id = docs[places[0][0]][0]
            if units.same_document or docs[before[1][0][0]][0] < doc_id:
                return True
            if doc_id != NULL_ID:                      # nothing is smaller than that
                before[1].extend(places)
            return False

        for k, (x, (first, count, anchor)) in enumerate(zip(tokens, found)):
            again = _in(known, anchor)
            for s, n, a in zip(first[again].tolist(), count[again].tolist(), anchor[again].tolist()):
                if place(first_at, units.cut(x, s, s + n + units.window - 1), a, [(k, s)], n):
                    local.append((k, s, s + n + units.window - 1))   # all its windows are earlier in this block
        sent = []
        window_at: dict[bytes, list] = {}
        spread = _in(hot, np.array([r[0] for r in first_at.values()], np.uint64))
        for row, wide in zip(first_at.values(), spread):
            if not wide:
                sent.append(row)
                continue
            _, places, _, n = row
            k, s = places[0]
            done = [i for i in range(n) if place(window_at, units.cut(tokens[k], s + i, s + i + units.window), None,
                                                 [(k, s + i) for k, s in places], 1)]
            for lo, hi in runs(np.array(done, np.int64)):
                local += [(k, s + lo, s + hi + units.window) for k, s in places]
        rows = []
        for a, places, part, _ in chain(sent, window_at.values()):
            doc_id, text_hash, _ = docs[places[0][0]]
            key = xxhash.xxh64_intdigest(part) if a is None else a
            rows.append((key % shards, key >> 1, nr, doc_id, text_hash, np.array(places, np.int64).tobytes(), part, None))
        if local:
            rows.append((nr % shards, None, nr, None, None, None, None, np.array(local, np.int64).tobytes()))
        return pa.table([list(c) for c in zip(*rows)] if rows else [[] for _ in SEGMENTS], schema=SEGMENTS)
    return task


def judge_shard(units: Units, judge: Callable):
    """``judge``: (different segments as bytes, doc_ids of their first rows), in document order -> for each
    an array; see ``Units.same_document``: the windows of the first row that occur earlier, or every window's
    first doc_id.  Equal segments of several blocks are judged once.  Equal windows have equal anchors at equal places, so a
    segment that is the only one of its anchor shares no window with another, nor has it one twice: it needs no index."""
    def task(shard: pa.Table) -> pa.Table:
        ranges: dict[int, list[int]] = {}
        rows = []
        for anchor, block, doc_id, text_hash, places, segment, done in zip(*[c.to_pylist() for c in shard.columns[1:]]):
            if segment is None:
                ranges.setdefault(block, []).extend(np.frombuffer(done, np.int64).tolist())
            else:
                rows.append((doc_id, text_hash, np.frombuffer(places, np.int64).reshape(-1, 2).tolist(), segment, block, anchor))
        rows.sort(key=lambda r: (r[0], r[1], r[2][0]))
        first: dict[bytes, tuple] = {}
        for r in rows:
            first.setdefault(r[3], r)
        sizes = {x: units.windows(x) for x in first}
        different = Counter(r[5] for r in first.values())
        found, shared = {}, []
        for x, r in first.items():
            if different[r[5]] > 1:
                shared.append(x)
            else:
                found[x] = np.zeros(0, np.int64) if units.same_document else np.full(sizes[x], r[0])
        if shared:
            found.update(zip(shared, judge(shared, [first[x][0] for x in shared])))
        last = {} if units.same_document else {x: int(f.max()) for x, f in found.items()}
        for r in rows:
            doc_id, _, places, segment, block, _ = r
            out = ranges.setdefault(block, [])
            if first[segment] is not r if units.same_document else doc_id > last[segment]:
                for nr, s in places:                   # all its windows
                    out += (nr, s, s + sizes[segment] + units.window - 1)
                continue
            windows = found[segment] if units.same_document else np.flatnonzero(found[segment] < doc_id)
            for lo, hi in runs(windows):
                for nr, s in places:
                    out += (nr, s + lo, s + hi + units.window)
        ranges = {k: v for k, v in ranges.items() if v}
        return pa.table([pa.array(list(ranges), pa.int32()),
                         pa.array([np.array(x, np.int64).tobytes() for x in ranges.values()], pa.binary())], schema=RANGES)
    return task


def apply_ranges(units: Units, finish: Callable, schema: pa.Schema):
    """``finish``: (doc_id, tokens, mask of removed tokens) -> a row of ``schema``."""
    def task(block: pa.Table, ranges: pa.Table) -> pa.Table:
        found = [np.frombuffer(b, np.int64).reshape(-1, 3) for b in ranges.column("ranges").to_pylist()]
        found = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
        found = found[np.argsort(found[:, 0], kind="stable")]
        docs = documents(block)
        starts = np.searchsorted(found[:, 0], np.arange(len(docs) + 1))
        rows = []
        for k, (doc_id, _, text) in enumerate(docs):
            tokens = units.tokens(text)
            own = found[starts[k]:starts[k + 1]]
            change = np.bincount(own[:, 1], minlength=len(tokens) + 1) - np.bincount(own[:, 2], minlength=len(tokens) + 1)
            rows.append(finish(None if doc_id == NULL_ID else doc_id, tokens, np.cumsum(change)[:-1] > 0))
        return pa.table([list(c) for c in zip(*rows)] if rows else [[] for _ in schema], schema=schema)
    return task


def remove_repeats(docs: DataFrame, units: Units, judge: Callable, finish: Callable, schema: pa.Schema, ddl: str,
                   hot: int | None = None) -> DataFrame:
    spark = common.session(docs)
    hot = HOT if hot is None else hot
    rows = common.id_text(docs).withColumn("text_hash", F.xxhash64("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks, shards = max(least, -(-size // BLOCK_BYTES)), max(least, -(-size // SHARD_BYTES))
    block = F.pmod(F.xxhash64(F.coalesce("doc_id", "text_hash")), F.lit(blocks)).cast("int")
    rows = rows.select(block.alias("block"), "doc_id", "text_hash", "text").repartition(blocks, "block")
    anchors = rows.groupBy("block").applyInArrow(send_anchors(units, blocks), _ddl(ANCHORS))
    repeated = anchors.groupBy("bucket").applyInArrow(find_repeated(hot), _ddl(REPEATED))
    sent = rows.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(send_segments(units, shards, hot), _ddl(SEGMENTS))
    ranges = sent.groupBy("shard").applyInArrow(judge_shard(units, judge), _ddl(RANGES))
    return rows.groupBy("block").cogroup(ranges.groupBy("block")).applyInArrow(apply_ranges(units, finish, schema), ddl)
