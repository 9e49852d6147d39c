"""Benchmark decontamination: a BM25 inverted index of test items, searched with block-max WAND.

Items are cut into units of at most ``UNIT`` words.  A unit's BM25 impacts are divided by its score
against itself, so every score lies in [0, 1] and one threshold suits units of any length.  Each
document is read as overlapping passages of ``2 * UNIT`` words, a step of ``UNIT`` apart, so every
unit that occurs lies whole in one of them, and every passage is a query: all units scoring
``THRESHOLD`` or more are retrieved, however many they are.  A document counts as contaminated by an
item if, besides, at least ``OVERLAP`` of the five-word shingles of the item's question and of its
answer occur in the document.  The last line of an item of several lines is its answer.

Passages that cannot reach the threshold are passed over first: per document one vectorised pass
sums, for each block of ``UNIT`` words and each unit, the impacts of the index's rarer terms, and
adds the most that the commoner terms can give that unit.  The bound is never below a score, so only
hopeless passages are left out; the others go through WAND.

The index is built in shards of at most ``SHARD_BYTES`` of item text, each of which is broadcast and
searched in its own pass (collection statistics are the shard's); test sets of usual size have one.

Defined cases: null texts are empty; items without a word never match; a question or answer of fewer
than five words must occur as a whole; item rows repeated with one id count once (the greatest text);
an empty benchmark or table gives no hits; other columns pass through ``keep_clean`` and are ignored
elsewhere.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm import common

K1, B = 1.2, 0.75
UNIT = 64
THRESHOLD = 0.5
OVERLAP = 0.8
SHINGLE = 5
BLOCK = 16                  # postings of a block, which has its own greatest impact
COMMON_SHARE = 0.25         # the most of a unit's own score that terms treated as common may make up
SHARD_BYTES = 16 << 20
CELLS = 1 << 20             # of the bound's matrix of word blocks and units, at a time
WORDS = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def question_answer(text: str) -> tuple[list[str], list[str]]:
    lines = [line for line in text.splitlines() if line.strip()]
    return (words_of("\n".join(lines[:-1])), words_of(lines[-1])) if len(lines) > 1 else (words_of(text), [])


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    n = min(SHINGLE, len(words))
    return set(zip(*[words[k:] for k in range(n)])) if n else set()


class Postings:
    """A term's units in ascending order with their impacts, and each block's last unit and greatest impact."""

    def __init__(self, units: list[int], impacts: list[float]):
        self.units, self.impacts = units, impacts
        self.top = max(impacts)
        self.last = [units[min(k + BLOCK, len(units)) - 1] for k in range(0, len(units), BLOCK)]
        self.block_top = [max(impacts[k:k + BLOCK]) for k in range(0, len(units), BLOCK)]


def unit_words(text: str) -> list[list[str]]:
    words = words_of(text)
    return [words[k:k + UNIT] for k in range(0, len(words), UNIT)]


class Index:
    """``statistics``: number of units, their mean length and each word's number of units, of the whole benchmark; else of these items."""

    def __init__(self, items: list[tuple[int, str]], statistics: tuple[int, float, dict[str, int]] | None = None):
        self.item_of: list[int] = []
        self.parts = {i: tuple(map(shingles, question_answer(t))) for i, t in items}
        units = []
        for i, text in items:
            for words in unit_words(text):
                units.append(Counter(words))
                self.item_of.append(i)
        n, lens = len(units), [sum(u.values()) for u in units]
        all_units, mean, df = statistics or (n, sum(lens) / n if n else 1, Counter(t for u in units for t in u))
        idf = {t: math.log(1 + (all_units - df[t] + 0.5) / (df[t] + 0.5)) for u in units for t in u}
        found = defaultdict(lambda: ([], []))
        common_left = np.full(n, COMMON_SHARE)
        rarer: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for u, (tf, size) in enumerate(zip(units, lens)):
            raw = {t: idf[t] * c * (K1 + 1) / (c + K1 * (1 - B + B * size / mean)) for t, c in tf.items()}
            own = sum(raw.values())
            for t in sorted(raw, key=lambda t: (-df[t], t)):
                impact = raw[t] / own
                found[t][0].append(u)
                found[t][1].append(impact)
                if impact <= common_left[u]:
                    common_left[u] -= impact      # the commonest terms: left out of the bound's sums
                else:
                    rarer[t].append((u, impact))
        self.postings = {t: Postings(*p) for t, p in found.items()}
        self.common_most = COMMON_SHARE - common_left
        self.terms = {t: k for k, t in enumerate(self.postings)}
        starts, unit, impact = [0], [], []
        for t in self.terms:
            for u, x in rarer.get(t, ()):
                unit.append(u)
                impact.append(x)
            starts.append(len(unit))
        self.starts, self.unit, self.impact = np.array(starts), np.array(unit, np.int64), np.array(impact)

    def hopeful(self, words: list[str]) -> np.ndarray:
        """Numbers of the passages that may reach the threshold for some unit."""
        n = len(self.item_of)
        blocks = max(1, -(-len(words) // UNIT))
        get = self.terms.get
        term = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        at = np.flatnonzero(term >= 0)
        passages = []
        per = max(2, CELLS // max(n, 1))
        for first in range(0, blocks, per - 1):       # one block more, which the last passage ends in
            lo, hi = np.searchsorted(at, [first * UNIT, min(first + per, blocks) * UNIT])
            rows = min(first + per, blocks) - first
            own = np.unique((at[lo:hi] // UNIT - first) * len(self.terms) + term[at[lo:hi]])
            block, t = own // len(self.terms), own % len(self.terms)
            count = self.starts[t + 1] - self.starts[t]
            entry = np.repeat(self.starts[t] - np.cumsum(count) + count, count) + np.arange(count.sum())
            cell = np.repeat(block, count) * n + self.unit[entry]
            score = np.bincount(cell, self.impact[entry], rows * n).reshape(rows, n)
            best = (score[:-1] + score[1:] + self.common_most).max(1) if rows > 1 else (score + self.common_most).max(1)
            passages.append(first + np.flatnonzero(best >= THRESHOLD - 1e-9))
            if first + per >= blocks:
                break
        return np.concatenate(passages)

    def wand(self, terms: set[str], threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """All units whose score for the terms reaches the threshold, by document-at-a-time block-max WAND."""
        cursors = [[p.units[0], 0, p] for t in terms if (p := self.postings.get(t))]
        threshold -= 1e-9
        out, end = [], len(self.item_of)

        def move(c, unit):
            """Put the cursor on its first posting at ``unit`` or behind it, block by block."""
            _, k, p = c
            b = k // BLOCK
            while b < len(p.last) and p.last[b] < unit:
                b += 1
            k = max(k, b * BLOCK)
            while k < len(p.units) and p.units[k] < unit:
                k += 1
            c[0], c[1] = (p.units[k] if k < len(p.units) else end), k

        while cursors:
            cursors = sorted((c for c in cursors if c[0] < end), key=lambda c: c[0])
            bound, pivot = 0.0, None
            for k, c in enumerate(cursors):
                bound += c[2].top
                if bound >= threshold:
                    pivot = k
                    break
            if pivot is None:
                break
            unit = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == unit:
                pivot += 1
            bound, nxt = 0.0, end
            for c in cursors[:pivot + 1]:
                b = c[1] // BLOCK
                while b < len(c[2].last) and c[2].last[b] < unit:
                    b += 1
                if b < len(c[2].last):
                    bound += c[2].block_top[b]
                    nxt = min(nxt, c[2].last[b] + 1)
            if pivot + 1 < len(cursors):
                nxt = min(nxt, cursors[pivot + 1][0])
            if bound < threshold:                     # nothing before ``nxt`` can reach it
                for c in cursors[:pivot + 1]:
                    move(c, max(nxt, unit + 1))
            elif cursors[0][0] == unit:
                score = sum(c[2].impacts[c[1]] for c in cursors[:pivot + 1])
                if score >= threshold:
                    out.append((unit, score))
                for c in cursors[:pivot + 1]:
                    move(c, unit + 1)
            else:
                for c in cursors[:pivot + 1]:
                    if c[0] < unit:
                        move(c, unit)
        return out

    def hits(self, text: str) -> list[tuple[int, float, float, float]]:
        """(item, best score of its units, question overlap, answer overlap), verified, by item."""
        words = words_of(text)
        if not words or not self.item_of:
            return []
        best: dict[int, float] = {}
        for p in self.hopeful(words):
            for unit, score in self.wand(set(words[p * UNIT:(p + 2) * UNIT])):
                best[self.item_of[unit]] = max(best.get(self.item_of[unit], 0.0), score)
        if not best:
            return []
        seen: dict[int, set] = {}
        out = []
        for item in sorted(best):
            share = []
            for part in self.parts[item]:
                size = len(next(iter(part), ()))
                if size and size not in seen:
                    seen[size] = set(zip(*[words[k:] for k in range(size)]))
                share.append(len(part & seen[size]) / len(part) if part else 1.0)
            if min(share) >= OVERLAP:
                out.append((item, min(1.0, best[item]), *share))
        return out


WORD_ROWS = pa.schema([("shard", pa.int32()), ("word", pa.string()), ("units", pa.int64()), ("total", pa.int64())])


def indexes(benchmark: DataFrame):
    """One index a shard of the items, whose size is bounded whatever the benchmark's.

    Number of units, mean length and document frequencies are aggregated by Spark over all items, so scores do not
    depend on how the benchmark is sharded; a shard gets the frequencies of its own words.
    """
    spark = common.session(benchmark)
    items = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()) \
        .groupBy(F.col("item_id").cast("long").alias("item_id")).agg(F.max("text").alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    shards = -(-size // SHARD_BYTES)
    items = items.withColumn("shard", F.pmod(F.xxhash64("item_id"), F.lit(max(1, shards))).cast("int"))

    def counted(batches):
        for shard, texts in common.arrow_rows(batches, ("shard", "text")):
            for s, text in zip(shard, texts):
                units = unit_words(text)
                df = Counter(w for u in units for w in set(u))
                # the empty word carries the number of units and of words
                yield common.record_batch(WORD_ROWS, [s] * (len(df) + 1), ["", *df], [len(units), *df.values()], [sum(map(len, units))] + [0] * len(df))

    words = items.mapInArrow(counted, "shard int, word string, units long, total long") \
        .groupBy("shard", "word").agg(F.sum("units").alias("units"), F.sum("total").alias("total"))
    if shards > 1:
        words = common.stage(words, "benchmark-words")
        every = words.groupBy("word").agg(F.sum("units").alias("units"), F.sum("total").alias("total"))
        words = common.stage(words.select("shard", "word").join(every, "word"), "benchmark-statistics")
    for k in range(shards):
        df = {r.word: (r.units, r.total) for r in words.where(F.col("shard") == k).collect()}
        units, total = df.pop("", (0, 0))
        rows = items.where(F.col("shard") == k).collect()
        yield Index(sorted((r.item_id, r.text) for r in rows), (units, total / units if units else 1, {w: n for w, (n, _) in df.items()}))


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap), one row for each contaminated pair."""
    spark = common.session(docs)
    names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
    schema = pa.schema([(n, pa.int64() if n.endswith("id") else pa.float64()) for n in names])
    out = spark.createDataFrame([], "doc_id long, item_id long, score double, question_overlap double, answer_overlap double")
    for index in indexes(benchmark):
        sent = spark.sparkContext.broadcast(index)

        def task(batches, sent=sent):
            index = sent.value
            for ids, texts in common.arrow_rows(batches, ("doc_id", "text")):
                rows = [(i, *hit) for i, t in zip(ids, texts) for hit in index.hits(t)]
                if rows:
                    yield common.record_batch(schema, *map(list, zip(*rows)))

        out = out.unionByName(common.id_text(docs).mapInArrow(task, out.schema))
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that no item contaminates; nothing is shuffled."""
    spark = common.session(docs)
    text = next(i for i, c in enumerate(docs.columns) if c.lower() == "text")
    for index in indexes(benchmark):
        sent = spark.sparkContext.broadcast(index)

        def task(batches, sent=sent):
            for b in batches:
                yield b.filter(pa.array([not sent.value.hits(t or "") for t in b.column(text).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(task, docs.schema)
    return docs
