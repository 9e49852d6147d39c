"""Groups of spelling variants by Bloom-guided edit neighbourhoods.

The vocabulary is counted by Spark.  For each word length a blocked Bloom filter of the words of that length is
built in segments by the executors; the filters are broadcast in passes of at most ``PASS_BYTES``.  Every
word probes its deletions in the filter one length below and its replacements by a greater character in the
filter of its own length, so each near pair is asked for once (an insertion is the other word's deletion).
Candidates are hashed with numpy, from the word's polynomial hash, without being built; only positives become strings
and are shuffled to an exact join with the vocabulary, which removes the false ones.  Forms are followed to their
last word by pointer doubling.

Defined cases: a null text has no words; a null doc_id counts as an empty string before the colon; repeated rows count each;
an empty table gives no rows; very long words are probed in blocks of positions; other columns are ignored.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm import common

RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT, ONE_IN = 5, 3, 97
BITS_A_WORD = 16
LANES = 4                            # 64-bit lanes of a block; two bits of a word in each
SEGMENT_BLOCKS = 1 << 11             # blocks of a segment, which one task builds
PASS_BYTES = 32 << 20                # filters that are broadcast at once
WORDS_A_TASK = 1 << 16
CELLS = 1 << 20                      # candidates that a task hashes at once
BASE = 0x9E3779B97F4A7C15            # odd, so that it has an inverse modulo 2^64
FORM_RATIO = 2

HASHES = pa.schema([("length", pa.int32()), ("segment", pa.int32()), ("h", pa.int64())])
SEGMENTS = pa.schema([("length", pa.int32()), ("segment", pa.int32()), ("bits", pa.binary())])
CANDIDATES = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string())])


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all texts, some with a character less, that are long and frequent enough."""
    lower = F.translate(F.col("text"), string.ascii_uppercase, string.ascii_lowercase)
    runs = common.id_text(docs).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
                                       F.explode(F.regexp_extract_all(lower, F.lit(RUN), 0)).alias("run"))
    h = F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary"))
    runs = runs.where(F.length("run") >= LEAST_LENGTH).withColumn("h", h)
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % ONE_IN == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


# ------------------------------------------------------------------ hashes of words and of their edits

def _matrix(words: list[str]) -> np.ndarray:
    """Code points of words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64)


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(BASE))]))


def _prefixes(codes: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all beginnings of every word: column i is that of the first i characters."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    np.cumsum(codes * powers[:codes.shape[1]], axis=1, out=out[:, 1:])
    return out


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def hashes(words: list[str]) -> np.ndarray:
    codes = _matrix(words)
    return _mix(_prefixes(codes, _powers(codes.shape[1]))[:, -1])


def blocks_of(count: int) -> int:
    return max(1, -(-count * BITS_A_WORD // (64 * LANES)))


def block_of(h: np.ndarray, blocks: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def lane_bits(h: np.ndarray, lane: int) -> np.ndarray:
    """The two bits of a word in one lane of its block."""
    r = (h * np.uint64(2 * (0x5851F42D4C957F2D * (lane + 1)) & 0xFFFFFFFFFFFFFFFF | 1)) >> np.uint64(52)
    return (np.uint64(1) << (r & np.uint64(63))) | (np.uint64(1) << (r >> np.uint64(6)))


def contains(filters: np.ndarray, first: int, blocks: int, h: np.ndarray) -> np.ndarray:
    """Places of ``h`` that the filter may hold; ``filters`` has the blocks from ``first`` on, other blocks hold nothing."""
    block = block_of(h, blocks) - first
    at = np.flatnonzero((block >= 0) & (block < len(filters)))
    for lane in range(LANES):
        bits = lane_bits(h[at], lane)
        at = at[filters[block[at], lane] & bits == bits]
    return at


def edits(words: list[str], alphabet: np.ndarray):
    """Of words of one length: yields (kind, rows, places, characters, hashes) of blocks of their deletions and replacements.

    Of equal neighbours only the first is deleted, and characters are replaced by greater ones only.
    """
    codes = _matrix(words)
    n, width = codes.shape
    powers = _powers(width)
    upto = _prefixes(codes, powers)
    whole = upto[:, -1:]
    inverse = np.uint64(pow(BASE, -1, 1 << 64))
    step = max(1, CELLS // n)
    for i in range(0, width, step):
        j = min(width, i + step)
        changes = np.ones((n, j - i), bool)
        changes[:, (1 if i == 0 else 0):] = codes[:, max(1, i):j] != codes[:, max(1, i) - 1:j - 1]
        rows, at = np.nonzero(changes)
        at = at + i
        yield "delete", rows, at, None, _mix(upto[rows, at] + (whole[rows, 0] - upto[rows, at + 1]) * inverse)
    step = max(1, CELLS // (n * max(1, len(alphabet))))
    for i in range(0, width, step):
        old = codes[:, i:i + step]
        rows, at, new = np.nonzero(alphabet[None, None, :] > old[:, :, None])
        at, char = at + i, alphabet[new]
        yield "replace", rows, at, char, _mix(whole[rows, 0] + (char - codes[rows, at]) * powers[at])


def _by_length(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        out.setdefault(len(w), []).append(k)
    return out


# ------------------------------------------------------------------ filters, by the executors

def filter_segments(words: DataFrame, counts: dict[int, int]) -> DataFrame:
    """(length, segment, bits): the filters of all lengths, one task a segment; a segment's words are bounded by the hash."""
    def hashed(batches):
        for (column,) in common.arrow_rows(batches, ("word",)):
            for length, at in _by_length(column).items():
                h = hashes([column[k] for k in at])
                segment = block_of(h, blocks_of(counts[length])) // SEGMENT_BLOCKS
                yield common.record_batch(HASHES, [length] * len(at), segment.astype(np.int32), h.view(np.int64))

    def built(key, rows):
        length, segment = (k.as_py() for k in key)
        h = rows.column("h").to_numpy().view(np.uint64)
        blocks = blocks_of(counts[length])
        bits = np.zeros((min(SEGMENT_BLOCKS, blocks - segment * SEGMENT_BLOCKS), LANES), np.uint64)
        block = block_of(h, blocks) - segment * SEGMENT_BLOCKS
        for lane in range(LANES):
            np.bitwise_or.at(bits, (block, lane), lane_bits(h, lane))
        return pa.table([[length], [segment], [bits.tobytes()]], schema=SEGMENTS)

    return words.select("word").mapInArrow(hashed, "length int, segment int, h long").groupBy("length", "segment") \
        .applyInArrow(built, "length int, segment int, bits binary")


def passes(counts: dict[int, int], pass_bytes: int) -> list[list[tuple[int, int, int]]]:
    """Runs of (length, first segment, end) whose filters take at most ``pass_bytes`` (one segment at least)."""
    out, room = [[]], pass_bytes
    for length in sorted(counts):
        blocks = blocks_of(counts[length])
        for segment in range(-(-blocks // SEGMENT_BLOCKS)):
            size = min(SEGMENT_BLOCKS, blocks - segment * SEGMENT_BLOCKS) * LANES * 8
            if size > room and out[-1]:
                out.append([])
                room = pass_bytes
            room -= size
            if out[-1] and out[-1][-1][0] == length:
                out[-1][-1] = (length, out[-1][-1][1], segment + 1)
            else:
                out[-1].append((length, segment, segment + 1))
    return out


def _broadcast(spark: SparkSession, segments: DataFrame, part: list[tuple[int, int, int]]):
    """{length: (first block, bits)} of the segments of one pass."""
    wanted = F.lit(False)
    for length, a, b in part:
        wanted = wanted | ((F.col("length") == length) & (F.col("segment") >= a) & (F.col("segment") < b))
    found = {(r.length, r.segment): r.bits for r in segments.where(wanted).collect()}
    filters = {}
    for length, a, b in part:
        # a segment without words has no row; its blocks are empty
        bits = b"".join(bytes(found.get((length, s), bytes(SEGMENT_BLOCKS * LANES * 8))) for s in range(a, b))
        filters[length] = (a * SEGMENT_BLOCKS, bits)
    return spark.sparkContext.broadcast(filters)


# ------------------------------------------------------------------ probes

def candidates(words: DataFrame, segments: DataFrame, counts: dict[int, int], alphabet: str, pass_bytes: int = PASS_BYTES) -> list[DataFrame]:
    """For each pass (word, n, near): the edits that the pass's filters may hold."""
    chars = np.array(sorted(map(ord, alphabet)), np.uint64)
    out = []
    for part in passes(counts, pass_bytes):
        sent = _broadcast(words.sparkSession, segments, part)
        lengths = {length for length, _, _ in part}

        def probed(batches, sent=sent):
            filters = {length: (first, np.frombuffer(bits, np.uint64).reshape(-1, LANES)) for length, (first, bits) in sent.value.items()}
            for column, n in common.arrow_rows(batches, ("word", "n")):
                for length, at in _by_length(column).items():
                    for k in range(0, len(at), 256):
                        group = [column[x] for x in at[k:k + 256]]
                        counted = [n[x] for x in at[k:k + 256]]
                        for kind, rows, places, char, h in edits(group, chars):
                            target = length - (kind == "delete")
                            if target not in filters:
                                continue
                            first, bits = filters[target]
                            hit = contains(bits, first, blocks_of(counts[target]), h)
                            if len(hit):
                                rows_, places_ = rows[hit].tolist(), places[hit].tolist()
                                new = [""] * len(hit) if char is None else list(map(chr, char[hit].tolist()))
                                yield common.record_batch(CANDIDATES, [group[r] for r in rows_], [counted[r] for r in rows_],
                                                          [group[r][:p] + c + group[r][p + 1:] for r, p, c in zip(rows_, places_, new)])

        asked = words.where(F.length("word").isin(sorted(lengths | {x + 1 for x in lengths})))
        out.append(asked.mapInArrow(probed, "word string, n long, near string"))
    return out


def near_words(words: DataFrame, count: int, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of words that one edit tells apart."""
    spark = words.sparkSession
    counts = {r[0]: r[1] for r in words.groupBy(F.length("word")).count().collect()}
    alphabet = "".join(r[0] for r in words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct().collect())
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // WORDS_A_TASK))
    spread = common.stage(words.repartition(tasks, "word"), "variant-words")
    segments = common.stage(filter_segments(spread, counts), "variant-filters")
    exact = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = None
    for found in candidates(spread, segments, counts, alphabet, pass_bytes):
        one = common.stage(found.join(exact, "near").select("word", "n", "near", "near_n"), "variant-pairs")
        pairs = one if pairs is None else pairs.unionByName(one)
    if pairs is None:
        return spark.createDataFrame([], "word string, n long, near string, near_n long")
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                          F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to their last word, twice as far in every round."""
    up = common.stage(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "variant-roots")
    while not up.where("moved").isEmpty():
        over = up.select(F.col("word").alias("over"), F.col("root").alias("next"))
        up = common.stage(up.join(over, F.col("root") == F.col("over"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
    return up.select("word", "root")


def best_form() -> Column:
    """The most frequent near word, ties by code points, where it is frequent enough."""
    return F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))


def report(docs: DataFrame, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the whole vocabulary."""
    common.session(docs)
    words = common.stage(vocabulary(docs), "variant-vocabulary")
    near = near_words(words, words.count(), pass_bytes).groupBy("word").agg(F.count("*").alias("n_near"), best_form().alias("best"))
    rated = words.join(near, "word", "left")
    formed = -F.col("best.minus") >= FORM_RATIO * F.col("n")
    rated = common.stage(rated.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                      F.when(formed, F.col("best.near")).alias("form"), F.when(formed, -F.col("best.minus")).alias("form_n")),
                         "variant-forms")
    up = roots(rated.where("form is not null").select("word", "form"))
    return rated.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
