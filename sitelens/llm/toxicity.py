"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the presence of words, neighbouring words and words one or two apart, hashed into
``2 ** BITS`` slots.  Every coordinate has its own learning rate; L1 keeps most weights at exactly
zero, so the learned model is a short list of (slot, weight) that is broadcast.  Training sees a
bounded sample of labelled rows; scoring reads every whole text.

Defined cases: null and empty texts score by the bias alone; a document labelled more than once is
toxic if any label says so; without labels every score is 0; repeated rows are each scored; other
columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm import common

BITS = 18
SAMPLE = {0: 6000, 1: 2000}   # labelled documents of each class (not toxic, toxic) that training may see
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 1.0
CUT = 0.3
WORDS = re.compile(r"\w+")
MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class WordHash(dict):
    def __missing__(self, word: str) -> int:
        import xxhash
        if len(self) >= 1 << 18:
            self.clear()
        h = xxhash.xxh64_intdigest(word.encode("utf-8"))
        if len(word) <= 64:
            self[word] = h
        return h


def slots(text: str, hashes: WordHash) -> np.ndarray:
    """The distinct slots of a whole text's features, ascending."""
    words = WORDS.findall(text.lower())
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    parts = [h * MIX[0]] + [h[:-gap] * MIX[gap] + h[gap:] * MIX[0] for gap in (1, 2, 3) if len(h) > gap]
    found = np.concatenate(parts)
    return np.unique(((found ^ (found >> np.uint64(29))) * MIX[3] >> np.uint64(64 - BITS)).astype(np.int32))


@dataclass
class Weights:
    slot: np.ndarray
    weight: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << BITS)
        w[self.slot] = self.weight
        return w


def train(examples: list[np.ndarray], labels: list[int], seed: int = 5) -> Weights:
    """FTRL-proximal (z, n per coordinate); the bias is one more coordinate without L1."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    last = 1 << BITS
    l1 = np.full(last + 1, L1)
    l1[last] = 0.0

    def weights(at):
        zi = z[at]
        return np.where(np.abs(zi) <= l1[at], 0.0, -(zi - np.sign(zi) * l1[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(labels)):
            at = np.append(examples[k], last)
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - labels[k]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    every = weights(np.arange(last + 1))
    slot = np.flatnonzero(every[:last])
    return Weights(slot.astype(np.int32), every[slot], float(every[last]))


def fit(docs: DataFrame, labels: DataFrame, per_class: dict[int, int] = SAMPLE) -> Weights | None:
    """Learn from labelled documents that are not held out, at most ``per_class`` of each class."""
    spark = common.session(docs)
    rows = labels.where(~common.held_out(F.col("doc_id"))).select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("toxic"))
    chosen = common.bounded_ids(rows, "toxic", per_class)
    if not chosen:
        return None
    schema = pa.schema([("doc_id", pa.int64()), ("slots", pa.binary())])

    def features(batches):
        hashes = WordHash()
        for ids, texts in common.arrow_rows(batches, ("doc_id", "text")):
            yield common.record_batch(schema, ids, [slots(t, hashes).tobytes() for t in texts])

    ids = spark.createDataFrame(chosen, "doc_id long, toxic int")
    seen = common.one_text_an_id(docs, ids).mapInArrow(features, "doc_id long, slots binary").collect()
    if not seen:
        return None
    seen.sort(key=lambda r: (r[0], bytes(r[1])))
    label = dict(chosen)
    return train([np.frombuffer(r[1], np.int32) for r in seen], [label[r[0]] for r in seen])


def predict(docs: DataFrame, model: Weights | None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    spark = common.session(docs)
    sent = spark.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def task(batches):
        w = sent.value.dense() if sent.value else None
        hashes = WordHash()
        for ids, texts in common.arrow_rows(batches, ("doc_id", "text")):
            if w is None:
                yield common.record_batch(schema, ids, np.zeros(len(ids)))
                continue
            total = np.array([w[slots(t, hashes)].sum() + sent.value.bias for t in texts])
            yield common.record_batch(schema, ids, 1 / (1 + np.exp(-np.clip(total, -700, 700))))

    scored = common.id_text(docs).mapInArrow(task, "doc_id long, score double")
    return scored.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= CUT).cast("int").alias("predicted"))
