"""Language identification by a byte convolutional network.

Embedded bytes of a fixed-length window go through filters of several widths, a maximum over the
positions, and a softmax.  The network is trained in numpy on the driver, on a bounded sample of
labelled texts, and broadcast (a few hundred KB whatever the data).  Scoring cuts every whole text
into windows, in batches, and averages the windows' log-probabilities.

An embedding followed by a filter is linear in each byte, so scoring folds both into tables indexed
by two neighbouring bytes: a window position costs two look-ups and one addition.

Defined cases: a null text or one without a letter is ``und`` with score 0; without any labelled row
every text is ``und``; texts shorter than a window are padded with zero bytes; repeated rows are each
scored; other columns are ignored (``keep_identified`` passes them through).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm import common

WINDOW = 256            # bytes of a window
WIDTHS = (2, 3, 4)      # of the filters; the pair tables below are laid out for these three
FILTERS = 8             # of each width
EMBEDDING = 8
SAMPLE_PER_LANG = 400   # labelled documents of one language that training may see
WINDOWS_PER_DOC = 8     # training windows of one of them, spread evenly over the whole text
EPOCHS = 6
CHUNK = 256             # windows scored at once


@dataclass
class Network:
    langs: list[str]
    emb: np.ndarray                 # 256 x EMBEDDING
    filters: list[np.ndarray]       # width x EMBEDDING x FILTERS
    bias: np.ndarray                # all filters
    dense: np.ndarray               # all filters x langs
    dense_bias: np.ndarray

    def pair_tables(self) -> tuple[np.ndarray, np.ndarray]:
        """For the bytes (0, 1) and (2, 3) of a position: what they add to every filter."""
        def one(offset: int) -> np.ndarray:
            return np.concatenate([self.emb @ f[offset] if offset < len(f) else np.zeros((256, FILTERS))
                                   for f in self.filters], axis=1)

        def two(a: int, b: int) -> np.ndarray:
            return (one(a)[:, None, :] + one(b)[None, :, :]).reshape(65536, -1).astype(np.float32)
        return two(0, 1) + self.bias.astype(np.float32), two(2, 3)


def windows(data: bytes) -> np.ndarray:
    """All windows of a text, the last padded with zero bytes; one more row of three bytes is not needed
    because a filter that would reach beyond its window reads zero bytes there, too."""
    n = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


def padded(x: np.ndarray) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, max(WIDTHS) - 1)))


def train(langs: list[str], x: np.ndarray, y: np.ndarray, seed: int = 7) -> Network:
    """Adam on the cross-entropy of single windows; gradients reach only the positions of the maxima."""
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.3, (256, EMBEDDING))
    filters = [rng.normal(0, (2 / (w * EMBEDDING)) ** 0.5, (w, EMBEDDING, FILTERS)) for w in WIDTHS]
    bias = np.zeros(FILTERS * len(WIDTHS))
    dense = rng.normal(0, 0.2, (len(bias), len(langs)))
    dense_bias = np.zeros(len(langs))
    params = [emb, *filters, bias, dense, dense_bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    weight = len(y) / (len(langs) * np.maximum(1, np.bincount(y, minlength=len(langs))))
    step, x = 0, padded(x)
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(order), 64):
            batch = order[at:at + 64]
            xb, yb = x[batch], y[batch]
            e = emb[xb]
            pooled, best = [], []
            for w, f in zip(WIDTHS, filters):
                spread = np.concatenate([e[:, j:j + WINDOW] for j in range(w)], axis=2)
                z = spread @ f.reshape(-1, FILTERS)
                best.append(z.argmax(1))
                pooled.append(np.take_along_axis(z, best[-1][:, None, :], 1)[:, 0])
            pre = np.concatenate(pooled, 1) + bias
            hidden = np.maximum(pre, 0)
            logit = hidden @ dense + dense_bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(yb)), yb] -= 1
            p *= (weight[yb] / len(yb))[:, None]
            back = (p @ dense.T) * (pre > 0)
            d_emb, d_filters = np.zeros_like(emb), []
            for k, (w, f) in enumerate(zip(WIDTHS, filters)):
                g = back[:, k * FILTERS:(k + 1) * FILTERS]
                there = best[k][:, :, None] + np.arange(w)                        # batch x filter x width
                seen = xb[np.arange(len(yb))[:, None, None], there]
                d_filters.append(np.einsum("bf,bfwd->wdf", g, emb[seen]))
                np.add.at(d_emb, seen, g[:, :, None, None] * f.transpose(2, 0, 1)[None])
            grads = [d_emb, *d_filters, back.sum(0), hidden.T @ p, p.sum(0)]
            step += 1
            for q, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= 0.01 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Network(langs, emb, filters, bias, dense, dense_bias)


class Scorer:
    def __init__(self, net: Network):
        self.net = net
        self.low, self.high = net.pair_tables()
        self.dense, self.dense_bias = net.dense.astype(np.float32), net.dense_bias.astype(np.float32)

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        """One row for each window."""
        wide = padded(x).astype(np.int32)
        pairs = (wide[:, :-1] << 8) | wide[:, 1:]
        z = self.low[pairs[:, :WINDOW]]
        z += self.high[pairs[:, 2:2 + WINDOW]]
        logit = np.maximum(z.max(1), 0) @ self.dense + self.dense_bias
        logit -= logit.max(1, keepdims=True)
        return logit - np.log(np.exp(logit).sum(1, keepdims=True))

    def score(self, texts: list[bytes]) -> list[tuple[str, float]]:
        """Language and probability of every text, its windows' log-probabilities averaged."""
        cut = [windows(t) for t in texts]
        starts = np.cumsum([0] + [len(c) for c in cut])
        total = np.zeros((len(texts), len(self.net.langs)))
        owner = np.repeat(np.arange(len(texts)), np.diff(starts))
        for at in range(0, len(owner), CHUNK):
            first, last = np.searchsorted(starts, [at, min(at + CHUNK, len(owner)) - 1], "right") - 1
            x = np.concatenate([c[max(0, at - s):at + CHUNK - s] for c, s in zip(cut[first:last + 1], starts[first:last + 1])])
            np.add.at(total, owner[at:at + CHUNK], self.log_probabilities(x))
        mean = total / np.diff(starts)[:, None]
        p = np.exp(mean - mean.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        return [(self.net.langs[b], float(p[i, b])) for i, b in enumerate(best)]


def fit(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Network | None:
    """Learn from at most ``per_lang`` documents of each language that are not held out."""
    spark = common.session(docs)
    labelled = docs.where(~common.held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    chosen = common.bounded_ids(labelled.select(F.col("doc_id").cast("long").alias("doc_id"), "lang"), "lang", per_lang)
    if not chosen:
        return None
    langs = sorted({lang for _, lang in chosen})
    schema = pa.schema([("doc_id", pa.int64()), ("window", pa.binary())])

    def cut(batches):
        for ids, texts in common.arrow_rows(batches, ("doc_id", "text")):
            out = []
            for i, t in zip(ids, texts):
                w = windows(t.encode("utf-8"))
                take = np.unique(np.linspace(0, len(w) - 1, min(len(w), WINDOWS_PER_DOC)).astype(int))
                out += [(i, w[k].tobytes()) for k in take]
            yield common.record_batch(schema, [i for i, _ in out], [w for _, w in out])

    ids = spark.createDataFrame(chosen, "doc_id long, lang string")
    rows = common.one_text_an_id(labelled.where(F.col("text").rlike(r"\p{L}")), ids).mapInArrow(cut, "doc_id long, window binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r[0], bytes(r[1])))
    lang_of = dict(chosen)
    x = np.frombuffer(b"".join(bytes(r[1]) for r in rows), np.uint8).reshape(len(rows), WINDOW)
    y = np.array([langs.index(lang_of[r[0]]) for r in rows])
    return train(langs, x, y)


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    spark = common.session(docs)
    sent = spark.sparkContext.broadcast(net)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def task(batches):
        scorer = sent.value and Scorer(sent.value)
        for ids, texts, letters in common.arrow_rows(batches, ("doc_id", "text", "letters")):
            found = scorer.score([t.encode("utf-8") if ok else b"" for t, ok in zip(texts, letters)]) if scorer else []
            found = [f if ok else ("und", 0.0) for f, ok in zip(found or [("und", 0.0)] * len(ids), letters)]
            yield common.record_batch(schema, ids, [f[0] for f in found], [f[1] for f in found])

    scored = common.id_text(docs).withColumn("letters", F.col("text").rlike(r"\p{L}")) \
        .mapInArrow(task, "doc_id long, lang_pred string, score double")
    return scored.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, net: Network | None, least: float = 0.0) -> DataFrame:
    """The rows of ``docs``, all columns, that are not ``und`` and whose language scores ``least`` or more."""
    spark = common.session(docs)
    sent = spark.sparkContext.broadcast(net)
    letters = common.fresh(docs, "letters")
    text = next(i for i, c in enumerate(docs.columns) if c.lower() == "text")

    def task(batches):
        scorer = sent.value and Scorer(sent.value)
        for b in batches:
            if not b.num_rows or not scorer:
                continue
            ok = b.column(b.num_columns - 1).to_pylist()
            found = scorer.score([(t or "").encode("utf-8") if o else b"" for t, o in zip(b.column(text).to_pylist(), ok)])
            mask = pa.array([o and s >= least for o, (_, s) in zip(ok, found)])
            yield b.select(range(b.num_columns - 1)).filter(mask)

    return docs.withColumn(letters, F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}")).mapInArrow(task, docs.schema)
