import random
import zlib

import numpy as np

from sitelens.llm import language_id, toxicity
from tests.llm import cases

WORDS = {"en": "the of and that with from this have water house", "de": "der und nicht ein zwischen haus wasser über straße für",
         "fr": "le des une était avec très maison après où être", "es": "el los una para niño año también señor casa agua"}


def labelled(n=240):
    r = random.Random(1)
    rows = []
    for k in range(n):
        lang = list(WORDS)[k % 4]
        rows.append((k, " ".join(r.choice(WORDS[lang].split()) for _ in range(r.randrange(20, 300))), lang))
    return rows


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_language_of_held_out_documents(spark):
    docs = spark.createDataFrame(labelled(), "doc_id long, text string, lang string")
    got = language_id.predict(docs, language_id.fit(docs)).collect()
    assert len(got) == 240 and all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in got)
    lang = {k: x for k, _, x in labelled()}
    test = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in test]) > 0.95


def test_folded_tables_are_the_network():
    """Scoring through pair tables equals the plain network, over windows cut by any chunk."""
    r = np.random.default_rng(1)
    x, y = r.integers(32, 127, (200, language_id.WINDOW)).astype(np.uint8), r.integers(0, 2, 200)
    x[y == 1, ::2] = 120
    net = language_id.train(["a", "b"], x, y)
    scorer = language_id.Scorer(net)
    e = net.emb[language_id.padded(x)]
    pooled = [np.concatenate([e[:, j:j + language_id.WINDOW] for j in range(w)], 2) @ f.reshape(-1, language_id.FILTERS)
              for w, f in zip(language_id.WIDTHS, net.filters)]
    logit = np.maximum(np.concatenate([z.max(1) for z in pooled], 1) + net.bias, 0) @ net.dense + net.dense_bias
    plain = logit - np.log(np.exp(logit - logit.max(1, keepdims=True)).sum(1, keepdims=True)) - logit.max(1, keepdims=True)
    assert np.abs(scorer.log_probabilities(x) - plain).max() < 1e-3
    texts = [bytes(r.integers(1, 255, n).astype(np.uint8)) for n in (0, 1, 255, 256, 257, 70000, 5)]
    for t, (lang, score) in zip(texts, scorer.score(texts)):
        mean = scorer.log_probabilities(language_id.windows(t)).mean(0)
        assert lang == net.langs[mean.argmax()] and abs(score - np.exp(mean - mean.max()).max() / np.exp(mean - mean.max()).sum()) < 1e-4


def test_language_of_odd_documents(spark):
    docs = cases.odd_docs(spark)
    model = language_id.fit(docs)
    got = language_id.predict(docs, model).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(cases.odd_rows())
    assert all(by_id[k].lang_pred == "und" and by_id[k].score == 0 for k in (5, 6, 7, 16))
    assert all(r.lang_pred in ("en", "de") for k, r in by_id.items() if k not in (5, 6, 7, 16))
    kept = language_id.keep_identified(docs, model, 0.0)
    assert kept.columns == docs.columns and kept.count() == len(got) - 4
    assert {r.lang_pred for r in language_id.predict(docs, None).collect()} == {"und"}
    assert language_id.fit(cases.no_docs(spark)) is None and language_id.predict(cases.no_docs(spark), None).collect() == []


def toxic_docs(n=600):
    r = random.Random(2)
    rows = []
    for k in range(n):
        words = cases.prose(k, r.randrange(5, 200)).split()
        toxic = int(r.random() < 0.25)
        for _ in range(3 * toxic):
            words.insert(r.randrange(len(words) + 1), r.choice(["vile", "rotten", "nasty fool"]))
        rows.append((k, " ".join(words), toxic))
    return rows


def test_toxicity_of_held_out_documents(spark):
    rows = toxic_docs()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] % 3] + [(1, 0), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert len(model.slot) < 5000
    got = toxicity.predict(docs, model).collect()
    truth = {r[0]: r[2] for r in rows}
    test = [r for r in got if r.held_out]
    assert all(r.predicted == (r.score >= toxicity.CUT) and r.held_out == held_out(r.doc_id) for r in got)
    assert np.mean([r.predicted for r in test if truth[r.doc_id]]) > 0.9
    assert np.mean([r.predicted for r in test if not truth[r.doc_id]]) < 0.05


def test_toxicity_of_odd_documents(spark):
    docs = cases.odd_docs(spark)
    labels = spark.createDataFrame([(8, 1), (11, 0), (12, 0), (12, 1)], "doc_id long, toxic int")
    got = toxicity.predict(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == len(cases.odd_rows()) and all(0 <= r.score <= 1 for r in got)
    none = toxicity.fit(docs, labels.where("false"))
    assert none is None and {r.score for r in toxicity.predict(docs, none).collect()} == {0.0}
    assert toxicity.predict(cases.no_docs(spark), None).collect() == []
