import random

from sitelens.llm import decontaminate as D
from tests.llm import cases

ITEMS = [(1, cases.prose(50, 30)), (2, cases.prose(51, 20) + "\n" + cases.prose(52, 10)), (3, cases.prose(53, 200)),
         (4, "alpha beta"), (5, None), (6, " ,. "), (None, "nobody"), (4, "alpha beta")]


def brute(docs, items):
    """All verified pairs, without an index: overlap alone, which is stricter than the threshold here."""
    out = set()
    for doc_id, text in docs:
        words = D.words_of(text or "")
        for item, t in items:
            parts = [D.shingles(p) for p in D.question_answer(t or "")]
            if item is None or not any(parts):
                continue
            share = [len([s for s in p if s in set(zip(*[words[k:] for k in range(len(next(iter(p))))]))]) / len(p) if p else 1.0 for p in parts]
            if min(share) >= D.OVERLAP:
                out.add((doc_id, item))
    return out


def documents():
    r = random.Random(1)
    docs = [(k, cases.prose(k, r.randrange(400))) for k in range(40)]
    for k, (item, text) in enumerate(ITEMS * 2):
        host = docs[k][1].split()
        at = r.randrange(len(host) + 1)
        docs.append((100 + k, " ".join(host[:at] + [(text or "").upper()] + host[at:])))
    docs.append((200, " ".join(ITEMS[0][1].split()[:15])))                        # half an item is clean
    docs.append((201, ITEMS[1][1].split("\n")[0]))                                # a question without its answer is clean
    return docs + [(300, None), (301, ""), (None, ITEMS[0][1])]


def test_pairs_against_brute_force(spark):
    docs = spark.createDataFrame(documents(), "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = D.find(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(documents(), ITEMS)
    assert {200, 201, 300, 301}.isdisjoint({r.doc_id for r in got})
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})


def test_shards_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(D, "SHARD_BYTES", 400)
    docs = spark.createDataFrame(documents(), "doc_id long, text string").repartition(3)
    got = D.find(docs, spark.createDataFrame(ITEMS, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(documents(), ITEMS)


def test_scores_do_not_depend_on_the_shards(spark, monkeypatch):
    """Impacts of every item, and the scores of partial copies, from one shard and from many."""
    docs = spark.createDataFrame(documents(), "doc_id long, text string").repartition(2)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    pairs = lambda: {(r.doc_id, r.item_id): round(r.score, 9) for r in D.find(docs, items).collect()}
    impacts = lambda: sorted((t, i.item_of[u], round(x, 9)) for i in D.indexes(items) for t, p in i.postings.items() for u, x in zip(p.units, p.impacts))
    once = pairs(), impacts()
    alone = sorted((t, i.item_of[u], round(x, 9)) for i in [D.Index(sorted({r for r in ITEMS if r[0] and r[1]}))] for t, p in i.postings.items()
                   for u, x in zip(p.units, p.impacts))
    assert once[1] == alone
    monkeypatch.setattr(D, "SHARD_BYTES", 400)
    assert len(list(D.indexes(items))) > 3
    assert (pairs(), impacts()) == once


def test_wand_and_bound_against_full_scores():
    index = D.Index([(k, cases.prose(k, 10 + k, 150)) for k in range(80)])
    r = random.Random(3)
    for k in range(60):
        words = cases.prose(1000 + k, r.randrange(300), 150).split()
        if k % 2:
            words[5:5] = cases.prose(k, 10 + k, 150).split()
        passages = set(index.hopeful(words)) if words else set()
        for p in range(max(1, -(-len(words) // D.UNIT) - 1)):
            terms, full = set(words[p * D.UNIT:(p + 2) * D.UNIT]), {}
            for t in terms & set(index.postings):
                for u, x in zip(index.postings[t].units, index.postings[t].impacts):
                    full[u] = full.get(u, 0) + x
            for threshold in (0.2, 0.35, 0.5):
                assert sorted(u for u, _ in index.wand(terms, threshold)) == sorted(u for u, s in full.items() if s >= threshold - 1e-9)
            assert p in passages or max(full.values(), default=0) < D.THRESHOLD


def test_keep_clean_passes_columns_through(spark):
    docs = cases.odd_docs(spark)
    items = spark.createDataFrame([(1, cases.prose(1, 60))], "item_id long, text string")
    out = D.keep_clean(docs, items)
    assert out.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in out.collect()) == sorted(r[0] or 0 for r in cases.odd_rows() if r[0] not in (8, 9, 10, 11))
    assert D.keep_clean(docs, items.where("false")).count() == docs.count()
    assert D.find(cases.no_docs(spark), items).collect() == []
