import random

import numpy as np
import pyarrow as pa
import pytest

from sitelens.llm import automaton_dedup, repeats, run_index_dedup
from tests.llm import cases


def ordered(rows):
    """Documents in the order of the contract; equal ids in any order (the texts are equal in these cases)."""
    return sorted(((i, t or "") for i, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def brute_bytes(rows, window=run_index_dedup.WINDOW):
    seen, out = set(), []
    for doc_id, text in ordered(rows):
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - window + 1):
            if data[i:i + window] in seen:
                gone[i:i + window] = True
            seen.add(data[i:i + window])
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((doc_id, len(data), int(gone.sum()), spans, bytes(np.frombuffer(data, np.uint8)[~gone])))
    return out


def brute_words(rows, window=automaton_dedup.WINDOW):
    first, docs = {}, [(i, t.encode().split()) for i, t in ordered(rows)]
    low = lambda i: -1 if i is None else i
    for i, w in docs:
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k:k + window]), low(i))
    out = []
    for i, w in docs:
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < low(i):
                gone[k:k + window] = True
        out.append((i, len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def sort_rows(rows):
    return sorted((tuple(bytes(x) if isinstance(x, (bytearray, bytes)) else x for x in r) for r in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def copies(seed, n=60):
    """Documents that share passages, overlap themselves, and copy each other."""
    r = random.Random(seed)
    passages = [cases.prose(100 + k, 45, 60) for k in range(4)]
    rows = []
    for k in range(n):
        parts = [cases.prose(r.randrange(10 ** 6), r.randrange(30), 60) for _ in range(3)]
        if r.random() < 0.7:
            parts.insert(1, r.choice(passages)[r.randrange(20):])
        if r.random() < 0.2:
            parts += [parts[0]] * 3
        rows.append((k, " ".join(parts)))
    rows += [(n + k, rows[3][1]) for k in range(10)] + [(n + 20, "ab " * 200), (n + 21, "a" * 700)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [repeats.HOT, 3])
def test_bytes_against_brute_force(spark, monkeypatch, hot):
    """Also with every repeated anchor spread by window, as hot ones are."""
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = copies(1) + [(r[0] and r[0] + 500, r[1]) for r in cases.odd_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sort_rows(run_index_dedup.remove_repeated_bytes(docs).collect()) == sort_rows(brute_bytes(rows))


@pytest.mark.parametrize("hot", [repeats.HOT, 3])
def test_words_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = copies(2) + [(r[0] and r[0] + 500, r[1]) for r in cases.odd_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sort_rows(automaton_dedup.remove_repeated_words(docs).collect()) == sort_rows(brute_words(rows))


def test_empty_and_clashing(spark):
    for remove, brute in ((run_index_dedup.remove_repeated_bytes, brute_bytes), (automaton_dedup.remove_repeated_words, brute_words)):
        assert remove(cases.no_docs(spark)).collect() == []
        assert sort_rows(remove(cases.odd_docs(spark)).collect()) == sort_rows(brute(cases.odd_rows()))


def test_run_index_matching_statistics():
    """Samples at run borders give every position's longest match with any other position."""
    r = random.Random(3)
    strings = [bytes(r.choice(b"ab") for _ in range(r.randrange(1, 40))) for _ in range(12)] + [b"abab" * 12] * 3
    text = np.concatenate([np.append(np.frombuffer(s, np.uint8).astype(np.int16) + 1, 0) for s in strings])
    ends = np.flatnonzero(text == 0)
    left = ends[np.searchsorted(ends, np.arange(len(text)))] - np.arange(len(text)) + 1
    index = run_index_dedup.RunIndex.build(text, left)
    assert len(index.letters) < len(text)
    up, up_length, down, down_length = index.matching_statistics(np.arange(len(text)))
    suffix = [tuple(text[i:i + left[i] - 1]) for i in range(len(text))]

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    for i in range(len(text)):
        best = max(common(suffix[i], suffix[j]) for j in range(len(text)) if j != i)
        assert max(up_length[i], down_length[i], 0) == best
        for neighbour, length in ((up[i], up_length[i]), (down[i], down_length[i])):
            assert length <= 0 or common(suffix[i], suffix[neighbour]) == length
    first = {}
    for i, s in enumerate(suffix):
        first.setdefault(s[:5] if len(s) >= 5 else i, i)
    earliest = index.earliest(5)
    assert all(earliest[i] == first[s[:5]] for i, s in enumerate(suffix) if len(s) >= 5)


def test_suffix_automaton_finds_first_marks():
    r = random.Random(4)
    texts = [[r.randrange(3) for _ in range(r.randrange(1, 30))] for _ in range(30)]
    automaton = automaton_dedup.SuffixAutomaton()
    first = {}
    for mark, t in enumerate(texts):
        automaton.add(t, mark)
        for k in range(len(t) - 3):
            first.setdefault(tuple(t[k:k + 4]), mark)
    for t in texts + [[5, 0, 1, 2, 0], [2, 2, 2, 2, 2, 2]]:
        assert automaton.matches(t, 4)[3:] == [first.get(tuple(t[k:k + 4])) for k in range(len(t) - 3)]


def test_segments_cover_every_window_once_and_chunks_do_not_matter(monkeypatch):
    h = np.random.default_rng(1).integers(0, 50, 5000).astype(np.uint64) * repeats.MIX[0]
    whole = repeats.segments(h, automaton_dedup.UNITS)
    assert whole[1].sum() == len(h) - automaton_dedup.WINDOW + 1
    monkeypatch.setattr(repeats, "CHUNK", 333)
    parts = repeats.segments(h, automaton_dedup.UNITS)
    assert (np.repeat(whole[2], whole[1]) == np.repeat(parts[2], parts[1])).all()


@pytest.mark.parametrize("module", [run_index_dedup, automaton_dedup])
def test_a_block_sends_a_hot_window_once(module):
    """A passage between different contexts: no two segments at its edges are equal, but its windows are."""
    passage = cases.prose(7, 80)
    texts = [f"{cases.prose(100 + k, 30)} {passage} {cases.prose(300 + k, 30)}" for k in range(40)]
    block = pa.table({"block": [0] * 40, "doc_id": list(range(40)), "text_hash": list(range(40)), "text": texts})
    sent = repeats.send_segments(module.UNITS, 8, 3)(block, repeats.REPEATED.empty_table())
    parts = [p for p in sent.column("segment").to_pylist() if p is not None]
    units, x = module.UNITS, module.UNITS.tokens(passage)
    windows = {units.cut(x, s, s + units.window) for s in range(len(x) - units.window + 1)}
    assert len(parts) == len(set(parts)) and windows <= set(parts)


@pytest.mark.parametrize("hot", [repeats.HOT, 3])
def test_hot_windows_of_rows_with_one_id_or_none(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    passage = cases.prose(8, 60)
    rows = [(i, f"{cases.prose(500 + k, 20)} {passage} {cases.prose(700 + k, 20)} {passage}")
            for k, i in enumerate([None] * 6 + [1, 1, 1, 2, 3, 3, 4, 5, 5, 5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sort_rows(automaton_dedup.remove_repeated_words(docs).collect()) == sort_rows(brute_words(rows))


@pytest.mark.parametrize("module", [run_index_dedup, automaton_dedup])
def test_the_index_gets_only_segments_that_share_an_anchor(module):
    """Copies of whole documents are decided by lookups; only where two contexts meet a passage the index has work."""
    units, passage = module.UNITS, cases.prose(7, 40)
    whole = cases.prose(9, 400)
    texts = [whole, f"{cases.prose(11, 40)} {passage} {cases.prose(12, 40)}", f"{cases.prose(13, 40)} {passage} {cases.prose(14, 40)}"]
    parts = [pa.table({"block": [b] * 3, "doc_id": [3 * b + k for k in range(3)], "text_hash": [0, 1, 2], "text": texts}) for b in range(2)]
    anchors = [np.unique(np.concatenate([repeats.segments(units.hashes(units.tokens(t)), units)[2] for t in texts]))] * 2
    repeated = [pa.table({"block": [b], "anchors": [a.tobytes()], "hot": [np.zeros(len(a), bool).tobytes()]}, repeats.REPEATED)
                for b, a in enumerate(anchors)]
    sent = pa.concat_tables([repeats.send_segments(units, 1, 9)(p, r) for p, r in zip(parts, repeated)])
    indexed = []

    def judge(segments, doc_ids):
        indexed.extend(segments)
        return module.judge(segments, doc_ids)

    ranges = repeats.judge_shard(units, judge)(sent)
    different = {p for p in sent.column("segment").to_pylist() if p is not None}
    assert 0 < len(indexed) < len(different) / 4 and len(indexed) == len(set(indexed))
    # the second block is a copy of the first: every token of it goes
    gone = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 3) for b, x in
                           zip(ranges.column("block").to_pylist(), ranges.column("ranges").to_pylist()) if b == 1])
    for k, t in enumerate(texts):
        mask = np.zeros(len(units.tokens(t)), bool)
        for _, lo, hi in gone[gone[:, 0] == k]:
            mask[lo:hi] = True
        assert mask.all()
