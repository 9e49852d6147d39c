import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np

from sitelens.llm import queries, spelling_variants as variants
from tests.llm import cases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            if len(run) >= 5:
                n[run] += 1
    n = {w: k for w, k in n.items() if k >= 3}

    def is_near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    near = {w: [v for v in n if v != w and abs(len(v) - len(w)) <= 1 and is_near(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = Counter()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w, form[w], root, n[w], len(near[w]), form[w] and n[form[w]]] += 1
    return out


def texts(seed, n=80):
    r = random.Random(seed)
    base = ["".join(r.choice("abcdeéÿßÀ×") for _ in range(r.randrange(4, 9))) for _ in range(25)]
    rows = []
    for k in range(n):
        words = []
        for _ in range(60):
            w = r.choice(base[:1 + k % 25])
            for _ in range(r.choice((0, 0, 0, 1, 1, 2))):
                i = r.randrange(len(w))
                w = w[:i] + r.choice(["", "a", "ab", "É", "é"]) + w[i + 1:] or "x"
            words.append(w.upper() if r.random() < 0.1 else w)
        rows.append((r.choice([k, 7, None]), r.choice([" ", "\n", "1", "_"]).join(words)))
    return rows + rows[:5] + [(3, None), (4, ""), (5, "z" * 4000 + " " + "z" * 3999 + "y"), (6, "z" * 4000 + " " + "z" * 3999 + "y"), (7, "z" * 4000 + " " + "z" * 3999 + "y")]


def got(df):
    return Counter((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_against_brute_force(spark):
    for seed in (1, 2):
        rows = texts(seed)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        expected = brute(rows)
        assert len(expected) > 100 and any(f and r != f for _, f, r, *_ in expected)
        assert got(variants.report(df)) == expected


def test_many_small_passes_give_the_same(spark, monkeypatch):
    rows = texts(3)
    monkeypatch.setattr(variants, "SEGMENT_BLOCKS", 4)
    assert len(variants.passes({5: 900, 6: 300}, 256)) > 5
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(variants.report(df, pass_bytes=512)) == brute(rows)


def test_odd_documents_and_empty_table(spark):
    assert got(variants.report(cases.odd_docs(spark))) == brute([(r[0], r[1]) for r in cases.odd_rows()])
    assert variants.report(cases.no_docs(spark)).collect() == []


def test_hashes_of_edits_are_those_of_the_edited_words():
    words = ["aabcé", "zzzzz", "abcde"]
    alphabet = np.array(sorted(map(ord, "abcdezé")), np.uint64)
    seen = set()
    for _, rows, places, char, h in variants.edits(words, alphabet):
        for k, (r, p) in enumerate(zip(rows.tolist(), places.tolist())):
            w = words[r][:p] + ("" if char is None else chr(int(char[k]))) + words[r][p + 1:]
            assert variants.hashes([w])[0] == h[k]
            assert (r, w) not in seen
            seen.add((r, w))
    assert (1, "zzzz") in seen and sum(len(w) == 4 and r == 1 for r, w in seen) == 1


def test_few_false_positives():
    words = [f"word{k:06d}" for k in range(20_000)]
    h = variants.hashes(words)
    blocks = variants.blocks_of(len(words))
    bits = np.zeros((blocks, variants.LANES), np.uint64)
    for lane in range(variants.LANES):
        np.bitwise_or.at(bits, (variants.block_of(h, blocks), lane), variants.lane_bits(h, lane))
    assert len(variants.contains(bits, 0, blocks, h)) == len(words)
    other = variants.hashes([f"rowd{k:06d}" for k in range(20_000)])
    assert len(variants.contains(bits, 0, blocks, other)) < 200


def test_oracle_agrees(spark, tmp_path):
    rows = [r for r in texts(4, 30) if r[0] is not None]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    cur = con.execute(queries.ORACLES["op12_spelling_variants"])
    at = [[d[0] for d in cur.description].index(c) for c in ("word", "form", "root", "n", "n_near", "form_n")]
    assert Counter(tuple(r[k] for k in at) for r in cur.fetchall()) == brute(rows)
