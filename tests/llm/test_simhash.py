import random

import xxhash

from sitelens.llm import simhash
from tests.llm import cases


def brute_fingerprint(text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius=simhash.RADIUS):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def test_odd_documents(spark):
    rows = cases.odd_rows()
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    roots = brute_components(fps)
    least = {r: min((rows[k][0] for k in range(len(rows)) if roots[k] == r and rows[k][0] is not None), default=None) for r in roots}
    expected = [(rows[k][0], format(fps[k], "016x"), least[roots[k]]) for k in range(len(rows))]
    key = lambda r: tuple((x is not None, x or 0) if not isinstance(x, str) else x for x in r)
    assert sorted(map(tuple, simhash.report(cases.odd_docs(spark)).collect()), key=key) == sorted(expected, key=key)


def test_one_row_of_each_component_stays(spark):
    docs = cases.odd_docs(spark)
    out = simhash.drop_near_copies(docs)
    fps = [brute_fingerprint(t) for _, t, *_ in cases.odd_rows()]
    assert out.columns == docs.columns
    assert out.count() == len(set(brute_components(fps)))


def test_empty_table(spark):
    assert simhash.report(cases.no_docs(spark)).collect() == []


def test_links_connect_what_lies_within_the_radius(spark, monkeypatch):
    """Chains and dense balls, in shards far larger than a tree."""
    monkeypatch.setattr(simhash, "TREE", 5)
    r = random.Random(1)
    fps = {r.getrandbits(64) for _ in range(100)}
    for centre in list(fps)[:4]:
        x = centre
        for _ in range(25):
            x ^= sum(1 << b for b in r.sample(range(64), r.randrange(1, 5)))
            fps.add(x)
    for _ in range(60):
        fps.add(r.choice([0, (1 << 64) - 1]) ^ sum(1 << b for b in r.sample(range(64), r.randrange(4))))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)
    links = [tuple(x) for x in simhash.links(nodes).collect()]
    assert all(((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3 for a, b in links)
    found = {x.node: x.root for x in simhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    groups = {}
    for f, root in zip(signed, brute_components(fps)):
        groups.setdefault(root, set()).add(f)
    for members in groups.values():
        assert {found.get(f, f) for f in members} == {min(members)}


def test_components_of_a_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(40)]
    star = [(1000, 1000 + k) for k in range(1, 200)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(path + star, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {1000 + k: 1000 for k in range(1, 200)}


def test_bk_tree():
    r = random.Random(2)
    keys = [r.getrandbits(12) for _ in range(300)]
    tree = simhash.BkTree()
    for k in keys:
        tree.add(k)
    assert sorted(tree.key) == sorted(set(keys))
    for q in keys[:50]:
        assert sorted(tree.within(q, 2)) == sorted({k for k in keys if (k ^ q).bit_count() <= 2})
