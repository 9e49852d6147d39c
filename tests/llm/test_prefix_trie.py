import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
from pyspark.sql import functions as F

from sitelens.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    return out


def brute(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        saved[node] = own + sum(saved[c] for c in children[node])
    return Counter(
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), leaves[n], saved[n],
         hashlib.sha256(",".join(map(str, sorted(c for c in m if convs[c] == n))).encode()).hexdigest())
        for n, m in members.items())


def conversations(seed, n, turns=9, texts=3):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        c = r.choice([k, k, 100 * k, k + 100])
        for t in range(r.randrange(1, turns)):
            rows.append((c, r.choice([t, t, t, None]), r.choice(["user", "assistant", None]) if r.random() < 0.2 else "user",
                         r.choice(["", None, "é😀" * 3, "a", "bb", "ccc"][:texts + 2])))
    return rows + rows[:7] + [(None, 1, "user", "x"), (None, None, None, None)]


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def got(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_nodes_against_brute_force(spark):
    for seed, n, turns, texts in ((1, 150, 9, 2), (2, 60, 30, 1), (3, 3, 2, 1)):
        rows = conversations(seed, n, turns, texts)
        df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit("z") for c in ("key", "keys", "first", "lo", "at", "n")})
        assert got(prefix_trie.report(df)) == brute(rows)


def test_nested_and_turnless_conversations(spark):
    """Every beginning of one long conversation is a conversation; ids whose shared beginning is absent may have no turn."""
    rows = [(100 * k, t, "user", f"t{t}") for k in range(14) for t in range(k + 1)]
    rows += [(c, 0, "user", "only") for c in range(100_001, 100_009)]
    assert () in rebuilt(rows).values()
    assert got(prefix_trie.report(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_a_very_long_conversation(spark):
    rows = [(0, t, "user", f"{t % 5}") for t in range(600)] + [(100, t, "user", f"{t % 5}") for t in range(300)] + [(200, 0, "user", "x" * 200_000)]
    assert got(prefix_trie.report(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_empty_table(spark):
    assert prefix_trie.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_two_insertions_give_the_trie_of_one(spark):
    df = spark.createDataFrame(conversations(5, 120), SCHEMA)
    all_paths = prefix_trie.distinct_paths(prefix_trie.paths(prefix_trie.rebuilt_turns(prefix_trie.turn_digests(df)))).cache()
    half = F.pmod(F.xxhash64("key"), F.lit(2)) == 0
    once = prefix_trie.insert(None, all_paths)
    twice = prefix_trie.insert(prefix_trie.insert(None, all_paths.where(half)), all_paths.where(~half))
    # the second insertion may leave nodes explicit that the first one does, and the other way round, never other edges
    assert sorted(map(tuple, once.select("first", "lo", "hi").collect())) == sorted(map(tuple, twice.select("first", "lo", "hi").collect()))


def test_a_hot_conversation_streams_its_members(spark):
    n = 3 << prefix_trie.CHUNK_BITS
    members = spark.range(n).select(F.lit(b"k").alias("key"), F.col("id").alias("conv_id"))
    row = prefix_trie.ends_digests(members).collect()
    assert [r.ends_sha256 for r in row] == [hashlib.sha256(",".join(map(str, range(n))).encode()).hexdigest()]


def test_oracle_agrees(spark, tmp_path):
    rows = conversations(7, 130)
    df = spark.createDataFrame(rows, SCHEMA)
    df.coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    cur = con.execute(queries.ORACLES["op11_prefix_trie"])
    at = [[d[0] for d in cur.description].index(c) for c in COLUMNS]
    assert Counter(tuple(r[k] for k in at) for r in cur.fetchall()) == brute(rows)
