"""SimHash near-dedup with BK-trees.

Fingerprints that differ in at most ``RADIUS`` of their 64 bits link; groups are what links connect.
Distinct fingerprints stand for all their documents, so a group of copies is one node.

Candidate search: the bits are cut into ``BLOCKS`` blocks; two fingerprints within the radius agree
in at least ``BLOCKS - RADIUS`` of them.  Every choice of that many blocks is a table, and every value
in a table is a shard with a BK-tree of its own: a node's children are keyed by their integer
Hamming distance to it, and a query follows only the edges within the radius of its own distance.
A shard of more than ``TREE`` fingerprints is cut into trees of about that size, each of which is sent
to all queries of the shard, in separate groups of rows, so no task holds more than two trees'
worth.  Inside a group only a spanning forest of the links leaves the task.  Links are then
contracted to components by alternating large-star and small-star rounds.

Defined cases: null and empty texts have fingerprint 0 and link like any other; a null doc_id never
is a component's id unless all ids are null; rows repeated with all values share their component;
an empty table gives no rows; other columns are ignored (``drop_near_copies`` passes them through).
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.llm import common

RADIUS = 3
BLOCKS = 5
SHINGLE = 3
TREE = 1024
AT_ONCE = 1 << 15     # shingles of one document whose bits are counted at once


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Majority bits over the XXH64 (seed 42) of the word shingles; only A-Z are lower-cased."""
    import xxhash
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    parts = [words[k:] for k in range(min(shingle, len(words)))]
    hashes = map(xxhash.xxh64_intdigest, map(b" ".join, zip(*parts)), repeat(42))
    n = len(parts[-1])
    ones = np.zeros(64, np.int64)
    for at in range(0, n, AT_ONCE):
        h = np.fromiter(hashes, ">u8", min(AT_ONCE, n - at))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp), staged; fp is the fingerprint as a signed 64-bit integer."""
    common.session(docs)
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def task(batches):
        for ids, texts, seen in common.arrow_rows(batches, ("doc_id", "text", "text_hash")):
            fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield common.record_batch(schema, ids, seen, fps)

    rows = common.id_text(docs).withColumn("text_hash", F.xxhash64("text"))
    return common.stage(rows.mapInArrow(task, "doc_id long, text_hash long, fp long"), "fingerprints")


class BkTree:
    def __init__(self):
        self.key: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, key: int) -> None:
        """A key that is there already is not added again."""
        if self.key:
            at = 0
            while d := (self.key[at] ^ key).bit_count():
                nxt = self.children[at].setdefault(d, len(self.key))
                if nxt == len(self.key):
                    break
                at = nxt
            else:
                return
        self.key.append(key)
        self.children.append({})

    def within(self, key: int, radius: int) -> list[int]:
        found, todo = [], [0] if self.key else []
        while todo:
            at = todo.pop()
            d = (self.key[at] ^ key).bit_count()
            if d <= radius:
                found.append(self.key[at])
            edges = self.children[at]
            todo += [edges[e] for e in range(d - radius, d + radius + 1) if e in edges]
        return found


def block_edges() -> list[tuple[int, int]]:
    """(first bit, bits) of every block, from the lowest bit up."""
    cuts = [64 * k // BLOCKS for k in range(BLOCKS + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def shard_keys(fp: Column, radius: int) -> Column:
    """One 64-bit key for each table: the values of the chosen blocks, hashed with the table's number."""
    blocks = [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << n) - 1)) for a, n in block_edges()]
    return F.array(*[F.xxhash64(F.lit(t), *[blocks[b] for b in chosen])
                     for t, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - radius))])


def _forest(members: list[tuple[int, int]], lo: int, hi: int, radius: int, out: list) -> None:
    """Append the links of one group that join two of its trees so far: at most one fewer than its members."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    def link(x, found):
        for y in found:
            a, b = root(x), root(y)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((x, y))

    mask, tree = (1 << 64) - 1, BkTree()
    signed = lambda u: u - (1 << 64) if u >> 63 else u
    for chunk, fp in members:
        u = fp & mask
        if chunk == hi or lo == hi:
            link(fp, [signed(x) for x in tree.within(u, radius) if x != u])
        if chunk == lo:
            tree.add(u)


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all that lie within the radius."""
    if not 0 <= radius < BLOCKS:
        raise ValueError(f"radius must be below {BLOCKS}")
    shards = nodes.select("fp", F.explode(shard_keys(F.col("fp"), radius)).alias("shard"))
    large = shards.groupBy("shard").count().where(F.col("count") > TREE)
    large = common.stage(large.select("shard", F.ceil(F.col("count") / TREE).cast("int").alias("trees")), "large-shards")
    trees = F.coalesce("trees", F.lit(1))
    rows = (shards.join(large, "shard", "left")
            .withColumn("chunk", F.pmod(F.xxhash64("fp"), trees).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), trees - 1)))
            .select("shard", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "chunk", "fp"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def task(batches):
        held: list[tuple] = []

        def groups(rows, last):
            """Links of all complete groups; the rows of the last one stay held unless this is the end."""
            out: list[tuple[int, int]] = []
            start = 0
            for k in range(1, len(rows) + 1):
                if k == len(rows) and not last:
                    break
                if k == len(rows) or rows[k][:3] != rows[start][:3]:
                    if k - start > 1:
                        _forest([r[3:] for r in rows[start:k]], rows[start][1], rows[start][2], radius, out)
                    start = k
            held[:] = rows[start:] if not last else []
            return out

        for cols in common.arrow_rows(batches, ("shard", "lo", "hi", "chunk", "fp")):
            out = groups(held + list(zip(*cols)), False)
            if out:
                yield common.record_batch(schema, [a for a, _ in out], [b for _, b in out])
        if out := groups(held, True):
            yield common.record_batch(schema, [a for a, _ in out], [b for _, b in out])

    return rows.repartition("shard", "lo", "hi").sortWithinPartitions("shard", "lo", "hi", "chunk", "fp") \
        .mapInArrow(task, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of a link and the smallest node that links reach from it.

    Large-star and small-star rounds in turn; each round's links are staged in the shared folder.
    The least neighbour of a node comes from an aggregation that is staged, too, so the join with it
    shuffles two plain tables and AQE can split a node with very many links.
    """
    def least(pairs: DataFrame) -> DataFrame:
        return common.stage(pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")

    def oriented(pairs: DataFrame) -> DataFrame:
        return common.stage(pairs.where("a != b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")

    edges = oriented(edges)
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")) \
            .unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        edges = oriented(both.join(least(both), "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")))
        down = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        small = down.join(least(down), "u")
        edges = oriented(small.select(F.col("v").alias("a"), F.col("m").alias("b"))
                         .unionByName(small.select(F.col("u").alias("a"), F.col("m").alias("b"))))
        n, nodes = edges.agg(F.count("a"), F.count_distinct("a")).first()
        if n == nodes and edges.select("b").join(edges.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def classes(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every row."""
    rows = fingerprints(docs, shingle)
    nodes = common.stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    found = components(common.stage(links(nodes, radius), "links"))
    rooted = common.stage(nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left")
                          .select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    ids = common.stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    of_node = common.stage(rooted.join(ids, "root").select("fp", "root", "component_id"), "classes")
    return rows.join(of_node, "fp")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    return classes(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: of each component the one with the smallest doc_id."""
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    stay = classes(docs, shingle, radius).groupBy("root").agg(first)
    key, keep = common.fresh(docs, "text_hash"), common.fresh(docs, "keep_id")
    stay = stay.select(F.col("first.text_hash").alias(key + "_k"), F.col("first.doc_id").alias(keep))
    return (docs.withColumn(key, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
            .join(stay, (F.col(key) == F.col(key + "_k")) & F.col("doc_id").cast("long").eqNullSafe(F.col(keep)), "left_semi")
            .dropDuplicates([key, "doc_id"]).drop(key))
