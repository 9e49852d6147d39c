"""Conversation prefix trie: a Z-fast trie held in tables and grown in batches.

A turn is a digest of its role and text; the key of a prefix is the exclusive or of the digests of its
(position, turn) pairs, 128 bits.  The trie is one table of compacted edges.  An edge covers the depths
(lo, hi] below the explicit node at ``lo`` and is known by its first key (at lo + 1); its handle is the
key at its two-fattest depth.  A path's exit edge is found by fat binary search: each step probes one
handle, and a hit jumps to the hit edge's extent.  The search takes as many joins as the greatest depth
has bits.

Inserting goes in batches.  All paths that leave the trie at one place by one turn are a group; the one
with the least hash of its key becomes a new edge, and the others are located again, below it, with the
next batch.  As that one is random, the number of batches grows with the logarithm of the paths.  Subtree
sums take a logarithm of the depth as well: every node adds to its 2^k-th ancestor.  At last every edge
is expanded to its depths.  Texts are never shuffled, only digests; equal paths are combined first.

Defined cases: a null role or text is empty; rows without conv_id are left out; turns are ordered with null
first, equal turns by the digest of role and text, and repeated rows are turns of their own; an empty table
gives no node; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.llm import common

GROUP, HEAD = 100, 6          # conversations that share a beginning; most turns shared, plus one
ROOT = "unhex(repeat('00', 16))"
CHUNK_BITS = 12               # ids joined in one string: those that agree but for so many bits
DIGESTS = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
EDGE = "first binary, lo int, hi int, keys array<binary>, cums array<long>, base long, parent binary"


def shared_turns(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEAD).cast("int")


def turn_digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, turn_key, n): the turns in order, from 0, with a digest and the text's code points."""
    c = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    c = c.select("conv_id", "turn", F.length("text").cast("long").alias("n"), F.sha2(F.concat(
        F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("turn_key"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "turn_key")
    return c.select("conv_id", (F.row_number().over(order) - 1).alias("at"), "turn_key", "n")


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, part, at, turn_key, n): the shared beginning (part 1), then the own turns (2); part 0 is one row a conversation."""
    heads = turns.where(F.col("at") < HEAD - 1).groupBy(F.col("conv_id").alias("head_id")) \
        .agg(F.sort_array(F.collect_list(F.struct("at", "turn_key", "n"))).alias("head"))
    one = turns.where("at = 0").select("conv_id", F.lit(0).alias("part"), F.lit(0).alias("at"),
                                       F.lit(None).cast("string").alias("turn_key"), F.lit(0).cast("long").alias("n"))
    begun = one.select("conv_id", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("head_id")) \
        .join(heads, "head_id").select("conv_id", F.explode(F.slice("head", F.lit(1), shared_turns(F.col("conv_id")))).alias("t")) \
        .select("conv_id", F.lit(1).alias("part"), "t.*")
    own = turns.where(F.col("at") >= shared_turns(F.col("conv_id"))).select("conv_id", F.lit(2).alias("part"), "at", "turn_key", "n")
    return one.unionByName(begun).unionByName(own)


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, keys, cums): for every depth from 0 the prefix's key and the code points so far."""
    order = Window.partitionBy("conv_id").orderBy("part", "at")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    t = turns.withColumn("d", F.row_number().over(order) - 1)
    mixed = F.sha2(F.concat(F.col("d").cast("string"), F.lit(":"), "turn_key"), 256)

    def word(at: int) -> Column:
        return F.coalesce(F.conv(F.substring(mixed, at, 16), 16, -10).cast("long"), F.lit(0).cast("long"))

    t = t.withColumns({"x": word(1), "y": word(17)})
    t = t.select("conv_id", "d", F.bit_xor("x").over(upto).alias("x"), F.bit_xor("y").over(upto).alias("y"),
                 F.sum("n").over(upto).alias("cum"))
    key = F.unhex(F.concat(F.lpad(F.hex("x"), 16, "0"), F.lpad(F.hex("y"), 16, "0")))
    t = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("d", key.alias("key"), "cum"))).alias("p"))
    return t.select("conv_id", F.col("p.key").alias("keys"), F.col("p.cum").alias("cums"))


def distinct_paths(rebuilt: DataFrame) -> DataFrame:
    """(key, keys, cums, ends, least): one row for all conversations with one path; copies are combined before the shuffle."""
    return rebuilt.groupBy(F.element_at("keys", -1).alias("key")).agg(
        F.first("keys").alias("keys"), F.first("cums").alias("cums"), F.count("*").alias("ends"), F.min("conv_id").alias("least"))


def two_fattest(a: Column, b: Column) -> Column:
    """The number in (a, b] that the greatest power of two divides."""
    low = F.length(F.bin(a.bitwiseXOR(b))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", b, low), low)


def _with_handles(edges: DataFrame) -> DataFrame:
    f = two_fattest(F.col("lo"), F.col("hi"))
    return edges.select(F.element_at("keys", f - F.col("lo")).alias("handle"), F.element_at("keys", -1).alias("h_ext"),
                        F.col("lo").alias("h_lo"), F.col("hi").alias("h_hi"))


def locate(pending: DataFrame, edges: DataFrame, widest: int) -> DataFrame:
    """Adds where each path leaves the trie: ``at`` (depth), ``edge`` (first key; null at a node) and its ``e_lo`` and ``e_hi``.

    ``known``: a depth at which the path is known to be at an explicit node; no path is longer than that by more than ``widest``.
    """
    handles = _with_handles(edges)
    size = F.size("keys") - 1
    p = pending.withColumns({"a": F.col("known"), "b": size, "out": F.lit(False)})
    nowhere = F.concat("key", F.expr("x'00'"))           # no key of the trie, and spread
    for _ in range(1 + (widest - 1).bit_length()):      # the first probe halves nothing, each other one what is left
        going = ~F.col("out") & (F.col("a") < F.col("b"))
        p = p.withColumn("f", F.when(going, two_fattest(F.col("a"), F.col("b"))))
        p = p.withColumn("probe", F.when(F.col("f").isNotNull(), F.get("keys", F.col("f"))).otherwise(nowhere))
        p = p.join(handles, p["probe"] == handles["handle"], "left")
        hit = F.col("handle").isNotNull()
        whole = hit & (F.col("h_hi") <= size) & (F.get("keys", F.col("h_hi")) == F.col("h_ext"))
        p = p.withColumns({
            "b": F.when(F.col("f").isNotNull() & ~hit, F.col("f") - 1).otherwise(F.col("b")),
            "a": F.when(whole, F.col("h_hi")).when(hit, F.col("h_lo")).otherwise(F.col("a")),
            "out": F.col("out") | (hit & ~whole)}).drop("handle", "h_ext", "h_lo", "h_hi", "f", "probe")
    p = p.withColumn("probe", F.when(F.col("a") < size, F.get("keys", F.col("a") + 1)).otherwise(nowhere))
    e = edges.select(F.col("first").alias("edge"), F.col("lo").alias("e_lo"), F.col("hi").alias("e_hi"), F.col("keys").alias("e_keys"))
    p = p.join(e, p["probe"] == e["edge"], "left")
    same = F.size(F.filter(F.zip_with("e_keys", F.slice("keys", F.col("a") + 2, F.size("e_keys")), lambda x, y: x == y),
                           lambda s: F.coalesce(s, F.lit(False))))
    return p.withColumn("at", F.when(F.col("edge").isNull(), F.col("a")).otherwise(F.col("a") + same)) \
        .drop("a", "b", "out", "probe", "e_keys")


def split_edges(edges: DataFrame, cuts: DataFrame) -> DataFrame:
    """``edges`` with explicit nodes at the depths of ``cuts`` (edge, at)."""
    by_edge = cuts.groupBy("edge").agg(F.collect_set("at").alias("depths"))
    e = edges.join(by_edge, edges["first"] == by_edge["edge"], "left").drop("edge")
    bounds = F.array_sort(F.array_distinct(F.concat(F.array("lo", "hi"), F.coalesce("depths", F.array().cast("array<int>")))))
    e = e.withColumn("bounds", bounds)
    e = e.withColumn("part", F.explode(F.arrays_zip(F.slice("bounds", F.lit(1), F.size("bounds") - 1).alias("l"),
                                                    F.slice("bounds", F.lit(2), F.size("bounds")).alias("h"))))
    off, n = F.col("part.l") - F.col("lo"), F.col("part.h") - F.col("part.l")
    return e.select(F.element_at("keys", off + 1).alias("first"), F.col("part.l").alias("lo"), F.col("part.h").alias("hi"),
                    F.slice("keys", off + 1, n).alias("keys"), F.slice("cums", off + 1, n).alias("cums"),
                    F.when(off == 0, F.col("base")).otherwise(F.get("cums", off - 1)).alias("base"),
                    F.when(off == 0, F.col("parent")).otherwise(F.get("keys", off - 1)).alias("parent"))


def insert(edges: DataFrame | None, new: DataFrame) -> DataFrame:
    """The edges of the trie with the paths of ``new`` (key, keys, cums) in it; ``edges``: of an earlier call, None at first."""
    spark = new.sparkSession
    pending = common.stage(new.select("key", "keys", F.lit(0).alias("known")).where(F.size("keys") > 1), "trie-pending")
    edges = edges if edges is not None else spark.createDataFrame([], EDGE)
    while widest := pending.agg(F.max(F.size("keys") - 1 - F.col("known"))).first()[0]:
        found = common.stage(locate(pending, edges, widest), "trie-located")
        leaving = found.where(F.col("at") < F.size("keys") - 1)
        chosen = leaving.groupBy(F.get("keys", F.col("at") + 1).alias("first")).agg(
            F.min(F.struct(F.xxhash64("key").alias("order"), "key", "at")).alias("p"))
        chosen = common.stage(chosen.select("first", "p.key", "p.at").join(new.select("key", "keys", "cums"), "key"), "trie-chosen")
        at, n = F.col("at"), F.size("keys")
        grown = chosen.select(
            "first", F.col("at").alias("lo"), (n - 1).alias("hi"), F.slice("keys", at + 2, n).alias("keys"),
            F.slice("cums", at + 2, n).alias("cums"), F.get("cums", at).alias("base"), F.get("keys", at).alias("parent"))
        cuts = found.where((F.col("e_lo") < at) & (at < F.col("e_hi"))).select("edge", "at").distinct()
        edges = common.stage(split_edges(edges, cuts).unionByName(grown), "trie-edges")
        pending = common.stage(leaving.join(chosen.select("key"), "key", "left_anti")
                               .select("key", "keys", F.col("at").alias("known")), "trie-pending")
    return edges


def subtree_sums(edges: DataFrame, ends: DataFrame) -> DataFrame:
    """(node, n, least, total, fresh, leaves, children): sums over the subtree of every explicit node, the root included.

    n: members; least: smallest member; total: code points of all members' whole paths; fresh: those of the
    subtree's edges, the node's own included; leaves: childless nodes; children: of the node itself.
    """
    children = edges.groupBy(F.col("parent").alias("p_node")).agg(F.count("*").alias("children"))
    root = edges.sparkSession.range(1).select(F.expr(ROOT).alias("node"), F.lit(None).cast("binary").alias("jump"), F.lit(0).cast("long").alias("fresh"))
    nodes = edges.select(F.element_at("keys", -1).alias("node"), F.col("parent").alias("jump"),
                         (F.element_at("cums", -1) - F.col("base")).alias("fresh")).unionByName(root)
    ends = ends.select(F.col("key").alias("e_node"), F.col("ends").alias("n"), "least", (F.col("ends") * F.element_at("cums", -1)).alias("total"))
    t = nodes.join(children, F.col("node") == F.col("p_node"), "left").join(ends, F.col("node") == F.col("e_node"), "left").select(
        "node", "jump", "fresh", F.coalesce("n", F.lit(0)).alias("n"), "least", F.coalesce("total", F.lit(0)).alias("total"),
        F.coalesce("children", F.lit(0)).alias("children"), F.when(F.col("children").isNull(), 1).otherwise(0).cast("long").alias("leaves"))
    t = common.stage(t, "trie-sums")
    while not t.where("jump is not null").isEmpty():
        up = t.where("jump is not null").groupBy(F.col("jump").alias("to")).agg(
            *[F.sum(c).alias(f"{c}_up") for c in ("n", "total", "fresh", "leaves")], F.min("least").alias("least_up"))
        nowhere = F.concat("node", F.expr("x'00'"))
        over = t.select(F.col("node").alias("over"), F.col("jump").alias("next"))
        t = t.withColumn("probe", F.coalesce("jump", nowhere)).join(over, F.col("probe") == F.col("over"), "left") \
            .join(up, F.col("node") == F.col("to"), "left").select(
            "node", F.col("next").alias("jump"), "children", F.least("least", "least_up").alias("least"),
            *[(F.col(c) + F.coalesce(f"{c}_up", F.lit(0))).alias(c) for c in ("n", "total", "fresh", "leaves")])
        t = common.stage(t, "trie-sums")
    return t


def ends_digests(members: DataFrame) -> DataFrame:
    """(key, ends_sha256): digest of the ids of (key, conv_id), ascending and comma-joined.

    Ids are joined natively in bounded chunks; a hash is sequential, so a task streams a key's chunks
    through it and holds one batch at a time, however many members the key has.
    """
    chunks = members.groupBy("key", F.shiftright("conv_id", CHUNK_BITS).alias("chunk")) \
        .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    chunks = chunks.repartition("key").sortWithinPartitions("key", "chunk").select("key", "ids")

    def task(batches):
        current, digest = None, None
        for keys, ids in common.arrow_rows(batches, ("key", "ids")):
            done = []
            for key, text in zip(keys, ids):
                if key != current:
                    if current is not None:
                        done.append((current, digest.hexdigest()))
                    current, digest = key, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
            if done:
                yield common.record_batch(DIGESTS, *zip(*done))
        if current is not None:
            yield common.record_batch(DIGESTS, [current], [digest.hexdigest()])

    return chunks.mapInArrow(task, "key binary, ends_sha256 string")


def expand(edges: DataFrame, sums: DataFrame, digests: DataFrame) -> DataFrame:
    """One row a depth-d node: every edge covers the depths (lo, hi], which share members and leaves."""
    above = sums.select(F.col("node").alias("a_node"), F.col("least").alias("above"))
    digests = digests.withColumnRenamed("key", "d_node")
    root = edges.sparkSession.range(1).select(
        F.expr(ROOT).alias("r_node"), F.lit(None).cast("binary").alias("parent"), F.lit(-1).alias("lo"), F.lit(0).alias("hi"),
        F.lit(0).cast("long").alias("base"), F.array(F.lit(0).cast("long")).alias("cums"))
    e = edges.select(F.element_at("keys", -1).alias("r_node"), "parent", "lo", "hi", "base", "cums").unionByName(root)
    e = e.join(sums, F.col("r_node") == F.col("node")).join(digests, F.col("node") == F.col("d_node"), "left") \
        .join(above, F.col("parent") == F.col("a_node"), "left")
    e = e.withColumn("depth", F.explode(F.sequence(F.col("lo") + 1, F.col("hi"))))
    before = F.when(F.col("depth") == F.col("lo") + 1, F.col("base")).otherwise(F.get("cums", F.col("depth") - F.col("lo") - 2))
    last = F.col("depth") == F.col("hi")
    return e.where("n > 0").select(
        F.col("least").alias("conv_id"), F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") == F.col("lo") + 1, F.col("above")).otherwise(F.col("least")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.col("children")).otherwise(1).alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("total") - F.col("n") * before - (F.col("fresh") - (before - F.col("base")))).alias("saved_tokens"),
        F.coalesce(F.when(last, F.col("ends_sha256")), F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def report(conversations: DataFrame) -> DataFrame:
    """All nodes of the trie of the rebuilt conversations."""
    common.session(conversations)
    turns = common.stage(turn_digests(conversations), "trie-turns")
    rebuilt = common.stage(paths(rebuilt_turns(turns)), "trie-paths")
    distinct = common.stage(distinct_paths(rebuilt), "trie-distinct")
    edges = insert(None, distinct)
    members = rebuilt.select(F.element_at("keys", -1).alias("key"), "conv_id")
    return expand(edges, subtree_sums(edges, distinct), ends_digests(members))
