"""Secret scan with multipart credential linking.

Three base kinds of matches are always reported.  Three weak kinds (named identifiers, random-looking
keys, endpoints) are only reported when a complementary part lies within ``SCOPE`` code points of
their start: an identifier needs a secret, a key needs an identifier, an endpoint needs both.  Parts are
different places of the text: a part never supports one that it overlaps, a secret that overlaps an
identifier is the identifier's own value, a key that overlaps an endpoint is its path, and neither is a part.  The interval join of the parts is a window
over each document with RANGE frames: the nearest ends before a part and the farthest starts behind it say
whether some part of a kind is in reach and disjoint, without forming pairs.

Spark has no function for the place of a match; it follows from the lengths of the pieces between
the matches, summed up within the document.  Only DataFrame functions are used, and the text is
read once: lengths of pieces and matches are all that is staged or shuffled.

Defined cases: a null text is empty; documents without a match have zero counts and empty strings
(the digest is that of the empty string); rows repeated with all values are each reported; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitelens.llm import common

SCOPE = 200

#: kind -> (pattern, group whose length counts, its least length); in the order in which kinds sort.
BASE = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),      # runs of 24 or more are the matches of [0-9a-f]+ that do not fail
}
WEAK = {
    "id": (r"""(?i:access_?key_?id|client_?id|account_?id|user_?name|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._+-]+)""", 1, 3),
    "key": (r"[A-Za-z0-9+/_=-]{32,}", 0, 32),
    "endpoint": (r"""(?i:https?|ftp|ssh|postgresql|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D"'<>]+""", 0, 10),
}
KINDS = BASE | WEAK
ORDER = {kind: k for k, kind in enumerate(KINDS)}
IDENTIFIERS, SECRETS = ("access", "id"), ("assign", "hex", "key")


def _matches(text: Column, kind: str) -> Column:
    """Array of (kind, k, gap before the match from the end of the last, length, whether it counts)."""
    pattern, group, least = KINDS[kind]
    regex = F.lit(pattern)
    pieces, whole = F.split(text, pattern, -1), F.regexp_extract_all(text, regex, F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, regex, F.lit(group))
    counts = F.transform(value, lambda v: F.length(v) >= least)
    if kind == "key":
        counts = F.transform(whole, lambda v: v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]"))
    found = F.transform(
        F.arrays_zip(F.slice(pieces, F.lit(1), F.size(whole)).alias("p"), whole.alias("w"), counts.alias("c")),
        lambda m, k: F.struct(F.lit(ORDER[kind]).alias("kind"), k.alias("k"), F.length(m["p"]).cast("long").alias("gap"),
                              F.length(m["w"]).cast("long").alias("size"), m["c"].alias("counts")))
    none = F.array().cast("array<struct<kind:int,k:int,gap:bigint,size:bigint,counts:boolean>>")
    return F.when(text.rlike(pattern), found).otherwise(none)


def matches(docs: DataFrame) -> DataFrame:
    """(row_id, doc_id, found), staged: the matches of every row by kind, without their text."""
    rows = common.id_text(docs).select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id",
        F.concat(*[_matches(F.col("text"), kind) for kind in KINDS]).alias("found"))
    return common.stage(rows, "secrets")


def spans(found: DataFrame) -> DataFrame:
    """(row_id, kind, start, end) of all base matches and of the weak ones that complementary parts support."""
    parts = found.select("row_id", F.explode("found").alias("m")).select("row_id", "m.*").repartition("row_id")
    before = Window.partitionBy("row_id", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before)) \
        .where("counts").select("row_id", "kind", (F.col("end") - F.col("size")).alias("start"), "end")
    kinds = {name: F.col("kind").isin([ORDER[k] for k in some]) for name, some in (("secret", SECRETS), ("identifier", IDENTIFIERS))}
    by_start = Window.partitionBy("row_id").orderBy("start")
    from_end = Window.partitionBy("row_id").orderBy(F.desc("start"))
    upto = (Window.unboundedPreceding, Window.currentRow)
    def overlaps(which: Column) -> Column:
        return F.coalesce(F.max(F.when(which, F.col("end"))).over(by_start.rangeBetween(*upto)) > F.col("start"), F.lit(False)) \
            | F.coalesce(F.min(F.when(which, F.col("start"))).over(from_end.rangeBetween(*upto)) < F.col("end"), F.lit(False))

    is_key = F.col("kind") == ORDER["key"]
    parts = parts.withColumn("own", (kinds["secret"] & overlaps(kinds["identifier"])) | (is_key & overlaps(F.col("kind") == ORDER["endpoint"])))

    def reach(name: str) -> Column:
        counts = kinds[name] & ~F.col("own")
        before = F.min(F.when(counts, F.col("end"))).over(by_start.rangeBetween(-SCOPE, 0)) <= F.col("start")
        behind = F.max(F.when(counts, F.col("start"))).over(by_start.rangeBetween(0, SCOPE)) >= F.col("end")
        return F.coalesce(before, F.lit(False)) | F.coalesce(behind, F.lit(False))

    kind = F.col("kind")
    supported = (kind < len(BASE)) | ((kind == ORDER["id"]) & F.col("secret")) | (is_key & ~F.col("own") & F.col("identifier")) \
        | ((kind == ORDER["endpoint"]) & F.col("secret") & F.col("identifier"))
    return parts.withColumns({name: reach(name) for name in kinds}).where(supported).select("row_id", "kind", "start", "end")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row."""
    rows = matches(docs)
    names = F.array(*[F.lit(k) for k in KINDS])
    per_row = spans(rows).groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("s"))
    joined = rows.select("row_id", "doc_id").join(per_row, "row_id", "left") \
        .withColumn("s", F.coalesce("s", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")))

    def text(some: Column) -> Column:
        return F.array_join(F.transform(some, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("s", lambda x: x["kind"] == ORDER[kind])).cast("long").alias(f"n_{kind}")

    base = F.filter("s", lambda x: x["kind"] < len(BASE))
    return joined.select("doc_id", *[count(k) for k in BASE], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("s")).alias("spans"))
