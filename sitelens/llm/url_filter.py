"""URL filter: host and path rules, and logistic regression on hashed character n-grams for the rest.

All of it is DataFrame work: URLs are cut, hashed and scored by column expressions, and training is
full-batch gradient descent (AdaGrad) whose gradient is one aggregation a step over a small table of
labelled URLs.  The driver only holds the ``SLOTS`` weights, which enter the next step, and the
scoring of all pages, as one constant array.

Defined cases: a null URL and one without ``://`` have an empty host and path and get the verdict of
the bias; equal long rules cannot both fit one URL; without labelled URLs the verdict is allow;
repeated rows are each judged; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


SLOTS = 1 << 12
GRAMS = (3, 4)
LABELLED = 1000         # labelled URLs of each verdict that training may see
STEPS = 25
RATE, RIDGE = 0.5, 1e-3


def host_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest of ``rules`` (host and path -> verdict) that fits, or null.  Rules are a short parameter."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, rule).otherwise(out)
    return out


def verdict_of(rule: Column, rules: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for r, v in rules.items():
        out = F.when(rule == r, v).otherwise(out)
    return out


def features(host: Column, path: Column) -> Column:
    """Distinct slots of the n-grams of ^host$ and ^path$; slot 0 is the bias."""
    def grams(mark: str, text: Column, n: int) -> Column:
        whole = F.concat(F.lit("^"), text, F.lit("$"))
        starts = F.when(F.length(whole) >= n, F.sequence(F.lit(1), F.length(whole) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: (F.pmod(F.xxhash64(F.lit(mark), F.substring(whole, i, n)), F.lit(SLOTS - 1)) + 1).cast("int"))
    return F.array_distinct(F.concat(F.array(F.lit(0)), *[grams(m, t, n) for m, t in (("h", host), ("p", path)) for n in GRAMS]))


def score(slots: Column, weights: list[float]) -> Column:
    w = F.split(F.lit(",".join(repr(x) for x in weights)), ",").cast("array<double>")
    total = F.aggregate(slots, F.lit(0.0), lambda acc, i: acc + F.get(w, i))
    return 1 / (1 + F.exp(-total))


def train(labelled: DataFrame) -> list[float]:
    """Weights from (host, path, label); label 1 is block."""
    rows = labelled.select(features(F.col("host"), F.col("path")).alias("slots"), F.col("label").cast("double").alias("label")).persist()
    weights, squares = [0.0] * SLOTS, [0.0] * SLOTS
    try:
        n = rows.count()
        for _ in range(STEPS if n else 0):
            gradient = (rows.select("slots", (score(F.col("slots"), weights) - F.col("label")).alias("g"))
                        .select(F.explode("slots").alias("slot"), "g").groupBy("slot").agg(F.sum("g").alias("g")).collect())
            for slot, g in gradient:
                g = round(g, 9) / n + (RIDGE * weights[slot] if slot else 0.0)
                squares[slot] += g * g
                weights[slot] -= RATE * g / (math.sqrt(squares[slot]) + 1e-9)
    finally:
        rows.unpersist()
    return weights


def parsed(pages: DataFrame, rules: dict[str, str]) -> DataFrame:
    host, path = host_path(F.col("url"))
    return pages.select(F.col("page_id"), host.alias("host"), path.alias("path")) \
        .withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))


def labelled_by_rules(pages: DataFrame, rules: dict[str, str], per_verdict: int = LABELLED) -> DataFrame:
    """A small table of labelled URLs: of those that a rule decides, at most ``per_verdict`` of each verdict.

    Chosen by the hash of host and path, among distinct pairs; it is what the operator takes as its
    labelled table where none is given.
    """
    rows = parsed(pages, rules).where(F.col("rule").isNotNull()) \
        .select("host", "path", (verdict_of(F.col("rule"), rules) == "block").cast("int").alias("label"))
    counts = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    rows = rows.withColumn("u", F.xxhash64("host", "path"))
    parts = []
    for label, n in sorted(counts.items()):
        share = min(1.0, 4.0 * per_verdict / n)
        parts.append(rows.where((F.col("label") == label) & (F.pmod("u", F.lit(1 << 30)) < share * (1 << 30)))
                     .distinct().orderBy("u", "host", "path").limit(per_verdict))
    out = rows.where(F.lit(False))
    for p in parts:
        out = out.unionByName(p)
    return out.drop("u")


def judge(pages: DataFrame, rules: dict[str, str], labelled: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and the method's score for every page.

    ``labelled``: (url, label) with label 1 for block; without it, URLs that a rule decides are taken.
    """
    if labelled is None:
        table = labelled_by_rules(pages, rules)
    else:
        host, path = host_path(F.col("url"))
        table = labelled.select(host.alias("host"), path.alias("path"), "label")
    weights = train(table)
    p = score(features(F.col("host"), F.col("path")), weights)
    return parsed(pages, rules).withColumn("score", p).select(
        "page_id", "host", "path", "rule",
        F.coalesce(verdict_of(F.col("rule"), rules), F.when(F.col("score") > 0.5, "block").otherwise("allow")).alias("verdict"), "score")
