"""Joins whose keys may be hot: rows of one key are split over many tasks, the other side's row is repeated.

``with_site`` is for the one row a site of ``sites``, where any site may hold most rows: sites of a measured small size are
broadcast, of more every row is repeated a fixed number of times, which is little beside the rows of their links.  ``spread_join`` is for a side with as many rows as there are keys: the hot keys are
counted first, and only their rows are repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.session import store

#: Tasks that share the rows of one site.
SITE_SALTS = 256
#: Characters of all sites' options up to which they are broadcast.
SITE_CHARS = 8 << 20
#: A key is hot from this part of a task's even share of all rows.
TASK_PART = 32
#: A key of no more rows than this is never split.
LEAST = 10_000


def with_site(rows: DataFrame, site: DataFrame, by: list[str], salts: int = SITE_SALTS, chars: int = SITE_CHARS) -> DataFrame:
    """``rows`` with the columns of their site: no task gets a site's rows for being that site's.

    ``site`` is measured first.  Up to ``chars`` characters it is broadcast; beyond, a site's rows are spread by the values
    of the columns ``by``.
    """
    size = site.agg(F.sum(F.length(F.to_json(F.struct(*site.columns))))).first()[0] or 0
    if size <= chars:
        return rows.join(F.broadcast(site), "site_id")
    each = site.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    return rows.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int")).join(each, ["site_id", "_salt"]).drop("_salt")


def _key(columns: list[str]) -> Column:
    return F.xxhash64(*columns)


def hot_keys(rows: DataFrame, keys: list[str], parts: int | None = None, least: int = LEAST) -> DataFrame:
    """(key hash, salts) of the keys with more rows than ``1 / TASK_PART`` of a task's even share, and than ``least``.

    At most ``TASK_PART`` x ``parts`` keys can have that many, so this table of two numbers a row has a bounded size
    whatever the input's.  Two keys with one hash are both split, which changes no result.  ``parts``: the session's
    number of shuffle partitions.
    """
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = store(rows.groupBy(_key(keys).alias("_key")).agg(F.count(F.lit(1)).alias("n")), "key-counts")
    limit = max((counts.agg(F.sum("n")).first()[0] or 0) / (TASK_PART * parts), least)
    return store(counts.filter(F.col("n") > limit).select("_key", F.ceil(F.col("n") / limit).cast("int").alias("_salts")), "hot-keys")


def spread_join(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str], by: list[str],
                hot: DataFrame, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on the keys; a hot key's rows of ``left`` are spread by the columns ``by``.

    ``how``: inner or left.  The keys of ``right`` stay under their own names, which ``left`` must not have.  Where no
    key is hot it is the plain join.
    """
    if hot.isEmpty():
        return left.join(right, [F.col(a) == F.col(b) for a, b in zip(left_keys, right_keys)], how)
    few = F.broadcast(hot)
    split = left.withColumn("_key", _key(left_keys)).join(few, "_key", "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(*by), F.col("_salts")).cast("int"), F.lit(0))).drop("_key", "_salts")
    every = right.withColumn("_key", _key(right_keys)).join(few, "_key", "left").withColumn(
        "_copy", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))).drop("_key", "_salts")
    on = [F.col(a) == F.col(b) for a, b in zip([*left_keys, "_salt"], [*right_keys, "_copy"])]
    return split.join(every, on, how).drop("_salt", "_copy")
