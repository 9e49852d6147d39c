"""Canonical-URL table jobs: U7 (spelling groups) and G3 (first claim per key)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions import urls as U


def canonical_groups(df: DataFrame, url_col: str, order_col: str) -> DataFrame:
    """(norm_url, n, n_variants, first_variant) -- the equivalence behind every claim map.

    One aggregation keyed by the canonical URL; partial aggregation runs map-side, so a URL that
    holds a large share of the rows is combined before the shuffle.
    """
    canon = U.canonicalize_urls(df.select(url_col, order_col), url_col)
    key = F.coalesce(F.col("norm_url"), F.col(url_col))
    return canon.groupBy(key.alias("norm_url")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(F.col(url_col)).alias("n_variants"),
        F.min_by(F.col(url_col), F.struct(order_col, url_col)).alias("first_variant"))


def dedupe_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row per key by an explicit order (deterministic, unlike dropDuplicates)."""
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in others])
    first = df.groupBy(*keys).agg(F.min_by(packed, F.struct(*[F.col(c) for c in order])).alias("_first"))
    return first.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in others])
