"""A corpus for language-model training, made in five stages from ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's rows as
Parquet in the shared folder and reads them again as the next one's input.  All stages but the last
return the columns of ``documents`` and only leave rows out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm import bpe, common, decontaminate, exact_dedup, language_id, queries, simhash


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that it calls ``und`` go: those without text or without a letter, and all where no language is learned.

    Repeated rows are judged each on its own; an empty table gives none.
    """
    return language_id.keep_identified(docs, language_id.fit(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of documents with equal texts (null: empty) the longest stays, of ties the smallest doc_id, of repeated rows one."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of documents that SimHash links connect, the one with the smallest doc_id stays; texts without words are linked."""
    return simhash.drop_near_copies(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that hold a benchmark item go; null and empty texts hold none, an empty benchmark drops nothing."""
    return decontaminate.keep_clean(docs, common.table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the ids of every text (null or empty: none), and the digest of the bytes that they decode to."""
    encoded = bpe.encode(docs, queries.ranks_path(), queries.split_pattern(), lists=True)
    return encoded.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [("language_id", identify), ("exact_dedup", exact), ("simhash", near), ("decontaminate", clean), ("byte_bpe", encode)]

#: Several stages are not SQL: tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stage(stage(spark, docs, sf_dir), name)
    return docs
