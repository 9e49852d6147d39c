"""Exact dedup with a persistent digest index.

The index is a table bucketed and sorted by the SHA-256 of the normalised text, one row for each
distinct text.  New data is reduced to one candidate a digest (combined on the map side, so a text
that a third of all rows share costs one row a task), cleared of known digests by a sort-merge
anti-join that reads the index bucket by bucket without a shuffle, and the rest is appended.

Defined cases: a null text equals an empty one; a null doc_id loses against any other; rows repeated
with all their values count as members of their group, and exactly one row of a group stays; an
empty table gives no rows; other columns are ignored (``drop_copies`` passes them through).  An index
keeps its bucket count beside it and refuses another one; a batch that is run again under its id gets the
decisions of its first run.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm import common

#: Characters that do not count in a comparison: blank and U+0009 to U+000D.
IGNORED = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), IGNORED, "")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


class DigestIndex:
    """Digest -> the row that stays (row_id, doc_id), its length; ``group_size`` counts its batch."""

    COLUMNS = "digest binary, keep_id long, keep_row long, n_points long, group_size long, batch string"

    def __init__(self, spark: SparkSession, name: str | None = None, path: str | None = None, buckets: int | None = None):
        """``name`` and ``path`` of an index that exists open it again, in another session too, with the bucket count it was made with."""
        self.spark = spark
        self.name = name or f"digest_index_{uuid.uuid4().hex}"
        self.path = path or common.shared_path(spark, "digest-index")
        made_with = self._layout() if path else None
        if made_with and buckets and buckets != made_with:
            raise ValueError(f"the index has {made_with} buckets, not {buckets}")
        self.buckets = made_with or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if not made_with:
            spark.createDataFrame([(self.buckets,)], "buckets int").coalesce(1).write.json(self.path + "-layout")
        if not spark.catalog.tableExists(self.name):
            spark.sql(f"CREATE TABLE {self.name} ({self.COLUMNS}) USING parquet LOCATION '{self.path}' "
                      f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS")

    def _layout(self) -> int | None:
        """The bucket count that the index at ``path`` was made with; None where there is no index."""
        try:
            return self.spark.read.schema("buckets int").json(self.path + "-layout").first().buckets
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def unbucketed(self) -> DataFrame:
        """The same rows without the bucket layout: a join shuffles both sides, and AQE can split a hot digest."""
        return self.spark.read.schema(self.COLUMNS).parquet(self.path)

    def append_new(self, digests: DataFrame, batch: str) -> None:
        """Append one row for each digest of ``digests`` (row_id, doc_id, n_points, digest) that is not there yet, in one commit."""
        best = digests.groupBy("digest").agg(
            F.max(F.struct("n_points", (-F.col("doc_id")).alias("doc"), (-F.col("row_id")).alias("row"))).alias("best"),
            F.count(F.lit(1)).alias("group_size"))
        best = common.stage(best, "candidates")     # else the optimizer joins all rows first and combines them later
        new = best.hint("merge").join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        (new.select("digest", (-F.col("best.doc")).alias("keep_id"), (-F.col("best.row")).alias("keep_row"),
                    F.col("best.n_points").cast("long").alias("n_points"), "group_size", F.lit(batch).alias("batch"))
            .write.bucketBy(self.buckets, "digest").sortBy("digest").mode("append").format("parquet")
            .option("path", self.path).saveAsTable(self.name))


def digest_rows(docs: DataFrame, row_id: str | None = None) -> DataFrame:
    """(row_id, doc_id, n_points, digest), staged: row ids stay the same in every later read; ``row_id``: a column that has them."""
    return common.stage(docs.select(
        (F.col(row_id) if row_id else F.monotonically_increasing_id()).alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"),
        F.length(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("n_points"),
        digest(F.col("text")).alias("digest")), "digests")


def _decided(rows: DataFrame, index: DigestIndex | None, batch: str | None) -> DataFrame:
    """``rows`` (of ``digest_rows``) with keep_id, group_size and kept."""
    fresh_index = index is None
    index = index or DigestIndex(rows.sparkSession)
    batch = batch or uuid.uuid4().hex
    known = None if fresh_index else common.stage(index.rows().where(F.col("batch") != batch).select("digest"), "known-digests")
    index.append_new(rows, batch)
    out = rows.join(index.unbucketed().drop("n_points", "batch"), "digest")
    if known is not None:
        out = out.join(known.withColumn("old", F.lit(True)), "digest", "left")
    is_new = F.lit(True) if known is None else F.col("old").isNull()
    return out.withColumn("kept", (F.col("row_id") == F.col("keep_row")) & is_new)


def decisions(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    With an index that already knows a text, ``keep_id`` is the earlier row and nothing new is kept;
    row ids start anew with each batch, so ``kept`` is also false for digests known before.  ``batch`` names
    the batch: run again under its name, as after a failure, the same input gets the same decisions.
    """
    return _decided(digest_rows(docs), index, batch).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each group the longest text, exactly one row.

    The documents are staged with row ids, so the text is shuffled once at most, by row id, which spreads groups of copies.
    """
    row = common.fresh(docs, "row_id")
    staged = common.stage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    kept = _decided(digest_rows(staged, row), None, None).where("kept").select(F.col("row_id").alias(row))
    return staged.join(kept, row, "left_semi").select(*docs.columns)
