"""Shared helpers: table access, staged tables in the shared folder, bounded samples, Arrow tasks."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.session import ensure_checkpoint_dir

#: Bytes of one Arrow batch that goes to a Python worker (a single longer row still travels alone).
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def session(df: DataFrame) -> SparkSession:
    """The frame's session, with Arrow batches bounded by bytes as well as by rows."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below the folder that ``spark.checkpoint.dir`` names (all executors share it)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = shared_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` clashes with it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_text(docs: DataFrame) -> DataFrame:
    """Only (doc_id, text); a null text counts as empty.  Other columns never reach an operator."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text, mod 4, is 2.  Null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def unit_hash(col: Column) -> Column:
    """A number in [0, 1) that depends on the value alone."""
    return F.pmod(F.xxhash64(col), F.lit(1 << 30)) / float(1 << 30)


def bounded_ids(rows: DataFrame, stratum: str, per_stratum: int | dict) -> list[tuple]:
    """At most ``per_stratum`` (doc_id, stratum) pairs of each stratum, chosen by the hash of the id.

    An id that is there more than once counts once, with its greatest stratum.
    Strata are label values; only their counts and the chosen ids (twice the bound, as expected)
    reach the driver.  The same rows always give the same choice.
    """
    rows = rows.where(F.col("doc_id").isNotNull() & F.col(stratum).isNotNull()) \
        .groupBy("doc_id").agg(F.max(stratum).alias(stratum))
    most = per_stratum if isinstance(per_stratum, dict) else {}
    counts = {r[0]: r[1] for r in rows.groupBy(stratum).count().collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 2.0 * most.get(k, per_stratum if not most else 0) / n))])
    chosen = rows.select("doc_id", stratum, unit_hash(F.col("doc_id")).alias("u")) \
        .where(F.col("u") < F.element_at(share, F.col(stratum))).collect()
    chosen.sort(key=lambda r: (r[2], r[0]))
    out: list[tuple] = []
    seen: dict = {}
    for doc_id, label, _ in chosen:
        seen[label] = seen.get(label, 0) + 1
        if seen[label] <= (most.get(label, 0) if most else per_stratum):
            out.append((doc_id, label))
    return out


def one_text_an_id(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents in ``ids``, a bounded table; of several texts with one id the one with the least hash."""
    rows = id_text(docs).join(F.broadcast(ids), "doc_id", "left_semi")
    return rows.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def arrow_rows(batches, columns):
    """Python values of the named columns of every Arrow batch, as tuples of lists."""
    for b in batches:
        if b.num_rows:
            yield tuple(b.column(b.schema.get_field_index(c)).to_pylist() for c in columns)


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=f.type) for c, f in zip(columns, schema)],
        schema=schema)
