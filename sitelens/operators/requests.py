"""Request-log audits: pacing plan, spacing statistics, request counts, user agents.

A single site may own a large share of all requests, so nothing here opens one window partition
per site: ordinal positions are computed per (site, bucket), consecutive gaps per part of a range
partitioning, and both are stitched together with a small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitelens.session import store

SEQ_BUCKET = 1 << 20      # sequence numbers per bucket in the pacing prefix


def pacing_interval_ms(sites: DataFrame) -> DataFrame:
    """Token interval per site: 1000/rps when rps > 0, else the delay, else no spacing (0)."""
    return sites.select("site_id", F.when(F.col("rps") > 0, F.lit(1000.0) / F.col("rps"))
                        .when(F.col("delay_ms") > 0, F.col("delay_ms").cast("double"))
                        .otherwise(F.lit(0.0)).alias("interval_ms"))


def pacing_plan(worklist: DataFrame, sites: DataFrame, bucket: int = SEQ_BUCKET) -> DataFrame:
    """FIFO slot of each work item (ordered by ``seq`` within its site) x the site's token interval.

    rank = (items of the site in earlier buckets) + (row number inside the bucket); the first term
    comes from a per-(site, bucket) count table whose size is rows / bucket, so a giant site is
    spread over many window partitions instead of one.
    """
    w = worklist.withColumn("_b", F.floor(F.col("seq") / F.lit(bucket)))
    counts = w.groupBy("site_id", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(
        Window.partitionBy("site_id").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .select("site_id", "_b", "_before")
    ranked = w.withColumn("_rn", F.row_number().over(Window.partitionBy("site_id", "_b").orderBy("seq")))
    out = ranked.join(before, ["site_id", "_b"]).join(pacing_interval_ms(sites), "site_id")
    slot = F.col("_before") + F.col("_rn") - 1
    return out.withColumn("slot", slot.cast("long")) \
        .withColumn("offset_ms", F.col("slot") * F.col("interval_ms")).drop("_b", "_rn", "_before")


def epoch_ms(df: DataFrame, col: str):
    """Milliseconds since the epoch, independent of the session time zone for both timestamp types
    (TIMESTAMP_NTZ wall-clock values are read as UTC)."""
    if df.schema[col].dataType.typeName() == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(col)) / 1000.0
    return F.unix_micros(F.col(col).cast("timestamp")) / 1000.0


def request_intervals(log: DataFrame) -> DataFrame:
    """per site n, min / avg gap between consecutive requests and total span (ms).

    Requests of one instant are counted together first (their gap is 0).  The instants are then split by
    range of (site, time) into parts of about equal size, so a busy site, or one busy second of it, is
    spread over many tasks; the gap between two parts comes from a table of one row a part and site.
    The avg gap telescopes to span / (n - 1).
    """
    instants = log.select("site_id", epoch_ms(log, "fetched_at").alias("_t")).groupBy("site_id", "_t").agg(F.count(F.lit(1)).alias("_n"))
    parts = store(instants.repartitionByRange("site_id", "_t").withColumn("_part", F.spark_partition_id()), "instants")
    order = Window.partitionBy("site_id", "_part").orderBy("_t")
    gap = F.when(F.col("_n") > 1, F.lit(0.0)).otherwise(F.col("_t") - F.lag("_t").over(order))
    per_part = parts.withColumn("_gap", gap).groupBy("site_id", "_part").agg(
        F.min("_gap").alias("_inner"), F.min("_t").alias("_lo"), F.max("_t").alias("_hi"), F.sum("_n").alias("_n"))
    border = F.col("_lo") - F.lag("_hi").over(Window.partitionBy("site_id").orderBy("_part"))
    j = per_part.withColumn("_border", border).groupBy("site_id").agg(
        F.least(F.min("_inner"), F.min("_border")).alias("min_interval_ms"), F.sum("_n").alias("n"),
        F.min("_lo").alias("_first"), F.max("_hi").alias("_last"))
    span = F.col("_last") - F.col("_first")
    return j.select("site_id", F.col("n").cast("long").alias("n"), "min_interval_ms",
                    F.when(F.col("n") > 1, span / (F.col("n") - 1)).alias("avg_interval_ms"),
                    span.alias("span_ms"))


def request_counts(log: DataFrame) -> DataFrame:
    """requests per (site, url) with HEAD/GET split and the number of page attempts (``kind`` page;
    a log without kinds has only those); ``duplicate`` flags n > 1."""
    attempt = (F.col("kind") == "page") if "kind" in log.columns else F.lit(True)
    return log.groupBy("site_id", "url").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("method") == "HEAD").alias("n_head"),
        F.count_if(F.col("method") == "GET").alias("n_get"),
        F.count_if(attempt & (F.col("method") == "GET")).alias("n_attempts")).withColumn("duplicate", F.col("n") > 1)


def user_agent_audit(log: DataFrame, sites: DataFrame) -> DataFrame:
    """every request of a site carries the configured user agent; none when it is empty."""
    cfg = sites.select("site_id", F.coalesce(F.col("user_agent"), F.lit("")).alias("cfg_ua"))
    j = log.join(cfg, "site_id")
    wrong = F.when(F.col("cfg_ua") == "", F.col("user_agent").isNotNull()) \
        .otherwise(F.coalesce(F.col("user_agent") != F.col("cfg_ua"), F.lit(True)))
    return j.groupBy("site_id").agg(
        F.count(F.lit(1)).alias("n_requests"), F.count_distinct("user_agent").alias("n_agents"),
        F.count_if(F.col("user_agent").isNull()).alias("n_missing"), F.count_if(wrong).alias("n_mismatch"))
