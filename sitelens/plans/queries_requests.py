"""Request-log queries: F10-F13 over the event log as a request log."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitelens.operators import requests as Q
from sitelens.plans.catalog import register
from sitelens.sources import fixtures as FX

_RL = FX.duck(FX.REQUEST_LOG_SQL)


def _log(spark, sf_dir):
    return FX.request_log(spark, sf_dir).withColumn("site_id", F.col("site_id").cast("string"))


def _sites(spark, sf_dir):
    users = FX.table(spark, sf_dir, "events").select("user_id").distinct()
    return users.select(F.col("user_id").cast("string").alias("site_id"),
                        (F.col("user_id") % 4).cast("int").alias("rps"),
                        ((F.col("user_id") % 3) * 100).cast("long").alias("delay_ms"),
                        F.when(F.col("user_id") % 5 == 0, F.lit("")).otherwise(F.lit("AuditBot/1.0")).alias("user_agent"))


@register("pacing_plan", oracle=f"""
SELECT seq, CAST(site_id AS VARCHAR) AS site_id,
       CAST(row_number() OVER (PARTITION BY site_id ORDER BY seq) - 1 AS BIGINT) AS slot,
       (row_number() OVER (PARTITION BY site_id ORDER BY seq) - 1)
       * CASE WHEN site_id % 4 > 0 THEN 1000.0 / (site_id % 4) WHEN site_id % 3 > 0 THEN (site_id % 3) * 100.0 ELSE 0.0 END
       AS offset_ms
FROM ({_RL}) r""")
def pacing_plan(spark, sf_dir):
    """per-site FIFO slots and start offsets under the rps / delay limiter."""
    out = Q.pacing_plan(_log(spark, sf_dir).select("seq", "site_id"), _sites(spark, sf_dir), bucket=512)
    return out.select("seq", "site_id", "slot", "offset_ms")


@register("request_intervals", oracle=f"""
WITH t AS (SELECT site_id, epoch_us(fetched_at) / 1000.0 AS ts FROM ({_RL}) r),
g AS (SELECT site_id, ts, ts - lag(ts) OVER (PARTITION BY site_id ORDER BY ts) AS gap FROM t)
SELECT CAST(site_id AS VARCHAR) AS site_id, CAST(count(*) AS BIGINT) AS n, min(gap) AS min_interval_ms,
       CASE WHEN count(*) > 1 THEN (max(ts) - min(ts)) / (count(*) - 1) END AS avg_interval_ms,
       max(ts) - min(ts) AS span_ms
FROM g GROUP BY site_id""")
def request_intervals(spark, sf_dir):
    """spacing statistics per site (what the reference's pacing tests assert on)."""
    return Q.request_intervals(_log(spark, sf_dir))


@register("request_counts", oracle=f"""
SELECT CAST(site_id AS VARCHAR) AS site_id, url, CAST(count(*) AS BIGINT) AS n,
       CAST(count(*) FILTER (WHERE method = 'HEAD') AS BIGINT) AS n_head,
       CAST(count(*) FILTER (WHERE method = 'GET') AS BIGINT) AS n_get,
       CAST(count(*) FILTER (WHERE method = 'GET') AS BIGINT) AS n_attempts, count(*) > 1 AS duplicate
FROM ({_RL}) r GROUP BY site_id, url""")
def request_counts(spark, sf_dir):
    """per-URL request counts, HEAD/GET split, duplicate flag."""
    return Q.request_counts(_log(spark, sf_dir))


@register("user_agent_audit", oracle=f"""
SELECT CAST(site_id AS VARCHAR) AS site_id, CAST(count(*) AS BIGINT) AS n_requests,
       CAST(count(DISTINCT user_agent) AS BIGINT) AS n_agents,
       CAST(count(*) FILTER (WHERE user_agent IS NULL) AS BIGINT) AS n_missing,
       CAST(count(*) FILTER (WHERE CASE WHEN site_id % 5 = 0 THEN user_agent IS NOT NULL
                                       ELSE user_agent IS NULL OR user_agent <> 'AuditBot/1.0' END) AS BIGINT) AS n_mismatch
FROM ({_RL}) r GROUP BY site_id""")
def user_agent_audit(spark, sf_dir):
    """configured user agent on every request; absent when none is configured."""
    return Q.user_agent_audit(_log(spark, sf_dir), _sites(spark, sf_dir))
