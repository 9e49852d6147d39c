"""Outcome queries: F1-F7 over the attempt log and probe captures."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitelens.operators import outcomes as O
from sitelens.plans.catalog import register
from sitelens.sources import fixtures as FX

RETRIES = 2
_ATT = FX.duck(FX.ATTEMPTS_SQL)
_WIN = "(error IS NULL AND status_code > 0 AND NOT (status_code = 429 OR status_code >= 500))"


def _attempt_sites(spark, sf_dir):
    """One options row per user of the event log (the 'site' of its attempt URLs)."""
    users = FX.table(spark, sf_dir, "events").select("user_id").distinct()
    return users.select(
        F.col("user_id").cast("string").alias("site_id"), F.lit("http://events.example/").alias("root_url"),
        F.lit(10).alias("depth"), F.lit(RETRIES).alias("retries"),
        ((F.col("user_id") % 3) * 100).cast("long").alias("delay_ms"), (F.col("user_id") % 4).cast("int").alias("rps"),
        F.lit("").alias("user_agent"), F.lit(None).cast("timestamp").alias("deadline"))


def _attempts(spark, sf_dir):
    a = FX.attempts(spark, sf_dir)
    return a.withColumn("site_id", F.substring_index("url", "/", 1))


@register("resolve_attempts", oracle=f"""
WITH a AS (SELECT url, attempt, status_code, error, {_WIN} AS win,
                  coalesce(error, CASE WHEN status_code = 429 OR status_code >= 500
                                       THEN 'HTTP ' || CAST(status_code AS VARCHAR) || ' (retriable)' END) AS err
           FROM ({_ATT}) t WHERE attempt <= {RETRIES})
SELECT url,
       CAST(coalesce(arg_min(status_code, attempt) FILTER (WHERE win), 0) AS INT) AS http_status,
       CASE WHEN coalesce(arg_min(status_code, attempt) FILTER (WHERE win), 0) IN (200, 201, 202, 204)
            THEN 'ok' ELSE 'error' END AS status,
       CASE WHEN bool_or(win) THEN '' ELSE coalesce(arg_max(err, attempt), '') END AS error,
       CAST(min(attempt) FILTER (WHERE win) AS INT) AS win_attempt,
       CAST(count(*) AS BIGINT) AS n_attempts
FROM a GROUP BY url""")
def resolve_attempts(spark, sf_dir):
    """F1 + F2 + F7: first winning attempt per URL (404 wins; 429/5xx/errors retried up to `retries`)."""
    out = O.resolve_attempts(_attempts(spark, sf_dir), _attempt_sites(spark, sf_dir))
    return out.select(F.col("norm_url").alias("url"), "http_status", "status", "error", "win_attempt", "n_attempts")


@register("backoff_plan", oracle=f"""
WITH a AS (SELECT CAST(split_part(url, '/', 1) AS BIGINT) AS uid, url, attempt, NOT {_WIN} AS fail
           FROM ({_ATT}) t WHERE attempt <= {RETRIES}),
g AS (SELECT *, min(CASE WHEN NOT fail THEN attempt END) OVER (PARTITION BY url) AS fw FROM a),
w AS (SELECT url, attempt,
             CASE WHEN fail AND attempt < {RETRIES}
                  THEN (CASE WHEN uid % 4 > 0 THEN 1000.0 / (uid % 4) WHEN uid % 3 > 0 THEN (uid % 3) * 100.0
                             ELSE 100.0 END) * attempt
                  ELSE 0.0 END AS wait_ms
      FROM g WHERE fw IS NULL OR attempt <= fw)
SELECT url, attempt, CAST(wait_ms AS DOUBLE) AS wait_ms,
       CAST(sum(wait_ms) OVER (PARTITION BY url ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS DOUBLE) AS cum_wait_ms
FROM w""")
def backoff_plan(spark, sf_dir):
    """linear backoff per attempt (rps interval, else delay, else 100 ms), none after the last."""
    out = O.backoff_plan(_attempts(spark, sf_dir), _attempt_sites(spark, sf_dir))
    return out.select(F.col("norm_url").alias("url"), "attempt", "wait_ms", "cum_wait_ms")


_PRB = FX.duck(FX.PROBES_SQL)
_HEAD_OK = "(head_status IS NOT NULL AND head_status NOT IN (405, 501))"


@register("link_probe", oracle=f"""
SELECT site_id, url,
       CAST(CASE WHEN {_HEAD_OK} THEN head_status WHEN get_status IS NOT NULL THEN get_status ELSE 0 END AS INT) AS status_code,
       CASE WHEN {_HEAD_OK} OR get_status IS NOT NULL THEN ''
            ELSE 'both HEAD and GET requests failed: connection reset' END AS error,
       (CASE WHEN {_HEAD_OK} THEN head_status WHEN get_status IS NOT NULL THEN get_status ELSE 0 END >= 400
        OR NOT ({_HEAD_OK} OR get_status IS NOT NULL)) AS broken
FROM ({_PRB}) p""")
def link_probe(spark, sf_dir):
    """F4 + R1: HEAD result unless it errored or said 405/501, then GET; broken = >= 400 or error."""
    from sitelens.functions import status as S
    caps = FX.captures(spark, sf_dir).filter(F.col("kind") == "link")
    st = O.resolve_link_probe(caps.select("site_id", "url", "method", "status_code", "error", "fetched_at"))
    return st.select("site_id", F.col("norm_url").alias("url"), "status_code", "error",
                     S.is_broken(F.col("status_code"), F.col("error")).alias("broken"))


_APRB = FX.duck(FX.ASSET_PROBES_SQL)


@register("asset_probe", oracle=f"""
WITH p AS (SELECT *, CASE WHEN {_HEAD_OK} THEN head_status WHEN get_status IS NOT NULL THEN get_status ELSE 0 END AS st
           FROM ({_APRB}) a)
SELECT url, CAST(st AS INT) AS status_code,
       CAST(CASE WHEN {_HEAD_OK} AND st BETWEEN 200 AND 299 THEN coalesce(head_length, -1)
                 WHEN NOT {_HEAD_OK} AND get_status IS NOT NULL AND st BETWEEN 200 AND 299
                   THEN CASE WHEN coalesce(get_length, -1) >= 0 THEN get_length
                             ELSE coalesce(get_body_bytes, 0) END
                 ELSE 0 END AS BIGINT) AS size_bytes,
       CASE WHEN {_HEAD_OK} OR get_status IS NOT NULL
            THEN CASE WHEN st BETWEEN 200 AND 299 THEN '' ELSE 'HTTP ' || CAST(st AS VARCHAR) END
            ELSE 'request failed: connection reset' END AS error
FROM p""")
def asset_probe(spark, sf_dir):
    """F5 + F6: asset status and size from HEAD (Content-Length verbatim) or GET (length, else bytes read)."""
    caps = FX.captures(spark, sf_dir).filter(F.col("kind") == "asset")
    st = O.resolve_asset_probe(caps.select("site_id", "url", "method", "status_code", "error", "content_length",
                                           "body_bytes", "fetched_at"))
    return st.select(F.col("norm_url").alias("url"), "status_code", "size_bytes", "error")
