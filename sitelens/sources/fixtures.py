"""Derived tables built from the driver's parquet data (see FIXTURES.md).

Each definition is one SQL text rendered twice: for Spark (``spark.sql`` with DataFrame arguments,
no global temp views) and for DuckDB (plain table names) so that the oracle and the Spark job start
from identical rows.  The web tables hold the real HTML in the visible body of pages on their real hosts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.plans.duck import path_encode

# The site of a page is its URL's host.  Pages of a site are numbered k = 0 .. n - 1: a row number within (host, bucket of
# page ids) plus the sizes of the host's buckets before, so that no window holds a whole site.
BUCKET = 4096
_HOSTS = f"SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, page_id - page_id % {BUCKET} AS b FROM {{pages}}"
SITE_PAGES_SQL = f"""
SELECT h.page_id, h.host, CAST(o.n AS BIGINT) AS n,
       CAST(o.bef + row_number() OVER (PARTITION BY h.host, h.b ORDER BY h.page_id) - 1 AS BIGINT) AS k
FROM ({_HOSTS}) h
JOIN (SELECT host, b, sum(m) OVER (PARTITION BY host) AS n,
             sum(m) OVER (PARTITION BY host ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - m AS bef
      FROM (SELECT host, b, count(*) AS m FROM ({_HOSTS}) g GROUP BY host, b) c) o ON o.host = h.host AND o.b = h.b
"""

# A site's links form a heap over k, so its depth is the bit length of n; the limit lets links of the last level be seen.
SITES_SQL = f"""
SELECT host AS site_id, 'http://' || host || '/p/0' AS root_url, CAST(length(bin(n)) + 1 AS INT) AS depth
FROM ({SITE_PAGES_SQL}) s WHERE k = 0
"""

# An external link a page, one for a third of all pages; an image a page beside assets that many pages share.
_EXT = "'https://ext' || CAST(page_id % 7 AS STRING) || '.example.org/x/' || CAST(CASE WHEN page_id % 3 = 0 THEN page_id % 7 ELSE page_id END AS STRING)"
WEB_PAGES_SQL = f"""
SELECT s.page_id, s.host AS site_id, 'http://' || s.host || '/p/' || CAST(s.k AS STRING) AS url,
       CASE WHEN s.page_id % 13 = 12 THEN 404 WHEN s.page_id % 17 = 16 THEN 503 ELSE 200 END AS status_code,
       CASE WHEN s.page_id % 29 = 28 THEN 'application/pdf' ELSE 'text/html; charset=utf-8' END AS content_type,
       '<!DOCTYPE html><html><head><title> T' || CAST(s.page_id AS STRING) || ' &amp; co </title>'
       || CASE WHEN s.page_id % 3 = 0 THEN '<meta name="Description" content="D' || CAST(s.page_id AS STRING) || '">' ELSE '' END
       || '<link rel="icon" href="/f.ico"><link rel="stylesheet" href="/static/s' || CAST(s.page_id % 3 AS STRING) || '.css"></head><body>'
       || CASE WHEN s.page_id % 4 = 0 THEN '<h1></h1>' ELSE '<h1>H</h1>' END
       || '<!-- <a href="/ghost">no</a> -->'
       || '<a href="/p/' || CAST((2 * s.k + 1) % s.n AS STRING) || '">l</a>'
       || '<a href="/p/' || CAST((2 * s.k + 2) % s.n AS STRING) || '#frag">r</a>'
       || '<a href="' || {_EXT.replace('page_id', 's.page_id')} || CASE WHEN s.page_id % 4 = 3 THEN '/' ELSE '' END || '">e</a>'
       || '<a href="#top">t</a>'
       || '<img src="/static/img' || CAST(s.page_id AS STRING) || '.png"><img src="/static/img' || CAST(s.page_id AS STRING) || '.png">'
       || '<img srcset="/static/a' || CAST(s.page_id % 9 AS STRING) || '.webp 1x, /static/b.webp 2x" style="background:url(''/static/bg'
       || CAST(s.page_id % 6 AS STRING) || '.gif'')"><img src="data:image/png;base64,AAAA">'
       || '<script src="/static/app' || CAST(s.page_id % 5 AS STRING) || '.js">var t="<a href=/ghost2>";</script>'
       || coalesce(p.html, '') || '</body></html>' AS html
FROM ({SITE_PAGES_SQL}) s JOIN {{pages}} p ON p.page_id = s.page_id
"""

# What the oracles expect of a page (DuckDB only; Spark extracts it from the HTML): its facts, and below its links and assets.
WEB_FACTS_SQL = f"""
SELECT s.page_id, s.host, s.k, s.n, 'http://' || s.host AS origin, 'http://' || s.host || '/p/' || s.k AS src, length(bin(s.n)) + 1 AS lim,
       s.page_id % 17 = 16 AND s.page_id % 13 <> 12 AS failed, s.page_id % 13 = 12 AS missing, s.page_id % 29 = 28 AS pdf,
       2 * s.page_id + CASE WHEN s.page_id % 17 = 16 AND s.page_id % 13 <> 12 THEN 1 ELSE 0 END AS sec,
       CASE WHEN t <> '' THEN t ELSE 'T' || s.page_id || ' & co' END AS title, s.page_id % 3 = 0 AS has_description,
       s.page_id % 4 <> 0 OR contains(s.html, '<h1>') AS has_h1, s.html
FROM (SELECT s.*, p.html, trim(replace(regexp_extract(p.html, '<title>([^<]*)</title>', 1), '&amp;', '&')) AS t
      FROM ({SITE_PAGES_SQL}) s JOIN pages p ON p.page_id = s.page_id) s
"""

WEB_LINKS_SQL = f"""
SELECT page_id, src, host, lim, CAST(row_number() OVER (PARTITION BY page_id ORDER BY min(i)) - 1 AS INT) AS pos, link
FROM (
  SELECT page_id, src, host, lim, i,
         CASE i WHEN 0 THEN origin || '/p/' || ((2 * k + 1) % n) WHEN 1 THEN origin || '/p/' || ((2 * k + 2) % n)
                WHEN 2 THEN {_EXT} || CASE WHEN page_id % 4 = 3 THEN '/' ELSE '' END ELSE src END AS link
  FROM (SELECT *, unnest([0, 1, 2, 3]) AS i FROM ({WEB_FACTS_SQL}) f) t
  UNION ALL
  SELECT page_id, src, host, lim, 3 + e.i AS i, origin || {path_encode('e.h')} AS link
  FROM (SELECT *, unnest(list_transform(regexp_extract_all(html, '<a href="([^"]*)"', 1), lambda x, i: {{{{'h': x, 'i': i}}}})) AS e
        FROM ({WEB_FACTS_SQL}) f) t) u
GROUP BY page_id, src, host, lim, link
"""

WEB_ASSETS_SQL = f"""
SELECT page_id, src, host, CAST(pos AS INT) AS pos,
       CASE pos WHEN 0 THEN origin || '/static/s' || (page_id % 3) || '.css'
                WHEN 1 THEN origin || '/static/img' || page_id || '.png'
                WHEN 2 THEN origin || '/static/a' || (page_id % 9) || '.webp'
                WHEN 3 THEN origin || '/static/bg' || (page_id % 6) || '.gif'
                ELSE origin || '/static/app' || (page_id % 5) || '.js' END AS asset_url,
       CASE pos WHEN 0 THEN 'style' WHEN 4 THEN 'script' ELSE 'image' END AS type
FROM (SELECT *, unnest([0, 1, 2, 3, 4]) AS pos FROM ({WEB_FACTS_SQL}) f) t
"""

# One probe a site and external URL, so that they grow with the pages.
PROBES_SQL = f"""
SELECT site_id, url,
       CASE WHEN h % 5 = 0 THEN 405 WHEN h % 5 = 1 THEN NULL WHEN h % 5 = 2 THEN 404 ELSE 200 END AS head_status,
       CASE WHEN h % 5 > 1 THEN NULL WHEN h % 2 = 0 THEN 200 WHEN h % 3 = 0 THEN 410 ELSE NULL END AS get_status
FROM (SELECT DISTINCT host AS site_id, {_EXT} AS url, CASE WHEN page_id % 3 = 0 THEN page_id % 7 ELSE page_id END AS h FROM ({SITE_PAGES_SQL}) s) x
"""

ASSET_PROBES_SQL = f"""
SELECT host AS site_id, 'http://' || host || '/static/img' || CAST(i AS STRING) || '.png' AS url,
       CASE WHEN i % 6 = 0 THEN 501 WHEN i % 6 = 1 THEN NULL WHEN i % 6 = 2 THEN 404 ELSE 200 END AS head_status,
       CASE WHEN i % 6 = 3 THEN CAST(-1 AS BIGINT) WHEN i % 6 > 3 THEN CAST(100 * i AS BIGINT) END AS head_length,
       CASE WHEN i % 6 = 0 THEN 200 WHEN i % 6 = 1 AND i % 4 = 1 THEN 403 END AS get_status,
       CASE WHEN i % 12 = 0 THEN CAST(50 * i AS BIGINT) END AS get_length,
       CASE WHEN i % 6 = 0 THEN CAST(70 * i AS BIGINT) END AS get_body_bytes
FROM (SELECT host, page_id AS i FROM ({SITE_PAGES_SQL}) s) ii
"""

ATTEMPTS_SQL = """
SELECT CAST(user_id AS STRING) || '/' || CAST(CAST(ts AS DATE) AS STRING) AS url,
       CAST(row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) - 1 AS INT) AS attempt,
       CASE event_type WHEN 'error' THEN 503 WHEN 'signup' THEN 429 WHEN 'click' THEN 404 WHEN 'purchase' THEN NULL ELSE 200 END AS status_code,
       CASE WHEN event_type = 'purchase' THEN 'connection refused' END AS error
FROM {events}
"""

REQUEST_LOG_SQL = """
SELECT event_id AS seq, user_id AS site_id, ts AS fetched_at,
       'HTTP://Site' || CAST(user_id AS STRING) || '.Example:80/' || event_type || '/' || CAST(event_id % 200 AS STRING) || '/' AS url,
       CASE WHEN event_id % 3 = 0 THEN 'HEAD' ELSE 'GET' END AS method,
       CASE WHEN event_id % 50 = 0 THEN NULL ELSE 'AuditBot/1.0' END AS user_agent
FROM {events}
"""

RSS_BODIES_SQL = """
SELECT doc_id, 'application/rss+xml' AS content_type,
       '<?xml version="1.0"?><rss><title>outer</title>' || CASE WHEN doc_id % 5 = 4 THEN '' ELSE '<channel>' END
       || '<description>' || replace(replace(coalesce(text, ''), '&', '&amp;'), '<', '&lt;') || '</description>'
       || '<title> ' || source || ' &amp; ' || lang || ' </title><item><title>inner</title></item></channel></rss>' AS body
FROM {documents}
"""


def duck(sql: str) -> str:
    """Render a fixture SQL text for DuckDB over the pre-registered driver views."""
    return sql.format(pages="pages", events="events", documents="documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spark(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    return spark.sql(sql, **frames)


def web_pages(spark, sf_dir):
    """The pages are dealt out first: a row group is read by one task, which would extract all its pages, too."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return _spark(spark, WEB_PAGES_SQL, pages=pages.repartition("page_id"))


def _page_urls(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "url")


def probes(spark, sf_dir):
    return _spark(spark, PROBES_SQL, pages=_page_urls(spark, sf_dir))


def asset_probes(spark, sf_dir):
    return _spark(spark, ASSET_PROBES_SQL, pages=_page_urls(spark, sf_dir))


def sites(spark, sf_dir, retries: int = 1, deadline: str | None = None) -> DataFrame:
    """The options of the audited sites, one a host of the pages."""
    return _spark(spark, SITES_SQL, pages=_page_urls(spark, sf_dir)).select(
        "site_id", "root_url", "depth", F.lit(retries).alias("retries"), F.lit(0).cast("long").alias("delay_ms"), F.lit(0).alias("rps"),
        F.lit("").alias("user_agent"), F.lit(deadline).cast("timestamp").alias("deadline"))


def attempts(spark, sf_dir):
    return _spark(spark, ATTEMPTS_SQL, events=table(spark, sf_dir, "events"))


def request_log(spark, sf_dir):
    return _spark(spark, REQUEST_LOG_SQL, events=table(spark, sf_dir, "events"))


def rss_bodies(spark, sf_dir):
    return _spark(spark, RSS_BODIES_SQL, documents=table(spark, sf_dir, "documents"))


def captures(spark, sf_dir) -> DataFrame:
    return fixture_captures(web_pages(spark, sf_dir), probes(spark, sf_dir), asset_probes(spark, sf_dir))


def fixture_captures(web_pages: DataFrame, probes: DataFrame, asset_probes: DataFrame) -> DataFrame:
    """Capture rows of the fixture sites: page GETs (a 503 is retried once), link and asset HEAD/GET probes."""
    t0 = F.lit("2024-01-01 00:00:00").cast("timestamp")
    none_s, none_l = F.lit(None).cast("string"), F.lit(None).cast("long")

    def at(seconds: Column) -> Column:
        return F.timestamp_seconds(F.unix_timestamp(t0) + seconds)

    pages = web_pages.select(
        "page_id", "site_id", "url", "status_code", "content_type", "html",
        F.explode(F.when(F.col("status_code") >= 500, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        .alias("attempt"))
    page_caps = pages.select(
        "site_id", "url", F.lit("GET").alias("method"), F.lit("page").alias("kind"),
        F.col("attempt").cast("int").alias("attempt"), F.col("status_code").cast("int").alias("status_code"),
        "content_type", F.octet_length("html").cast("long").alias("content_length"), F.col("html").alias("body"),
        F.octet_length("html").cast("long").alias("body_bytes"), none_s.alias("final_url"), none_s.alias("error"),
        F.lit("AuditBot/1.0").alias("user_agent"), at(F.col("page_id") * 2 + F.col("attempt")).alias("fetched_at"))

    head_err = F.when(F.col("head_status").isNull(), F.lit("connection refused"))
    needs_get = F.col("head_status").isNull() | F.col("head_status").isin(405, 501)
    link_rows = probes.select(
        "site_id", "url", F.explode(F.when(needs_get, F.array(F.lit("HEAD"), F.lit("GET"))).otherwise(F.array(F.lit("HEAD"))))
        .alias("method"), "head_status", "get_status")
    link_caps = link_rows.select(
        "site_id", "url", "method", F.lit("link").alias("kind"), F.lit(0).alias("attempt"),
        F.when(F.col("method") == "HEAD", F.col("head_status")).otherwise(F.col("get_status")).cast("int")
        .alias("status_code"),
        none_s.alias("content_type"), none_l.alias("content_length"), none_s.alias("body"), none_l.alias("body_bytes"),
        none_s.alias("final_url"),
        F.when(F.col("method") == "HEAD", head_err)
         .otherwise(F.when(F.col("get_status").isNull(), F.lit("connection reset"))).alias("error"),
        F.lit("AuditBot/1.0").alias("user_agent"), at(F.lit(100000)).alias("fetched_at"))

    a_needs_get = F.col("head_status").isNull() | F.col("head_status").isin(405, 501)
    asset_rows = asset_probes.select(
        "site_id", "url", F.explode(F.when(a_needs_get, F.array(F.lit("HEAD"), F.lit("GET"))).otherwise(F.array(F.lit("HEAD"))))
        .alias("method"), "head_status", "head_length", "get_status", "get_length", "get_body_bytes")
    is_head = F.col("method") == "HEAD"
    asset_caps = asset_rows.select(
        "site_id", "url", "method", F.lit("asset").alias("kind"), F.lit(0).alias("attempt"),
        F.when(is_head, F.col("head_status")).otherwise(F.col("get_status")).cast("int").alias("status_code"),
        none_s.alias("content_type"),
        F.when(is_head, F.coalesce(F.col("head_length"), F.lit(-1).cast("long")))
         .otherwise(F.coalesce(F.col("get_length"), F.lit(-1).cast("long"))).alias("content_length"),
        none_s.alias("body"), F.when(is_head, none_l).otherwise(F.col("get_body_bytes")).alias("body_bytes"),
        none_s.alias("final_url"),
        F.when(is_head, head_err)
         .otherwise(F.when(F.col("get_status").isNull(), F.lit("connection reset"))).alias("error"),
        F.lit("AuditBot/1.0").alias("user_agent"), at(F.lit(100001)).alias("fetched_at"))
    return page_caps.unionByName(link_caps).unionByName(asset_caps)
