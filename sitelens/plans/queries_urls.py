"""URL queries: U0-U8, S3, S5."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sitelens.functions import urls as U
from sitelens.operators.canonical import canonical_groups
from sitelens.plans.catalog import register
from sitelens.plans.duck import simple_norm
from sitelens.sources import captures as C
from sitelens.session import ensure_checkpoint_dir
from sitelens.sources import fixtures as FX
from sitelens.sources.fixtures import table


@register("normalize_urls", oracle=f"""
SELECT page_id, url, {simple_norm('url')} AS norm_url,
       regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host,
       regexp_extract(url, '^([a-z]+):', 1) AS scheme,
       TRUE AS is_valid
FROM pages""")
def normalize_urls(spark, sf_dir):
    """U0/U1/U1q: canonical URL, host and scheme of every page URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return U.canonicalize_urls(pages, "url").select("page_id", "url", "norm_url", "host", "scheme", "is_valid")


@register("canonical_groups", oracle=f"""
SELECT norm_url, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT url) AS BIGINT) AS n_variants,
       arg_min(url, page_id) AS first_variant
FROM (SELECT page_id, url, {simple_norm('url')} AS norm_url FROM pages) t
GROUP BY norm_url""")
def canonical_groups_q(spark, sf_dir):
    """Which raw spellings collapse to one canonical URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return canonical_groups(pages, "url", order_col="page_id")


_BROKEN = "replace(url, '.example', ' example')"


@register("url_checks", oracle=f"""
SELECT page_id,
       'http://' || regexp_replace(url, '^[a-z]+://', '') AS with_scheme,
       TRUE AS same_host,
       (regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) = 'site.example') AS same_as_fixture_site,
       CASE page_id % 5 WHEN 0 THEN TRUE WHEN 1 THEN TRUE WHEN 2 THEN TRUE WHEN 3 THEN TRUE ELSE FALSE END AS is_special,
       'invalid URL: ' || {_BROKEN} AS broken_error,
       {_BROKEN} AS broken_kept,
       {simple_norm('url')} AS norm_or_keep
FROM pages""")
def url_checks(spark, sf_dir):
    """U2, U3, U5, U6, U8 on every page URL (and spellings derived from it)."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    url = F.col("url")
    bare = F.regexp_replace(url, "^[a-z]+://", "")
    host = F.regexp_extract(url, "^[a-z]+://([^/?#]*)", 1)
    other_scheme = F.concat(F.when(url.startswith("https:"), F.lit("http://")).otherwise(F.lit("https://")), bare)
    special = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("#"), bare)) \
        .when(F.col("page_id") % 5 == 1, F.concat(F.lit("javascript:"), bare)) \
        .when(F.col("page_id") % 5 == 2, F.concat(F.lit("mailto:"), host)) \
        .when(F.col("page_id") % 5 == 3, F.concat(F.lit("tel:"), F.col("page_id").cast("string"))) \
        .otherwise(url)
    broken = F.replace(url, F.lit(".example"), F.lit(" example"))
    return p.select(
        "page_id",
        U.with_default_scheme(bare).alias("with_scheme"),
        U.same_domain(url, other_scheme).alias("same_host"),
        U.same_domain(url, F.lit("http://site.example/")).alias("same_as_fixture_site"),
        U.is_special_url(special).alias("is_special"),
        U.url_error(broken).alias("broken_error"),
        U.normalize_or_keep(broken).alias("broken_kept"),
        U.normalize_or_keep(url).alias("norm_or_keep"))


_SITE_SRC = """
SELECT CAST(page_id AS STRING) AS site_id,
       CASE WHEN page_id % 11 = 10 THEN replace(url, '.example', ' example') ELSE url END AS root_url,
       CASE WHEN page_id % 4 = 0 THEN NULL ELSE CAST(page_id % 12 AS INT) END AS depth,
       CASE WHEN page_id % 3 = 0 THEN NULL ELSE CAST(page_id % 3 AS INT) END AS retries,
       CASE WHEN page_id % 5 = 0 THEN NULL ELSE CAST((page_id % 5) * 100 AS BIGINT) END AS delay_ms,
       CASE WHEN page_id % 7 < 3 THEN NULL ELSE CAST(page_id % 7 - 3 AS INT) END AS rps,
       CASE WHEN page_id % 2 = 0 THEN 'AuditBot/1.0' END AS user_agent
FROM {pages}"""


@register("site_config", oracle="""
SELECT site_id, root_url, COALESCE(depth, 10) AS depth, COALESCE(retries, 1) AS retries,
       CASE WHEN COALESCE(rps, 0) > 0 THEN CAST(0 AS BIGINT) ELSE COALESCE(delay_ms, CAST(0 AS BIGINT)) END AS delay_ms,
       COALESCE(rps, 0) AS rps, COALESCE(user_agent, '') AS user_agent,
       (page_id % 11 <> 10) AS accepted
FROM (""" + _SITE_SRC.replace("{pages}", "pages").replace("SELECT CAST(page_id AS STRING) AS site_id,",
                                                         "SELECT page_id, CAST(page_id AS STRING) AS site_id,") + ") s")
def site_config_q(spark, sf_dir):
    """S3: per-site options with defaults; rps overrides delay; unparseable roots rejected."""
    src = spark.sql(_SITE_SRC, pages=table(spark, sf_dir, "pages").select("page_id", "url"))
    ok, rejected = C.site_config(src)
    cols = ["site_id", "root_url", "depth", "retries", "delay_ms", "rps", "user_agent"]
    return ok.select(*cols, F.lit(True).alias("accepted")).unionByName(
        rejected.select(*cols, F.lit(False).alias("accepted")))


_CAP = 4096


@register("cap_body", oracle=f"""
WITH c AS (SELECT page_id, unnest(string_split(html, '')) AS ch, generate_subscripts(string_split(html, ''), 1) AS i
           FROM pages),
k AS (SELECT page_id, strlen(ch) AS b, sum(strlen(ch)) OVER (PARTITION BY page_id ORDER BY i) AS cum FROM c)
SELECT page_id, CAST(sum(b) AS BIGINT) AS body_bytes, CAST(least(sum(b), {_CAP}) AS BIGINT) AS read_bytes,
       sum(b) > {_CAP} AS was_capped,
       CAST(count(*) FILTER (WHERE cum <= {_CAP}) AS INT) AS kept_chars,
       CAST(coalesce(sum(b) FILTER (WHERE cum <= {_CAP}), 0) AS INT) AS kept_bytes
FROM k GROUP BY page_id""")
def cap_body_q(spark, sf_dir):
    """S2 + S5: pages as captures, whole bodies cut at a byte cap (4 KiB here; 10 MiB in production)."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    caps = C.cap_body(C.captures_from_pages(pages, "pages", keep=["page_id"]), cap=_CAP)
    return caps.select(
        "page_id", F.col("content_length").alias("body_bytes"),
        F.least(F.col("content_length"), F.lit(_CAP).cast("long")).alias("read_bytes"),
        (F.col("content_length") > _CAP).alias("was_capped"),
        F.char_length("body").alias("kept_chars"), F.octet_length("body").alias("kept_bytes"))


_HOST_SQL = "regexp_extract(url, '://([^/?#]*)', 1)"
_PATH_SQL = "regexp_replace(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), '/+$', '')"


@register("normalize_query", oracle=f"""
SELECT page_id, 'http://' || lower({_HOST_SQL}) || {_PATH_SQL} || '?a=' || CAST(page_id AS VARCHAR) || '&a=1&b=x+y&c=' AS norm_url
FROM pages""")
def normalize_query(spark, sf_dir):
    """U1q + U1: every page URL in capitals, with its default port, shuffled query keys, an empty value and a fragment."""
    pages = FX.table(spark, sf_dir, "pages").select("page_id", "url")
    host, path = F.regexp_extract("url", "://([^/?#]*)", 1), F.regexp_extract("url", "^[a-zA-Z]+://[^/?#]*([^?#]*)", 1)
    variant = F.concat(F.lit("HTTP://"), F.upper(host), F.lit(":80"), path, F.lit("?b=x%20y&a="), F.col("page_id").cast("string"),
                       F.lit("&c=&a=1#top"))
    return pages.select("page_id", variant.alias("v")).select("page_id", U.normalize_url("v").alias("norm_url"))


_REFS = ["../x", "//other.example/y", "?q=1", "z/./w", "../../../k/", "./"]


@register("resolve_general", oracle=f"""
WITH b AS (SELECT page_id, regexp_extract(url, '^([a-z]+):', 1) AS scheme, {_HOST_SQL} AS host, {_PATH_SQL} AS path FROM pages),
d AS (SELECT *, regexp_replace(path, '[^/]*$', '') AS dir FROM b),
r AS (SELECT *, unnest({_REFS!r}) AS ref FROM d)
SELECT page_id, ref, scheme || ':' || CASE ref
  WHEN '../x' THEN '//' || host || regexp_replace(dir, '[^/]*/$', '') || 'x'
  WHEN '//other.example/y' THEN ref
  WHEN '?q=1' THEN '//' || host || path || ref
  WHEN 'z/./w' THEN '//' || host || dir || 'z/w'
  WHEN './' THEN '//' || host || dir
  ELSE '//' || host || '/k/' END AS resolved FROM r""")
def resolve_general(spark, sf_dir):
    """U4, general path: dot segments, a scheme-relative reference, a bare query, against every page URL."""
    pages = FX.table(spark, sf_dir, "pages").select("page_id", U.normalize_url("url").alias("base"))
    refs = pages.select("page_id", "base", F.explode(F.array(*[F.lit(r) for r in _REFS])).alias("ref"))
    return refs.select("page_id", "ref", U.resolve_url(F.col("base"), F.col("ref")).alias("resolved"))


@register("read_captures", oracle=f"""
SELECT url, CAST(attempt AS INT) AS attempt, CAST(status_code AS INT) AS status_code, CAST(strlen(html) AS BIGINT) AS n_bytes
FROM (SELECT url, status_code, html, unnest(CASE WHEN status_code >= 500 THEN [0, 1] ELSE [0] END) AS attempt
      FROM ({FX.duck(FX.WEB_PAGES_SQL)}) w) t""")
def read_captures(spark, sf_dir):
    """Page captures written as JSON lines and read back with the fixed schema."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/captures-{uuid.uuid4().hex}"
    caps = FX.captures(spark, sf_dir)
    caps.write.json(path)
    pages = C.read_captures(spark, path, "json").filter(F.col("kind") == "page")
    return pages.select("url", "attempt", "status_code", F.octet_length("body").cast("long").alias("n_bytes"))
