"""Report queries: R1-R9, F8, F9 -- the whole audit over captures of all sites."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitelens.operators import extract as X
from sitelens.operators import report as R
from sitelens.plans.audit import audit_report, run_audit
from sitelens.plans.catalog import register
from sitelens.plans.queries_graph import CUTOFF_S, IS_CRAWL, bfs_cte
from sitelens.sources import fixtures as FX
from sitelens.streaming.jobs import scratch

GENERATED_AT = "2024-01-02 00:00:00"
_PRB = FX.duck(FX.PROBES_SQL)
_APRB = FX.duck(FX.ASSET_PROBES_SQL)
_WA = FX.duck(FX.WEB_ASSETS_SQL)
_HEAD_OK = "(head_status IS NOT NULL AND head_status NOT IN (405, 501))"


def _audit(spark, sf_dir, match="exact", deadline=None):
    return run_audit(FX.captures(spark, sf_dir), FX.sites(spark, sf_dir, deadline=deadline), match)


def _report(spark, sf_dir):
    return audit_report(FX.captures(spark, sf_dir), FX.sites(spark, sf_dir), GENERATED_AT)


# Oracle side: the crawl only expands pages that were fetched as HTML (not 503-exhausted, not PDF)
# and, with a cut-off, only pages captured before it.
_EXPANDS = "NOT pg.failed AND NOT pg.pdf"
_CRAWL = bfs_cte(_EXPANDS)
_LINK_STATUS = f"""
ls AS (SELECT site_id, url,
              CASE WHEN {_HEAD_OK} THEN head_status WHEN get_status IS NOT NULL THEN get_status ELSE 0 END AS status_code,
              CASE WHEN {_HEAD_OK} OR get_status IS NOT NULL THEN ''
                   ELSE 'both HEAD and GET requests failed: connection reset' END AS error
       FROM ({_PRB}) p)"""
_CHECKED = f"""
ck AS (SELECT l.src, l.host, l.pos, l.link, d.depth FROM l JOIN d ON l.src = d.url JOIN pg ON pg.page_id = l.page_id
       WHERE {_EXPANDS} AND NOT {IS_CRAWL}),
fc AS (SELECT host, norm, link AS first_url FROM (
         SELECT host, regexp_replace(link, '/+$', '') AS norm, link,
                row_number() OVER (PARTITION BY host, regexp_replace(link, '/+$', '') ORDER BY depth, src, pos) AS rn FROM ck) k
       WHERE rn = 1)"""


def _broken_oracle(link_key: str) -> str:
    return f"""
WITH RECURSIVE {_CRAWL}, {_LINK_STATUS}, {_CHECKED}
SELECT ck.src AS page_norm, ck.pos, ck.link, fc.first_url AS status_url, CAST(ls.status_code AS INT) AS status_code, ls.error
FROM ck JOIN ls ON {link_key} = ls.url AND ck.host = ls.site_id JOIN fc ON fc.norm = ls.url AND fc.host = ls.site_id
WHERE (ls.status_code >= 400 OR ls.error <> '')"""


@register("broken_links", oracle=_broken_oracle("ck.link"))
def broken_links(spark, sf_dir):
    """R1 + R2 (exact): broken links per crawled page; the status table is probed with the raw link."""
    a = _audit(spark, sf_dir)
    return a.broken.select("page_norm", "pos", "link", "status_url", "status_code", "error")


@register("broken_links_normalized", oracle=_broken_oracle("regexp_replace(ck.link, '/+$', '')"))
def broken_links_normalized(spark, sf_dir):
    """R2 (normalized): the intended lookup by canonical link; trailing-slash spellings match too."""
    a = _audit(spark, sf_dir, match="normalized")
    return a.broken.select("page_norm", "pos", "link", "status_url", "status_code", "error")


@register("broken_links_lineitem", oracle="""
SELECT l.l_orderkey AS page_id, l.l_linenumber AS pos, 'http://parts.example/p/' || CAST(l.l_partkey AS VARCHAR) AS link,
       404 AS status_code
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE p.p_partkey % 7 = 0""")
def broken_links_lineitem(spark, sf_dir):
    """R2 at scale: every lineitem is a link observation (page = order, link = part), part statuses."""
    li = FX.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = FX.table(spark, sf_dir, "part").select("p_partkey")
    links = li.select(F.lit("parts").alias("site_id"), F.col("l_orderkey").alias("page_norm"),
                      F.col("l_linenumber").alias("pos"),
                      F.concat(F.lit("http://parts.example/p/"), F.col("l_partkey").cast("string")).alias("link"))
    status = part.select(F.lit("parts").alias("site_id"),
                         F.concat(F.lit("http://parts.example/p/"), F.col("p_partkey").cast("string")).alias("norm_url"),
                         F.lit(None).cast("string").alias("url"),
                         F.when(F.col("p_partkey") % 7 == 0, F.lit(404)).otherwise(F.lit(200)).alias("status_code"),
                         F.lit("").alias("error"))
    b = R.broken_links(links, status)
    return b.select(F.col("page_norm").alias("page_id"), "pos", "link", "status_code")


_ASSET_STATUS = f"""
ast AS (SELECT url, CASE WHEN {_HEAD_OK} THEN head_status WHEN get_status IS NOT NULL THEN get_status ELSE 0 END AS st,
               head_status, head_length, get_status, get_length, get_body_bytes FROM ({_APRB}) a),
asz AS (SELECT url, st AS status_code,
               CASE WHEN {_HEAD_OK} AND st BETWEEN 200 AND 299 THEN coalesce(head_length, -1)
                    WHEN NOT {_HEAD_OK} AND get_status IS NOT NULL AND st BETWEEN 200 AND 299
                      THEN CASE WHEN coalesce(get_length, -1) >= 0 THEN get_length ELSE coalesce(get_body_bytes, 0) END
                    ELSE 0 END AS size_bytes,
               CASE WHEN {_HEAD_OK} OR get_status IS NOT NULL
                    THEN CASE WHEN st BETWEEN 200 AND 299 THEN '' ELSE 'HTTP ' || CAST(st AS VARCHAR) END
                    ELSE 'request failed: connection reset' END AS error FROM ast)"""


@register("asset_inventory", oracle=f"""
WITH RECURSIVE {_CRAWL}, {_ASSET_STATUS},
pa AS (SELECT a.src AS page_norm, a.asset_url, a.type
       FROM ({_WA}) a JOIN d ON d.url = a.src JOIN pg ON pg.page_id = a.page_id WHERE {_EXPANDS}),
inv AS (SELECT pa.page_norm, pa.asset_url AS url, pa.type, CAST(coalesce(asz.status_code, 0) AS INT) AS status_code,
               CAST(coalesce(asz.size_bytes, 0) AS BIGINT) AS size_bytes, coalesce(asz.error, '') AS error
        FROM pa LEFT JOIN asz ON pa.asset_url = asz.url)
SELECT page_norm, CAST(row_number() OVER (PARTITION BY page_norm ORDER BY type, url) - 1 AS INT) AS ord,
       url, type, status_code, size_bytes, error FROM inv""")
def asset_inventory(spark, sf_dir):
    """R3 + R4: every asset of every crawled page with its status, ordered by (type, url) within the page."""
    a = _audit(spark, sf_dir)
    nested = R.nest_pages(a.pages, a.broken, a.inventory)
    return X.explode_positions(nested, ["page_norm"], "assets", ("ord", "x")).select(
        "page_norm", "ord", "x.url", "x.type", "x.status_code", "x.size_bytes", "x.error")


def _page_rows_oracle(fetched: str, join: str = "JOIN", deadline: str = "NULL") -> str:
    return f"""
SELECT CASE WHEN {fetched} THEN strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(sec), '%Y-%m-%d %H:%M:%S') ELSE {deadline} END AS discovered_at,
       d.url, CAST(d.depth AS INT) AS depth,
       CAST(CASE WHEN NOT {fetched} OR failed THEN 0 WHEN missing THEN 404 ELSE 200 END AS INT) AS http_status,
       CASE WHEN {fetched} AND NOT failed AND NOT missing THEN 'ok' ELSE 'error' END AS status,
       CASE WHEN NOT {fetched} THEN 'context canceled' WHEN failed THEN 'HTTP 503 (retriable)' ELSE '' END AS error,
       {fetched} AND NOT pdf AND NOT failed AS has_title,
       CASE WHEN {fetched} AND NOT pdf AND NOT failed THEN title ELSE '' END AS title
FROM d {join} pg ON pg.src = d.url"""


@register("page_rows", oracle=f"WITH RECURSIVE {_CRAWL} " + _page_rows_oracle("TRUE"))
def page_rows(spark, sf_dir):
    """F8 (+F2, X5): one row per crawled page: final URL, depth, status, error, title."""
    p = _audit(spark, sf_dir).pages
    return p.select(F.col("discovered_at").cast("string").alias("discovered_at"), "url", "depth", "http_status", "status", "error",
                    "seo.has_title", "seo.title")


@register("partial_results", oracle=f"WITH RECURSIVE {bfs_cte(f'{_EXPANDS} AND pg.sec <= {CUTOFF_S}')} "
          + _page_rows_oracle(f"coalesce(pg.sec <= {CUTOFF_S}, FALSE)", "LEFT JOIN", f"'2024-01-01 00:00:{CUTOFF_S:02d}'"))
def partial_results(spark, sf_dir):
    """a cut-off mid-crawl: finished pages stay, reached-but-unfetched pages become 'context canceled'."""
    p = _audit(spark, sf_dir, deadline=f"2024-01-01 00:00:{CUTOFF_S:02d}").pages
    return p.select(F.col("discovered_at").cast("string").alias("discovered_at"), "url", "depth", "http_status", "status", "error",
                    "seo.has_title", "seo.title")


_BROKEN_PER_PAGE = f"""
br AS (SELECT ck.src, count(*) AS n,
              string_agg('{{"url":"' || fc.first_url || '","status_code":' || ls.status_code || ',"error":"' || ls.error || '"}}', ','
                         ORDER BY ck.pos) AS js
       FROM ck JOIN ls ON ck.link = ls.url AND ck.host = ls.site_id JOIN fc ON fc.norm = ls.url AND fc.host = ls.site_id
       WHERE ls.status_code >= 400 OR ls.error <> '' GROUP BY ck.src)"""
_ROWS = f"""
rows AS (SELECT d.url, d.depth, pg.* EXCLUDE (html),
                CAST(row_number() OVER (PARTITION BY pg.host ORDER BY d.url) - 1 AS BIGINT) AS ord,
                strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(pg.sec), '%Y-%m-%dT%H:%M:%SZ') AS found_at,
                NOT pg.failed AND NOT pg.missing AS ok, NOT pg.failed AND NOT pg.pdf AS seen FROM d JOIN pg ON pg.src = d.url)"""
_GENERATED = GENERATED_AT.replace(' ', 'T') + 'Z'

_PAGE_JSON = ("struct<url:string,depth:int,http_status:int,status:string,error:string,"
              "broken_links:array<struct<url:string,status_code:int,error:string>>,"
              "assets:array<struct<url:string,type:string,status_code:int,size_bytes:bigint,error:string>>,"
              "discovered_at:string,seo:struct<has_title:boolean,title:string>>")


@register("report_pages", oracle=f"""
WITH RECURSIVE {_CRAWL}, {_LINK_STATUS}, {_CHECKED}, {_BROKEN_PER_PAGE}, {_ROWS}
SELECT host AS site_id, ord, rows.url, CAST(rows.depth AS INT) AS depth, CASE WHEN ok THEN 'ok' ELSE 'error' END AS status,
       CAST(CASE WHEN br.n IS NOT NULL THEN br.n WHEN ok THEN 0 END AS INT) AS n_broken, CAST(CASE WHEN seen THEN 5 ELSE 0 END AS INT) AS n_assets
FROM rows LEFT JOIN br ON br.src = rows.url""")
def report_pages(spark, sf_dir):
    """R5 + R6 + R9: the pages of the report in their order, with the sizes of their nested lists."""
    a = _audit(spark, sf_dir)
    pages = R.ordered_pages(R.nest_pages(a.pages, a.broken, a.inventory))
    n = F.size("broken_links")
    return pages.select("site_id", "ord", "url", "depth", "status", F.when(n >= 0, n).alias("n_broken"), F.size("assets").alias("n_assets"))


@register("report_json", oracle=f"""
WITH RECURSIVE {_CRAWL}, {_LINK_STATUS}, {_CHECKED}, {_BROKEN_PER_PAGE}, {_ROWS}, {_ASSET_STATUS},
aj AS (SELECT a.src,
              string_agg('{{"url":"' || a.asset_url || '","type":"' || a.type || '","status_code":' || coalesce(asz.status_code, 0)
                         || ',"size_bytes":' || coalesce(asz.size_bytes, 0)
                         || CASE WHEN coalesce(asz.error, '') <> '' THEN ',"error":"' || asz.error || '"' ELSE '' END || '}}', ','
                         ORDER BY a.type, a.asset_url) AS js
       FROM ({_WA}) a JOIN pg ON pg.page_id = a.page_id LEFT JOIN asz ON a.asset_url = asz.url WHERE {_EXPANDS} GROUP BY 1)
SELECT host AS site_id, CAST(-1 AS BIGINT) AS ord,
       '{{"root_url":"' || src || '","depth":' || lim || ',"generated_at":"{_GENERATED}"}}' AS json FROM pg WHERE k = 0
UNION ALL
SELECT host AS site_id, ord,
       '{{"url":"' || rows.url || '","depth":' || rows.depth
       || ',"http_status":' || CASE WHEN failed THEN 0 WHEN missing THEN 404 ELSE 200 END
       || ',"status":"' || CASE WHEN ok THEN 'ok' ELSE 'error' END || '"'
       || CASE WHEN failed THEN ',"error":"HTTP 503 (retriable)"' ELSE '' END
       || ',"broken_links":' || CASE WHEN br.js IS NOT NULL THEN '[' || br.js || ']' WHEN ok THEN '[]' ELSE 'null' END
       || ',"assets":[' || coalesce(aj.js, '') || ']'
       || ',"discovered_at":"' || found_at || '"'
       || ',"seo":{{"has_title":' || seen || ',"title":' || CASE WHEN seen THEN CAST(to_json(title) AS VARCHAR) ELSE '""' END
       || ',"has_description":' || (seen AND has_description)
       || ',"description":"' || CASE WHEN seen AND has_description THEN 'D' || page_id ELSE '' END
       || '","has_h1":' || (seen AND has_h1) || '}}}}' AS json
FROM rows LEFT JOIN br ON br.src = rows.url LEFT JOIN aj ON aj.src = rows.url""")
def report_json(spark, sf_dir):
    """R6 + R7 + R8: the report as JSON rows, a header and one row a page (names and omissions of the reference)."""
    return _report(spark, sf_dir).select("site_id", "ord", "json")


@register("report_documents", oracle=f"""
WITH RECURSIVE {_CRAWL}, {_LINK_STATUS}, {_CHECKED}, {_BROKEN_PER_PAGE}, {_ROWS},
fields AS (
  SELECT host, 'root_url' AS field, '"' || src || '"' AS value FROM pg WHERE k = 0
  UNION ALL SELECT host, 'generated_at', '"{_GENERATED}"' FROM pg WHERE k = 0
  UNION ALL SELECT host, 'page url', '"' || rows.url || '"' FROM rows
  UNION ALL SELECT host, 'page depth', CAST(rows.depth AS VARCHAR) FROM rows
  UNION ALL SELECT host, 'page http_status', CASE WHEN failed THEN '0' WHEN missing THEN '404' ELSE '200' END FROM rows
  UNION ALL SELECT host, 'page status', CASE WHEN ok THEN '"ok"' ELSE '"error"' END FROM rows
  UNION ALL SELECT host, 'page error', '"HTTP 503 (retriable)"' FROM rows WHERE failed
  UNION ALL SELECT host, 'page broken_links', CASE WHEN br.js IS NOT NULL THEN '[' WHEN ok THEN '[]' ELSE 'null' END
            FROM rows LEFT JOIN br ON br.src = rows.url
  UNION ALL SELECT host, 'page discovered_at', '"' || found_at || '"' FROM rows)
SELECT host AS site_id, field, replace(value, '&', '\\u0026') AS value, count(*) AS n FROM fields GROUP BY ALL""")
def report_documents(spark, sf_dir):
    """Indented documents, one a site, written and read back line by line: header and page fields with their values."""
    path = scratch(spark, "documents")
    R.write_documents(_report(spark, sf_dir), path, indent=True)
    line = r'^( {2}| {6})"(\w+)": (.*?),?$'
    part = [F.regexp_extract("value", line, k) for k in (1, 2, 3)]
    field = F.concat(F.when(F.length(part[0]) == 6, F.lit("page ")).otherwise(F.lit("")), part[1])
    rows = spark.read.text(path).select(F.col("site_id").cast("string").alias("site_id"), field.alias("field"), part[2].alias("value"))
    return rows.filter(F.col("field").isin(
        "root_url", "generated_at", "page url", "page depth", "page http_status", "page status", "page error",
        "page broken_links", "page discovered_at")).groupBy("site_id", "field", "value").agg(F.count(F.lit(1)).alias("n"))


@register("report_json_fields", oracle=f"""
WITH RECURSIVE {_CRAWL}, {_LINK_STATUS}, {_CHECKED}, {_BROKEN_PER_PAGE}, {_ROWS}
SELECT host AS site_id, ord, rows.url, CASE WHEN failed THEN 'HTTP 503 (retriable)' END AS error,
       CAST(CASE WHEN br.n IS NOT NULL THEN br.n WHEN ok THEN 0 END AS INT) AS n_broken, found_at AS discovered_at
FROM rows LEFT JOIN br ON br.src = rows.url""")
def report_json_fields(spark, sf_dir):
    """R7 + S4: the report written to files, read back and parsed: omitted errors, null link lists, RFC 3339 seconds."""
    path = scratch(spark, "report")
    R.write_report(_report(spark, sf_dir), path)
    rows = spark.read.parquet(path).filter("ord >= 0").select("site_id", "ord", F.from_json("json", _PAGE_JSON).alias("p"))
    n = F.size("p.broken_links")
    return rows.select("site_id", "ord", "p.url", "p.error", F.when(n >= 0, n).alias("n_broken"), "p.discovered_at")
