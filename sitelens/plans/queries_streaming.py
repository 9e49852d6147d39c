"""Streaming queries: T1-T4 replayed with Trigger.AvailableNow and compared with batch results."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitelens.operators import extract as X
from sitelens.plans.catalog import register
from sitelens.plans.queries_extract import _PAGE_HREFS
from sitelens.plans.queries_graph import BFS_CTE, site_links
from sitelens.plans.duck import path_encode
from sitelens.sources import fixtures as FX
from sitelens.streaming import jobs as T


FILE_ROWS = 1000   # rows of a table from which a micro-batch has another file
STATE_PAGES = 16384   # pages of the crawl from which its state has another partition, once each core has one


def _replay(spark, df, path, *keys, source, batches=3):
    """``df`` as a stream of ``batches`` micro-batches.

    A batch's files grow with the rows of the table ``source`` up to a shuffle's partitions: a file of one row group is
    read, and was written, by one task, however many rows it has.
    """
    files = min(source.count() // (batches * FILE_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    df.repartition(batches * max(files, 1), *keys).write.parquet(path)
    written = len(spark.read.parquet(path).inputFiles())
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", -(-written // batches)).parquet(path)


def _state_partitions(spark, pages):
    """Partitions of the state of so many pages: by their number, not the shuffle's, as each costs the same in every round."""
    least = max(spark.sparkContext.defaultParallelism, -(-pages.count() // STATE_PAGES))
    return min(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


@register("stream_claims", oracle="""
SELECT DISTINCT CAST(user_id AS VARCHAR) AS site_id,
       'http://site' || CAST(user_id AS VARCHAR) || '.example/' || event_type || '/' || CAST(event_id % 200 AS VARCHAR) AS norm_url
FROM events""")
def stream_claims(spark, sf_dir):
    """First claim per (site, canonical URL) over a replay of the request log."""
    root = T.scratch(spark, "claims")
    log = _replay(spark, FX.request_log(spark, sf_dir).select(F.col("site_id").cast("string").alias("site_id"), "url", "fetched_at", "seq"),
                  f"{root}/incoming", "seq", source=FX.table(spark, sf_dir, "events"))
    path = T.stream_claims(log, root)
    return T.read_epochs(spark, path).select("site_id", "norm_url")


@register("stream_extract", oracle=f"""
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY min(i)) - 1 AS INT) AS pos, link
FROM (SELECT page_id, i, origin || {path_encode('href')} AS link FROM ({_PAGE_HREFS}) h) t
GROUP BY page_id, link""")
def stream_extract(spark, sf_dir):
    """Extraction on arrival (links, assets, SEO tables per micro-batch); links compared."""
    root = T.scratch(spark, "extract")
    table = FX.table(spark, sf_dir, "pages")
    pages = _replay(spark, table, f"{root}/incoming", "page_id", source=table)
    paths = T.stream_extract(pages.withColumnRenamed("html", "body"), root, ["page_id"], ctype_col=None)
    return T.read_epochs(spark, paths["links"]).select("page_id", "pos", "link")


_PRB = FX.duck(FX.PROBES_SQL)
_WL = FX.duck(FX.WEB_LINKS_SQL)
_HEAD_OK = "(head_status IS NOT NULL AND head_status NOT IN (405, 501))"


@register("stream_broken_links", oracle=f"""
WITH ls AS (SELECT site_id, url,
              CASE WHEN {_HEAD_OK} THEN head_status WHEN get_status IS NOT NULL THEN get_status ELSE 0 END AS status_code,
              CASE WHEN {_HEAD_OK} OR get_status IS NOT NULL THEN ''
                   ELSE 'both HEAD and GET requests failed: connection reset' END AS error
            FROM ({_PRB}) p)
SELECT w.src AS page_norm, w.pos, w.link,
       CAST(ls.status_code AS INT) AS status_code, ls.error
FROM ({_WL}) w JOIN ls ON w.link = ls.url AND w.host = ls.site_id WHERE ls.status_code >= 400 OR ls.error <> ''""")
def stream_broken_links(spark, sf_dir):
    """Stream of probe captures joined with static page links; broken pairs emitted once."""
    root = T.scratch(spark, "broken")
    caps = FX.captures(spark, sf_dir).filter(F.col("kind") == "link").select("site_id", "url", "method", "status_code", "error", "fetched_at")
    stream = _replay(spark, caps, f"{root}/incoming", "method", "url", source=FX.table(spark, sf_dir, "pages"))  # a HEAD and its GET land in different batches
    links = X.page_links(site_links(spark, sf_dir), ["site_id", "page_norm"])
    out = T.stream_broken_links(links, stream, root)
    return T.read_epochs(spark, out).select("page_norm", "pos", "link", "status_code", "error")


@register("frontier_rounds", oracle=f"""
WITH RECURSIVE {BFS_CTE}
SELECT url AS norm_url, CAST(depth AS INT) AS depth FROM d""")
def frontier_rounds(spark, sf_dir):
    """T4: micro-batches of page captures grow the edge table; newly reachable URLs emitted per round."""
    root = T.scratch(spark, "frontier")
    wp = FX.web_pages(spark, sf_dir).select("site_id", "page_id", "url", F.col("html").alias("body"))
    stream = _replay(spark, wp, f"{root}/incoming", "page_id", source=FX.table(spark, sf_dir, "pages"))
    out = T.frontier_rounds(stream, FX.sites(spark, sf_dir), root, ["site_id"], _state_partitions(spark, FX.table(spark, sf_dir, "pages")))
    return T.read_epochs(spark, out).groupBy("norm_url").agg(F.min("depth").alias("depth"))
