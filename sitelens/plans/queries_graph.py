"""Graph queries: G1-G7 over the link graph of all sites."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitelens.operators import extract as X
from sitelens.operators import graph as G
from sitelens.operators import outcomes as O
from sitelens.plans.catalog import register
from sitelens.sources import fixtures as FX

CUTOFF_S = 40  # seconds after the first capture


def site_links(spark, sf_dir):
    """Every page of the sites with its extracted links (status and media type ignored)."""
    wp = FX.web_pages(spark, sf_dir)
    ex = X.extract_pages(wp.select("page_id", "site_id", "url", F.col("html").alias("body")), ctype_col=None)
    ex = O.with_norm(ex, "url")
    return ex.select("site_id", F.col("norm_url").alias("page_norm"), "links", "assets")


def graph_links(spark, sf_dir):
    return X.page_links(site_links(spark, sf_dir), ["site_id", "page_norm"])


def graph_depths(spark, sf_dir, links=None):
    links = links if links is not None else graph_links(spark, sf_dir)
    return G.crawl_depths(links.select("site_id", F.col("page_norm").alias("src"), "link"), FX.sites(spark, sf_dir))


_WL = FX.duck(FX.WEB_LINKS_SQL)
_WA = FX.duck(FX.WEB_ASSETS_SQL)
_HOST = "regexp_extract(link, '^[a-z]+://([^/?#]*)', 1)"


def bfs_cte(expands: str = "TRUE") -> str:
    """BFS over the expected links (oracle side) of pages for which ``expands`` holds: minimum depth per URL in d, page facts in pg."""
    return f"""
pg AS MATERIALIZED ({FX.duck(FX.WEB_FACTS_SQL)}),
l AS MATERIALIZED (SELECT * FROM ({_WL}) w),
e AS MATERIALIZED (SELECT l.src, l.link FROM l JOIN pg ON pg.page_id = l.page_id WHERE {expands} AND {_HOST} = l.host),
r(url, site, lim, depth) AS (SELECT src, host, lim, 0 FROM pg WHERE k = 0
                       UNION SELECT e.link, r.site, r.lim, r.depth + 1 FROM r JOIN e ON e.src = r.url WHERE r.depth + 1 < r.lim),
d AS (SELECT url, site, lim, min(depth) AS depth FROM r GROUP BY url, site, lim)"""


BFS_CTE = bfs_cte()
IS_CRAWL = f"(d.depth + 1 < d.lim AND {_HOST.replace('link', 'l.link')} = l.host)"


@register("crawl_depths", oracle=f"""
WITH RECURSIVE {BFS_CTE}
SELECT url AS norm_url, CAST(depth AS INT) AS depth FROM d""")
def crawl_depths(spark, sf_dir):
    """G2 + G3: depth-limited BFS from the root inside the root's host; each canonical URL once, min depth."""
    return graph_depths(spark, sf_dir).select("norm_url", "depth")


@register("classify_links", oracle=f"""
WITH RECURSIVE {BFS_CTE}
SELECT l.src AS page_norm, CAST(l.pos AS INT) AS pos, l.link,
       CASE WHEN {IS_CRAWL} THEN 'crawl' ELSE 'check' END AS action
FROM l JOIN d ON l.src = d.url""")
def classify_links(spark, sf_dir):
    """G1: every link of every crawled page marked 'crawl' or 'check'."""
    links = graph_links(spark, sf_dir)
    depths = graph_depths(spark, sf_dir, links)
    c = G.classify_links(links, depths, FX.sites(spark, sf_dir))
    return c.select("page_norm", "pos", "link", "action")


_CHECKS = f"""
c AS (SELECT l.src, l.host, l.pos, l.link, d.depth, regexp_replace(l.link, '/+$', '') AS norm
      FROM l JOIN d ON l.src = d.url WHERE NOT {IS_CRAWL})"""


@register("link_worklist", oracle=f"""
WITH RECURSIVE {BFS_CTE}, {_CHECKS},
k AS (SELECT host, norm, link, row_number() OVER (PARTITION BY host, norm ORDER BY depth, src, pos) AS rn FROM c)
SELECT host AS site_id, norm AS norm_url, link AS url FROM k WHERE rn = 1""")
def link_worklist(spark, sf_dir):
    """G4 + G3: distinct links to check, reported by the first claim's spelling."""
    links = graph_links(spark, sf_dir)
    depths = graph_depths(spark, sf_dir, links)
    return G.link_worklist(G.classify_links(links, depths, FX.sites(spark, sf_dir))).select("site_id", "norm_url", "url")


@register("asset_worklist", oracle=f"""
WITH RECURSIVE {BFS_CTE}
SELECT DISTINCT a.asset_url AS norm_url, a.type
FROM ({_WA}) a JOIN d ON d.url = a.src""")
def asset_worklist(spark, sf_dir):
    """Distinct assets over all crawled pages, keyed by canonical URL."""
    sl = site_links(spark, sf_dir)
    depths = graph_depths(spark, sf_dir, X.page_links(sl, ["site_id", "page_norm"]))
    return G.asset_worklist(X.page_assets(sl, ["site_id", "page_norm"]), depths).select("norm_url", "type")


@register("external_links", oracle=f"""
SELECT src AS page_norm, pos, link FROM ({_WL}) w WHERE {_HOST} <> host""")
def external_links(spark, sf_dir):
    """Links to other hosts (checked, never crawled)."""
    ext = G.external_links(graph_links(spark, sf_dir), FX.sites(spark, sf_dir))
    return ext.select("page_norm", "pos", "link")


@register("unfetched_frontier", oracle=f"""
WITH RECURSIVE {BFS_CTE}
SELECT d.url AS norm_url, CAST(d.depth AS INT) AS depth FROM d LEFT JOIN pg ON pg.src = d.url
WHERE pg.page_id IS NULL OR pg.page_id * 2 > {CUTOFF_S}""")
def unfetched_frontier(spark, sf_dir):
    """Crawl-reachable URLs with no page capture before the cut-off (the next batch to fetch)."""
    sites = FX.sites(spark, sf_dir, deadline=f"2024-01-01 00:00:{CUTOFF_S:02d}")
    caps = O.apply_deadline(FX.captures(spark, sf_dir), sites)
    fetched = O.with_norm(caps.filter(F.col("kind") == "page").select("site_id", "url"))
    return G.unfetched_frontier(graph_depths(spark, sf_dir), fetched).select("norm_url", "depth")
