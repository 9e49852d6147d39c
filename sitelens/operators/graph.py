"""Link graph: classification, depth-limited BFS and work lists.

``crawl_depths`` is an iterative job of at most ``depth`` rounds for all sites at once.  Each round
joins the current frontier with the pre-partitioned edge table and anti-joins the candidates with the
bucketed table of visited URLs, to which it appends its level (lineage stays one level deep and a lost
executor only re-reads files).  Whether a frontier is broadcast is left to AQE, which knows its size in bytes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.functions import urls as U
from sitelens.operators.canonical import dedupe_first
from sitelens.operators.skew import with_site
from sitelens.session import ensure_checkpoint_dir, store

def _site_opts(sites: DataFrame) -> DataFrame:
    """One row a site: its host (parsed here once, not again for every link) and its depth limit."""
    return sites.select("site_id", "root_url", U.host_of(F.col("root_url")).alias("root_host"), F.col("depth").alias("limit"))


def _same_host() -> Column:
    return F.coalesce(U.host_of(F.col("link")) == F.col("root_host"), F.lit(False))


def crawlable_edges(edges: DataFrame, sites: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Edges that may become page tasks: same host as the site's root URL; dst = canonical link.

    With ``num_partitions`` the result is hash-partitioned by (site_id, src) and deduplicated inside
    that partitioning (one exchange; links are already distinct per page, so few duplicates travel).
    """
    e = same_host_edges(edges, sites).select("site_id", "src", "dst")
    if num_partitions:
        e = e.repartition(num_partitions, "site_id", "src")
    return e.distinct()


def same_host_edges(edges: DataFrame, sites: DataFrame) -> DataFrame:
    """(site_id, src, dst, from_root): the edges on their site's host, repeats included; map-only but for the join with the sites."""
    roots = _site_opts(sites).withColumn("root_norm", F.coalesce(U.normalize_url("root_url"), F.lit("")))
    e = with_site(edges, roots, ["link"]).filter(_same_host())
    dst = F.col("link_norm") if "link_norm" in edges.columns else F.coalesce(U.normalize_url("link"), F.lit(""))
    return e.select("site_id", "src", dst.alias("dst"), (F.col("src") == F.col("root_norm")).alias("from_root"))


def crawl_depths(edges: DataFrame, sites: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """(site_id, norm_url, depth) reachable from the root within the site's depth limit.

    ``edges``: (site_id, src, link) with ``src`` the canonical URL of a fetched page and ``link`` a
    resolved link of that page.  Depth N keeps pages at depth 0..N-1; depth <= 1 keeps the root only.
    Each canonical URL is visited once, at its minimum depth.
    """
    e = store(crawlable_edges(edges, sites, num_partitions), "edges")
    opts = _site_opts(sites).select("site_id", "limit")
    max_limit = opts.agg(F.max("limit")).first()[0] or 0
    roots = sites.select("site_id", F.coalesce(U.normalize_url("root_url"), F.lit("")).alias("norm_url"))
    visited = Visited(sites.sparkSession)
    visited.append(roots, 0)
    # a level at depth d expands only where the site's limit exceeds d + 1
    for d in range(max_limit - 1):
        f = visited.level(d).join(opts.filter(F.col("limit") > d + 1), "site_id", "left_semi")
        cand = e.alias("e").join(f.alias("f"), (F.col("e.site_id") == F.col("f.site_id")) & (F.col("e.src") == F.col("f.norm_url"))) \
            .select(F.col("e.site_id").alias("site_id"), F.col("e.dst").alias("norm_url")).distinct()
        visited.append(visited.unseen(cand), d + 1)
        if visited.level(d + 1).isEmpty():
            break
    return visited.close()


class Visited:
    """The URLs that a crawl has reached, in a table bucketed and sorted by (site_id, norm_url).

    Every round anti-joins its candidates with the table bucket by bucket and appends its level, so what was
    reached before is read but never shuffled again, however deep the crawl goes.
    """

    KEYS = ["site_id", "norm_url"]
    COLUMNS = "site_id string, norm_url string, depth int"

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.name = f"visited_{uuid.uuid4().hex}"
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored/{self.name}"
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.sql(f"CREATE TABLE {self.name} ({self.COLUMNS}) USING parquet LOCATION '{self.path}' "
                  f"CLUSTERED BY ({', '.join(self.KEYS)}) SORTED BY ({', '.join(self.KEYS)}) INTO {self.buckets} BUCKETS")

    def level(self, depth: int) -> DataFrame:
        return self.spark.table(self.name).filter(F.col("depth") == depth).select(*self.KEYS)

    def unseen(self, candidates: DataFrame) -> DataFrame:
        return candidates.join(self.spark.table(self.name).select(*self.KEYS), self.KEYS, "left_anti")

    def append(self, rows: DataFrame, depth: int) -> None:
        rows.select(*self.KEYS, F.lit(depth).cast("int").alias("depth")).write.bucketBy(self.buckets, *self.KEYS).sortBy(*self.KEYS) \
            .mode("append").format("parquet").option("path", self.path).saveAsTable(self.name)

    def close(self) -> DataFrame:
        """All levels, read from the files; the name leaves the catalogue."""
        self.spark.sql(f"DROP TABLE {self.name}")
        return self.spark.read.schema(self.COLUMNS).parquet(self.path)


def classify_links(links: DataFrame, depths: DataFrame, sites: DataFrame) -> DataFrame:
    """G1: action 'crawl' iff the site allows depth+1 and the link is on the root's host, else 'check'.

    ``links``: (site_id, page_norm, pos, link[, link_norm]).
    """
    j = with_site(links.join(depths.withColumnRenamed("norm_url", "page_norm"), ["site_id", "page_norm"]), _site_opts(sites), ["page_norm"])
    crawl = (F.col("limit") > F.col("depth") + 1) & _same_host()
    return j.withColumn("action", F.when(crawl, F.lit("crawl")).otherwise(F.lit("check"))).drop("root_url", "root_host", "limit")


def link_worklist(classified: DataFrame) -> DataFrame:
    """Distinct links to check (external, or at the depth boundary); url = first claim's spelling.

    First claim order is pinned to (page depth, page URL, position) -- the reference's order depends
    on worker timing.
    """
    c = classified.filter(F.col("action") == "check").withColumn(
        "norm_url", F.coalesce(U.normalize_url("link"), F.lit("")))
    first = dedupe_first(c.select("site_id", "norm_url", "depth", "page_norm", "pos", "link"),
                         ["site_id", "norm_url"], ["depth", "page_norm", "pos"])
    return first.select("site_id", "norm_url", F.col("link").alias("url"))


def asset_worklist(assets: DataFrame, depths: DataFrame) -> DataFrame:
    """Distinct assets over all crawled pages, keyed and reported by canonical URL (raw if unparseable)."""
    a = assets.join(depths.withColumnRenamed("norm_url", "page_norm"), ["site_id", "page_norm"])
    first = dedupe_first(a.select("site_id", F.col("asset_norm").alias("norm_url"), "depth", "page_norm", "pos", "type"),
                         ["site_id", "norm_url"], ["depth", "page_norm", "pos"])
    return first.select("site_id", "norm_url", "type")


def external_links(links: DataFrame, sites: DataFrame) -> DataFrame:
    """Links whose host differs from the root's host (checked, never crawled)."""
    j = with_site(links, _site_opts(sites).drop("limit", "root_url"), ["link"])
    return j.filter(~_same_host()).drop("root_host")


def unfetched_frontier(depths: DataFrame, fetched: DataFrame) -> DataFrame:
    """URLs the crawl reaches that have no page capture (next batch / cancelled set)."""
    return depths.join(fetched.select("site_id", "norm_url").distinct(), ["site_id", "norm_url"], "left_anti")
