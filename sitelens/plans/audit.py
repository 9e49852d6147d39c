"""The whole audit as one composition of DataFrame operators.

captures + sites -> deadline cut (F9) -> attempt resolution (F2) -> one-pass extraction (X0) ->
depth-limited BFS (G2) -> page rows (F8) -> link / asset work lists (G1, G4, G5) -> probe
resolution (F4, F5) -> broken-link and asset joins (R2, R3) -> nesting (R6).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions import status as S
from sitelens.session import store
from sitelens.operators import extract as X
from sitelens.operators import graph as G
from sitelens.operators import outcomes as O
from sitelens.operators import report as R


@dataclass
class Audit:
    outcomes: DataFrame
    extracted: DataFrame
    depths: DataFrame
    pages: DataFrame
    links: DataFrame
    assets: DataFrame
    classified: DataFrame
    link_status: DataFrame
    asset_status: DataFrame
    broken: DataFrame
    inventory: DataFrame


def run_audit(captures: DataFrame, sites: DataFrame, match: str = "exact", missing: str = "cancel") -> Audit:
    """``missing``: for a site with a deadline, work reached but not captured by then becomes a
    'context canceled' row ("cancel", the reference's behaviour) or is left out ("drop")."""
    caps = O.apply_deadline(captures, sites)
    page_caps = caps.filter(F.col("kind") == "page")
    # outcome per URL without bodies: the body column is pruned from this scan and shuffle
    outcomes = store(O.resolve_attempts(page_caps.drop("body"), sites), "outcomes")  # one row per URL, used twice
    # extraction runs map-side on every winning capture; only the small extracted arrays of the
    # attempt that won are kept (semi join), so no body ever crosses a shuffle
    cand = O.with_norm(page_caps.filter(S.is_win(F.col("status_code"), F.col("error"))))
    own = ["site_id", "norm_url", "attempt", "url", "fetched_at", "status_code"]
    cand = X.extract_pages(cand.select(*own, "body", "content_type"), url_col="norm_url")
    winners = outcomes.select("site_id", "norm_url", F.col("win_attempt").alias("w_attempt"), F.col("win_url").alias("w_url"),
                              F.col("fetched_at").alias("w_at"), F.col("http_status").alias("w_status")).filter("w_attempt IS NOT NULL")
    same = (F.col("attempt") == F.col("w_attempt")) & (F.col("url") == F.col("w_url")) & F.col("fetched_at").eqNullSafe(F.col("w_at")) \
        & (F.col("status_code") == F.col("w_status"))
    extracted = cand.select(*own, "links", "assets", "seo").join(winners, ["site_id", "norm_url"]).filter(same) \
        .groupBy("site_id", "norm_url").agg(F.min(F.struct("links", "assets", "seo")).alias("x")).select("site_id", "norm_url", "x.*")
    # stored by column: links, assets and SEO are each read without the others
    extracted = store(extracted, "extracted")
    links = X.page_links(extracted.withColumnRenamed("norm_url", "page_norm"), ["site_id", "page_norm"])
    assets = X.page_assets(extracted.withColumnRenamed("norm_url", "page_norm"), ["site_id", "page_norm"])
    depths = G.crawl_depths(links.select("site_id", F.col("page_norm").alias("src"), "link"), sites)

    cancel = F.lit(missing == "cancel")
    deadline = sites.select("site_id", (F.col("deadline").isNotNull() & cancel).alias("has_deadline"))
    rows = O.page_rows(outcomes, depths, sites).join(deadline, "site_id")
    rows = rows.filter((F.col("error") != O.CANCELLED) | F.col("has_deadline")).drop("has_deadline")
    seo = extracted.select("site_id", "norm_url", "seo")
    empty_seo = F.struct(F.lit(False).alias("has_title"), F.lit("").alias("title"),
                         F.lit(False).alias("has_description"), F.lit("").alias("description"),
                         F.lit(False).alias("has_h1"))
    pages = rows.join(seo, ["site_id", "norm_url"], "left").withColumn("seo", F.coalesce(F.col("seo"), empty_seo))

    # stored: the work lists, the counts of hot keys and the joins read them, each its own columns
    crawled = depths.select("site_id", F.col("norm_url").alias("page_norm"))
    crawled_links = store(links.join(crawled, ["site_id", "page_norm"], "left_semi"), "links")
    crawled_assets = store(assets.join(crawled, ["site_id", "page_norm"], "left_semi"), "assets")
    classified = G.classify_links(crawled_links, depths, sites)
    lw = G.link_worklist(classified)
    aw = G.asset_worklist(crawled_assets, depths)

    probes = caps.filter(F.col("kind") == "link").select("site_id", "url", "method", "status_code", "error", "fetched_at")
    lstat = O.resolve_link_probe(probes).drop("url")
    cancelled = F.col("status_code").isNull() & F.col("has_deadline")
    link_status = lw.join(lstat, ["site_id", "norm_url"], "left").join(deadline, "site_id") \
        .filter(F.col("status_code").isNotNull() | F.col("has_deadline")) \
        .select("site_id", "norm_url", "url",
                F.when(cancelled, F.lit(0)).otherwise(F.col("status_code")).cast("int").alias("status_code"),
                F.when(cancelled, F.lit("both HEAD and GET requests failed: context canceled"))
                .otherwise(F.col("error")).alias("error"))

    aprobes = caps.filter(F.col("kind") == "asset").select("site_id", "url", "method", "status_code", "error",
                                                           "content_length", "body_bytes", "fetched_at")
    astat = O.resolve_asset_probe(aprobes).drop("url")
    a_cancelled = F.col("status_code").isNull() & F.col("has_deadline")
    asset_status = aw.join(astat, ["site_id", "norm_url"], "left").join(deadline, "site_id") \
        .filter(F.col("status_code").isNotNull() | F.col("has_deadline")) \
        .select("site_id", "norm_url", F.col("norm_url").alias("url"), "type",
                F.when(a_cancelled, F.lit(0)).otherwise(F.col("status_code")).cast("int").alias("status_code"),
                F.when(a_cancelled, F.lit(0)).otherwise(F.col("size_bytes")).cast("long").alias("size_bytes"),
                F.when(a_cancelled, F.lit("request failed: context canceled")).otherwise(F.col("error")).alias("error"))

    # stored, so that R2 and R3 join two plain shuffles: AQE can split a link or asset that every page has
    link_status, asset_status = store(link_status, "link-status"), store(asset_status, "asset-status")
    broken = R.broken_links(crawled_links, link_status, match)
    inventory = R.asset_inventory(crawled_assets, asset_status)
    return Audit(outcomes, extracted, depths, pages, crawled_links, crawled_assets, classified, link_status,
                 asset_status, broken, inventory)


def audit_report(captures: DataFrame, sites: DataFrame, generated_at: str, match: str = "exact",
                 missing: str = "cancel") -> DataFrame:
    """The report of every site as JSON rows (see ``operators.report.report_rows``)."""
    return report_of(run_audit(captures, sites, match, missing), sites, generated_at)


def report_of(a: Audit, sites: DataFrame, generated_at: str) -> DataFrame:
    """The report of an audit that has already run."""
    return R.report_rows(R.nest_pages(a.pages, a.broken, a.inventory), sites, generated_at)


def audit(captures: DataFrame, sites: DataFrame, generated_at: str, match: str = "exact") -> tuple[Audit, DataFrame]:
    """The whole pipeline once: the audit's tables and the report rows made from them."""
    a = run_audit(captures, sites, match)
    return a, report_of(a, sites, generated_at)
