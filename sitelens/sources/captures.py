"""Sources: captured request/response rows and per-site options."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens import schemas
from sitelens.functions import html as H
from sitelens.functions import urls as U

# Reference defaults for per-site options.
DEFAULT_DEPTH = 10
DEFAULT_RETRIES = 1
DEFAULT_DELAY_MS = 0
DEFAULT_RPS = 0


def read_captures(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Captures with the fixed schema; downstream projections prune ``body`` from probe scans."""
    return spark.read.schema(schemas.CAPTURES).format(fmt).load(path)


def captures_from_pages(pages: DataFrame, site_id: Column | str, url_col: str = "url", body_col: str = "html",
                        fetched_at: Column | None = None, status_col: str | None = None,
                        content_type_col: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Adapt a plain (url, html) corpus table to captures: GET, attempt 0, 200, text/html."""
    sid = F.lit(site_id) if isinstance(site_id, str) else site_id
    body = F.col(body_col)
    return pages.select(
        *(keep or []), sid.alias("site_id"), F.col(url_col).alias("url"), F.lit("GET").alias("method"), F.lit("page").alias("kind"),
        F.lit(0).alias("attempt"),
        (F.col(status_col).cast("int") if status_col else F.lit(200)).alias("status_code"),
        (F.col(content_type_col) if content_type_col else F.lit("text/html")).alias("content_type"),
        F.octet_length(body).cast("long").alias("content_length"), body.alias("body"),
        F.octet_length(body).cast("long").alias("body_bytes"), F.lit(None).cast("string").alias("final_url"),
        F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("user_agent"),
        (fetched_at if fetched_at is not None else F.lit(None).cast("timestamp")).alias("fetched_at"))


def site_config(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S3: apply option defaults; rps > 0 forces delay 0; a root URL that does not parse is rejected.

    Returns (sites, rejected_sites).
    """
    rps = F.coalesce(F.col("rps").cast("int"), F.lit(DEFAULT_RPS))
    cfg = df.select(
        F.col("site_id").cast("string").alias("site_id"), F.col("root_url"),
        F.coalesce(F.col("depth").cast("int"), F.lit(DEFAULT_DEPTH)).alias("depth"),
        F.coalesce(F.col("retries").cast("int"), F.lit(DEFAULT_RETRIES)).alias("retries"),
        F.when(rps > 0, F.lit(0).cast("long"))
         .otherwise(F.coalesce(F.col("delay_ms").cast("long"), F.lit(DEFAULT_DELAY_MS).cast("long"))).alias("delay_ms"),
        rps.alias("rps"),
        F.coalesce(F.col("user_agent"), F.lit("")).alias("user_agent"),
        F.col("deadline").cast("timestamp").alias("deadline") if "deadline" in df.columns
        else F.lit(None).cast("timestamp").alias("deadline"),
    ).withColumn("_ok", U.normalize_url(F.col("root_url")).isNotNull())
    return cfg.filter("_ok").drop("_ok"), cfg.filter("NOT _ok").drop("_ok")


def cap_body(captures: DataFrame, cap: int = H.HTML_BODY_CAP, asset_cap: int = H.ASSET_BODY_CAP) -> DataFrame:
    """First ``cap`` bytes of every body; GET-measured sizes capped at ``asset_cap``.

    The one operator that cuts; ``truncated`` tells which rows it changed.
    """
    cut = F.coalesce(F.octet_length("body") > cap, F.lit(False)) | F.coalesce(F.col("body_bytes") > asset_cap, F.lit(False))
    return captures.withColumns({
        "truncated": cut,
        "body": H.cap_text_bytes(F.col("body"), cap),
        "body_bytes": F.least(F.col("body_bytes"), F.lit(asset_cap).cast("long")),
    })


def route_by_media_type(captures: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(html, xml, other) branches by Content-Type substring; one scan, three filters."""
    m = captures.withColumn("media", H.media_of(F.col("content_type")))
    return m.filter(F.col("media") == "html"), m.filter(F.col("media") == "xml"), m.filter(F.col("media") == "other")
