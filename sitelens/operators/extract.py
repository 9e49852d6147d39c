"""Extraction: page bodies -> link, asset and SEO rows.

A page is scanned once: the lexer's tokens and the start tags are materialised as columns, and links, assets and SEO are all derived from them inside the same projection.  Nothing here
shuffles; the stage is fused with the scan and runs wherever the body partitions are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.functions import html as H
from sitelens.functions import urls as U
from sitelens.functions.memo import memo



def _empty_seo():
    return F.struct(F.lit(False).alias("has_title"), F.lit("").alias("title"),
                    F.lit(False).alias("has_description"), F.lit("").alias("description"),
                    F.lit(False).alias("has_h1"))


def link_refs(tags: Column) -> Column:
    """X2 input: every non-empty ``a[href]`` in document order (no special-URL filter for anchors)."""
    return F.flatten(F.transform(F.filter(tags, lambda t: t["name"] == "a"), lambda t: H.attr_values(t, "href")))


def asset_refs(tags: Column) -> Column:
    """X3a-X3e: img src / first srcset candidate / style url(); script src; stylesheet link href."""
    def per_tag(t, pairs):
        img = F.concat(H.pair_values(pairs, "src"),
                       F.transform(H.pair_values(pairs, "srcset", non_empty=False), H.srcset_first),
                       F.flatten(F.transform(H.pair_values(pairs, "style", non_empty=False), H.css_urls)))
        is_sheet = F.exists(pairs, lambda p: (p["k"] == "rel") & (p["v"] == "stylesheet"))
        empty = F.array().cast("array<string>")
        return F.when(t["name"] == "img", img) \
            .when(t["name"] == "script", H.pair_values(pairs, "src")) \
            .when((t["name"] == "link") & is_sheet, H.pair_values(pairs, "href")) \
            .otherwise(empty)

    # only tags that can carry assets; their attribute pairs are zipped once per tag
    cands = F.filter(tags, lambda t: t["name"].isin("img", "script", "link"))
    refs = F.flatten(F.transform(cands, lambda t: U.let(H.attr_pairs(t), lambda pairs: per_tag(t, pairs))))
    return F.filter(refs, lambda r: ~U.is_special_url(r))


def extract_pages(df: DataFrame, url_col: str = "url", body_col: str = "body", ctype_col: str | None = "content_type",
                  cap: int | None = None) -> DataFrame:
    """Add ``media``, ``links`` ARRAY<STRING>, ``assets`` ARRAY<STRUCT<url,type>>, ``seo`` STRUCT.

    The base of every reference is the *normalised requested URL* (redirect targets and ``<base>``
    are ignored, as in the reference).  HTML gets all three outputs, XML only SEO, others none.
    Whole bodies are read; only an explicit ``cap`` (bytes) cuts them, and then ``truncated`` says which.
    """
    media = H.media_of(F.col(ctype_col)) if ctype_col else F.lit("html")
    d = df.withColumns({
        "media": media,
        "_base": U.normalize_url(url_col),
        "_body": F.coalesce(F.col(body_col) if cap is None else H.cap_text_bytes(F.col(body_col), cap), F.lit("")),
    })
    if cap is not None:
        d = d.withColumn("truncated", F.coalesce(F.octet_length(body_col) > cap, F.lit(False)))
    d = d.withColumn("_bsplit", U.split_url(F.col("_base")))
    d = d.withColumn("_lexed", F.when(F.col("media") == "html", H.tokens(F.col("_body"))))
    d = d.withColumn("_tokens", H.effective_tokens(F.col("_lexed")))
    d = d.withColumn("_tags", memo(("start_tags",), lambda: H.start_tags(F.col("_tokens"))))
    d = d.withColumn("_resolved", memo(("resolved_refs",), _resolved_refs))
    return d.withColumns(memo(("extract_outputs",), _extract_outputs)) \
        .drop("_body", "_lexed", "_tokens", "_tags", "_base", "_bsplit", "_resolved")


def _resolved_refs() -> Column:
    """Links and asset references of a page, resolved in one pass: ARRAY<STRUCT<k, u>> (k 'l' | 'a')."""
    tags, base, bsplit = F.col("_tags"), F.col("_base"), F.col("_bsplit")
    refs = F.concat(F.transform(link_refs(tags), lambda r: F.struct(F.lit("l").alias("k"), r.alias("r"))),
                    F.transform(asset_refs(tags), lambda r: F.struct(F.lit("a").alias("k"), r.alias("r"))))
    return F.transform(refs, lambda x: F.struct(x["k"].alias("k"), U.resolve_url(base, x["r"], bsplit).alias("u")))


def _distinct_of(kind: str) -> Column:
    hit = F.filter(F.col("_resolved"), lambda x: (x["k"] == kind) & x["u"].isNotNull() & (x["u"] != ""))
    return F.array_distinct(F.transform(hit, lambda x: x["u"]))


def _extract_outputs() -> dict:
    base, tags, found = F.col("_base"), F.col("_tags"), F.col("_tokens")
    links = _distinct_of("l")
    assets = F.transform(_distinct_of("a"), lambda u: F.struct(u.alias("url"), H.asset_type(u).alias("type")))
    t, dsc = H.seo_title(found), H.seo_description(tags)
    html_seo = F.struct(t["has_title"].alias("has_title"), t["title"].alias("title"),
                        dsc["has_description"].alias("has_description"), dsc["description"].alias("description"),
                        H.seo_has_h1(found).alias("has_h1"))
    x = H.seo_xml_title(F.col("_body"))
    xml_seo = F.struct(x["has_title"].alias("has_title"), x["title"].alias("title"),
                       F.lit(False).alias("has_description"), F.lit("").alias("description"), F.lit(False).alias("has_h1"))
    is_html = F.col("media") == "html"
    empty_assets = F.array().cast("array<struct<url:string,type:string>>")
    return {
        "links": F.when(is_html & base.isNotNull(), links).otherwise(F.array().cast("array<string>")),
        "assets": F.when(is_html & base.isNotNull(), assets).otherwise(empty_assets),
        "seo": F.when(is_html, html_seo).when(F.col("media") == "xml", xml_seo).otherwise(_empty_seo()),
    }


def explode_positions(df: DataFrame, keys: list[str], array_col: str, names: tuple[str, str]) -> DataFrame:
    """(keys..., pos, value) rows of an array column.

    ``posexplode_outer`` + a filter on the generated position: plain ``posexplode`` makes the
    optimizer infer ``size(array) > 0`` and push it below the projection, which would evaluate the
    whole extraction expression a second time.
    """
    out = df.select(*keys, F.posexplode_outer(array_col).alias(*names))
    return out.filter(F.col(names[0]).isNotNull())


def page_links(pages: DataFrame, keys: list[str], page_col: str = "page_norm") -> DataFrame:
    """Explode ``links`` into (keys..., pos, link, link_norm); position = first occurrence order."""
    out = explode_positions(pages, keys, "links", ("pos", "link"))
    return out.withColumn("link_norm", U.normalize_or_keep("link"))


def page_assets(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Explode ``assets`` into (keys..., pos, asset_url, asset_norm, type)."""
    out = explode_positions(pages, keys, "assets", ("pos", "a"))
    return out.select(*keys, "pos",
                      F.col("a.url").alias("_u"), F.col("a.type").alias("type")) \
        .withColumn("asset_norm", U.normalize_or_keep("_u")).withColumnRenamed("_u", "asset_url")


def extract_seo_xml(df: DataFrame, body_col: str = "body") -> DataFrame:
    """X6 as a table job: (..., has_title, title) for XML feeds."""
    x = H.seo_xml_title(F.col(body_col))
    return df.withColumns({"has_title": x["has_title"], "title": x["title"]})


def extract_links(captures: DataFrame, keys: list[str], url_col: str = "url", body_col: str = "body",
                  ctype_col: str | None = "content_type") -> DataFrame:
    """X2 as a table job: (keys..., pos, link, link_norm) for every HTML capture."""
    ex = extract_pages(captures, url_col=url_col, body_col=body_col, ctype_col=ctype_col)
    return page_links(ex, keys)


def extract_assets(captures: DataFrame, keys: list[str], url_col: str = "url", body_col: str = "body",
                   ctype_col: str | None = "content_type") -> DataFrame:
    """X3 + X4 as a table job: (keys..., pos, asset_url, asset_norm, type)."""
    ex = extract_pages(captures, url_col=url_col, body_col=body_col, ctype_col=ctype_col)
    return page_assets(ex, keys)


def extract_seo(captures: DataFrame, keys: list[str], url_col: str = "url", body_col: str = "body",
                ctype_col: str | None = "content_type") -> DataFrame:
    """X5/X6 as a table job: (keys..., has_title, title, has_description, description, has_h1)."""
    ex = extract_pages(captures, url_col=url_col, body_col=body_col, ctype_col=ctype_col)
    return ex.select(*keys, "seo.*")
