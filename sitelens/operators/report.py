"""Report joins, ordering and assembly (R2-R8) and the JSON sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from sitelens import schemas
from sitelens.functions import status as S
from sitelens.operators.skew import hot_keys, spread_join
from sitelens.session import store

TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def link_key(match: str) -> list[str]:
    """The columns of a page link that R2 looks up."""
    return ["site_id", "link" if match == "exact" else "link_norm"]


def broken_links(page_links: DataFrame, link_status: DataFrame, match: str = "exact", hot: DataFrame | None = None) -> DataFrame:
    """R2: page links whose checked status is broken, in page link order.

    ``match='exact'`` probes the status table (keyed by canonical URL) with the page's *raw* link
    string, as the reference does, so a link spelled differently from its canonical form is never
    reported; ``match='normalized'`` joins on the canonical link instead.  The broken side is
    filtered before the join, which keeps it small.  A link that most pages have is split over many tasks;
    ``hot``: its hot keys, where they are known (``skew.hot_keys`` over ``link_key``), else counted here.
    """
    keys = link_key(match)
    bad = link_status.filter(S.is_broken(F.col("status_code"), F.col("error"))) \
        .select(F.col("site_id").alias("_s"), F.col("norm_url").alias("_k"), F.col("url").alias("status_url"),
                "status_code", "error")
    hot = hot_keys(page_links, keys) if hot is None else hot
    j = spread_join(page_links, bad, keys, ["_s", "_k"], ["page_norm"], hot)
    return j.select("site_id", "page_norm", "pos", "link", "status_url", "status_code", "error")


def asset_inventory(page_assets: DataFrame, asset_status: DataFrame) -> DataFrame:
    """Left lookup by canonical asset URL; a hit replaces the whole asset (URL becomes the
    status row's URL), a miss keeps the page's asset with status 0 / size 0.  An asset that most pages have is
    split over many tasks."""
    st = asset_status.select(F.col("site_id").alias("_s"), F.col("norm_url").alias("_k"), F.col("url").alias("s_url"),
                             F.col("type").alias("s_type"), F.col("status_code").alias("s_status"),
                             F.col("size_bytes").alias("s_size"), F.col("error").alias("s_error"))
    keys = ["site_id", "asset_norm"]
    j = spread_join(page_assets, st, keys, ["_s", "_k"], ["page_norm"], hot_keys(page_assets, keys), "left")
    hit = F.col("s_url").isNotNull()
    return j.select(
        "site_id", "page_norm", "pos",
        F.when(hit, F.col("s_url")).otherwise(F.col("asset_url")).alias("url"),
        F.when(hit, F.col("s_type")).otherwise(F.col("type")).alias("type"),
        F.when(hit, F.col("s_status")).otherwise(F.lit(0)).cast("int").alias("status_code"),
        F.when(hit, F.col("s_size")).otherwise(F.lit(0)).cast("long").alias("size_bytes"),
        F.when(hit, F.col("s_error")).otherwise(F.lit("")).alias("error"))


def _sorted_structs(values: Column, *keys: str) -> Column:
    """Sort an array of structs by the given fields in byte order, keys first."""
    return F.array_sort(values, lambda a, b: _cmp(a, b, keys))


def _cmp(a, b, keys):
    out = F.lit(0)
    for k in reversed(keys):
        out = F.when(a[k] < b[k], F.lit(-1)).when(a[k] > b[k], F.lit(1)).otherwise(out)
    return out


def nest_pages(pages: DataFrame, broken: DataFrame, inventory: DataFrame) -> DataFrame:
    """Per page: broken_links (page link order) and assets (type, url order) as nested arrays.

    Grouped by (site, page): a page's arrays are bounded by its capped body, never by the site.
    """
    bl = broken.groupBy("site_id", "page_norm").agg(F.collect_list(F.struct(
        "pos", F.col("status_url").alias("url"), "status_code", "error")).alias("_bl"))
    bl = bl.select("site_id", "page_norm", F.transform(_sorted_structs(F.col("_bl"), "pos"), lambda s: F.struct(
        s["url"].alias("url"), s["status_code"].alias("status_code"), s["error"].alias("error"))).alias("bl"))
    inv = inventory.groupBy("site_id", "page_norm").agg(F.collect_list(F.struct(
        "url", "type", "status_code", "size_bytes", "error")).alias("_as"))
    inv = inv.select("site_id", "page_norm", _sorted_structs(F.col("_as"), "type", "url").alias("assets_sorted"))
    p = pages.withColumnRenamed("norm_url", "page_norm") \
        .join(bl, ["site_id", "page_norm"], "left").join(inv, ["site_id", "page_norm"], "left")
    ok = F.col("status") == S.STATUS_OK
    empty_bl = F.array().cast("array<struct<url:string,status_code:int,error:string>>")
    empty_as = F.array().cast("array<struct<url:string,type:string,status_code:int,size_bytes:bigint,error:string>>")
    return p.select(
        "site_id", "page_norm", "url", "depth", "http_status", "status", "error",
        F.when(F.col("bl").isNotNull(), F.col("bl")).when(ok, empty_bl).alias("broken_links"),
        F.coalesce(F.col("assets_sorted"), empty_as).alias("assets"),
        "discovered_at", "seo")


def ordered_pages(nested_pages: DataFrame) -> DataFrame:
    """Pages with ``ord``, their place (from 0) in their site's order by URL.

    A range partitioning by (site, URL) splits a site of any size over many tasks; a page's place is its
    place within its part plus the sizes of the site's parts before it (one row a part and site).
    """
    order = ["site_id", "url", "page_norm"]
    parts = store(nested_pages.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "pages-by-url")
    sizes = parts.groupBy("site_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("site_id", "part", (F.sum("n").over(Window.partitionBy("site_id").orderBy("part")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("site_id", "part").orderBy("url", "page_norm")) - 1
    return parts.withColumn("inside", inside).join(before, ["site_id", "part"]) \
        .withColumn("ord", F.col("before") + F.col("inside")).drop("part", "inside", "before")


def _page_json() -> Column:
    """Field names and omission rules of the reference's JSON: an empty error is left out, the links of a
    page that is not ok are null."""
    opts = {"timestampFormat": TIMESTAMP_FORMAT}
    assets = F.transform("assets", lambda a: F.struct(
        a["url"].alias("url"), a["type"].alias("type"), a["status_code"].alias("status_code"),
        a["size_bytes"].alias("size_bytes"), F.nullif(a["error"], F.lit("")).alias("error")))
    head = F.to_json(F.struct("url", "depth", "http_status", "status", F.nullif("error", F.lit("")).alias("error")))
    tail = F.to_json(F.struct(assets.alias("assets"), "discovered_at", "seo"), opts)
    return F.concat(head.substr(F.lit(1), F.length(head) - 1),
                    F.lit(',"broken_links":'), F.coalesce(F.to_json("broken_links"), F.lit("null")), F.lit(","),
                    tail.substr(F.lit(2), F.length(tail)))


def report_rows(nested_pages: DataFrame, sites: DataFrame, generated_at: str) -> DataFrame:
    """(site_id, ord, json): a header row (ord -1: root_url as given, depth, generated_at) for each
    site and one row for each of its pages in URL order.

    No row holds more than one page, whatever the site's size.  ``generated_at`` is a parameter (UTC,
    truncated to the second), never the wall clock inside a query.
    """
    at = F.date_format(F.date_trunc("second", F.lit(generated_at).cast("timestamp")), TIMESTAMP_FORMAT)
    header = F.to_json(F.struct("root_url", "depth", at.alias("generated_at")))
    return sites.select("site_id", F.lit(-1).cast("long").alias("ord"), header.alias("json")).unionByName(
        ordered_pages(nested_pages).select("site_id", F.col("ord").cast("long").alias("ord"), _page_json().alias("json")))


def write_report(report: DataFrame, path: str) -> None:
    """The report rows as Parquet files, in ranges of (site, ord): a site's rows lie one after the other."""
    report.repartitionByRange("site_id", "ord").sortWithinPartitions("site_id", "ord").write.mode("overwrite").parquet(path)


INDENT = "  "

# Characters that the reference's JSON writes as escapes inside strings (fixed values).
ESCAPED = {"&": "\\u0026", "<": "\\u003c", ">": "\\u003e", "\u2028": "\\u2028", "\u2029": "\\u2029"}

# A page as its JSON has it: times are text there.
PAGE_TEXT = StructType([StructField(f.name, StringType()) if f.name == "discovered_at" else f for f in schemas.PAGE])


def _escaped(text: Column) -> Column:
    for plain, escape in ESCAPED.items():
        text = F.replace(text, F.lit(plain), F.lit(escape))
    return text


def indented_json(value: Column, dtype: DataType, level: int = 0, kept: tuple[str, ...] = ()) -> Column:
    """A value as indented JSON text, its first line at ``level``; null fields are left out unless ``kept``."""
    line, end = "\n" + INDENT * (level + 1), "\n" + INDENT * level
    if isinstance(dtype, StructType):
        fields = []
        for f in dtype.fields:
            text = F.concat(F.lit(f'"{f.name}": '), indented_json(value[f.name], f.dataType, level + 1, kept))
            fields.append(F.coalesce(text, F.lit(f'"{f.name}": null')) if f.name in kept else text)
        return F.when(value.isNotNull(), F.concat(
            F.lit("{" + line), F.array_join(F.array(*fields), "," + line), F.lit(end + "}")))
    if isinstance(dtype, ArrayType):
        items = F.transform(value, lambda x: indented_json(x, dtype.elementType, level + 1, kept))
        return F.when(F.size(value) == 0, F.lit("[]")).otherwise(
            F.concat(F.lit("[" + line), F.array_join(items, "," + line), F.lit(end + "]")))
    if isinstance(dtype, StringType):
        text = F.to_json(F.array(value))
        return F.when(value.isNotNull(), text.substr(F.lit(2), F.length(text) - 2))
    return value.cast("string")


def document_fragments(report: DataFrame, indent: bool = False) -> DataFrame:
    """(site_id, ord, text): the report rows as the pieces of one JSON document a site.

    A site's texts in order of ord, each followed by ``}``, are its document, compact or indented.  The first
    piece holds the header and the first page, the last one the closing; no piece holds more than a page.
    A site without pages has one piece with an empty list.  Strings are escaped as the reference does.
    """
    header = F.col("json")
    head, between, close, empty = ',"pages":[', ",", "]", ',"pages":[]'
    page = F.col("json")
    if indent:
        given = F.from_json("json", schemas.HEADER)
        header = indented_json(given, schemas.HEADER)
        page = indented_json(F.from_json("json", PAGE_TEXT), PAGE_TEXT, 2, kept=("broken_links",))
        pad = "\n" + INDENT * 2
        head, between, close, empty = f',\n{INDENT}"pages": [{pad}', "," + pad, f"\n{INDENT}]\n", f',\n{INDENT}"pages": []\n'
    pages = report.filter("ord >= 0").select("site_id", "ord", _escaped(page).alias("page"))
    tops = report.filter("ord < 0").select("site_id", _escaped(header).alias("header"))
    # what stands before the header's own brace: the line break of the indented form goes too
    top = F.rtrim(F.regexp_replace("header", r"\s*\}$", ""))
    body = F.col("page").substr(F.lit(1), F.length("page") - 1)
    first = tops.join(pages.filter("ord = 0"), "site_id", "left")
    last = F.lit((1 << 63) - 1)
    opening = first.select("site_id", F.lit(-1).cast("long").alias("ord"),
                           F.when(F.col("page").isNull(), F.concat(top, F.lit(empty))).otherwise(F.concat(top, F.lit(head), body)).alias("text"))
    closing = first.filter(F.col("page").isNotNull()).select("site_id", last.alias("ord"), F.lit(close).alias("text"))
    others = pages.filter("ord > 0").select("site_id", F.col("ord").cast("long"), F.concat(F.lit(between), body).alias("text"))
    return opening.unionByName(others).unionByName(closing)


def write_documents(report: DataFrame, path: str, indent: bool = False) -> None:
    """One JSON document a site: the files of the folder ``site_id=...``, one after the other in order of name.

    The pieces are partitioned by range, so many tasks write a large site's document and none holds it.
    ``}`` ends each written row, so nothing stands between the pieces.
    """
    pieces = document_fragments(report, indent)
    pieces.repartitionByRange("site_id", "ord").sortWithinPartitions("site_id", "ord").select("site_id", "text") \
        .write.mode("overwrite").partitionBy("site_id").option("lineSep", "}").text(path)


def site_document(rows) -> str:
    """One site's JSON document from its (ord, json) rows in order: what a consumer does with one site's lines."""
    rows = iter(rows)
    header = next(rows)[1]
    return header[:-1] + ',"pages":[' + ",".join(json for _, json in rows) + "]}"
