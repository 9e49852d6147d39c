"""S4 sink and the table-level extraction operators."""

import glob
import json

from pyspark.sql import functions as F

from sitelens import schemas
from sitelens.operators import extract as X
from sitelens.operators import report as R
from sitelens.plans.audit import audit
from sitelens.sources import fixtures as FX
from sitelens.streaming.jobs import scratch
from tests.helpers import cap, html


def test_write_report_rows(spark):
    rows = [cap("http://example.com", site="w1", body=html("T", '<a href="/x">x</a>')),
            cap("http://example.com/x", kind="link", method="HEAD", status=500, ctype=None, site="w1")]
    caps = spark.createDataFrame(rows, schemas.CAPTURES)
    sites = spark.createDataFrame([("w1", "http://example.com", 1, 1, 0, 0, "", None), ("w2", "http://none.com", 1, 1, 0, 0, "", None)],
                                  schemas.SITES)
    _, report = audit(caps, sites, "2024-01-02 00:00:00")
    out = scratch(spark, "t-report")
    R.write_report(report, out)
    back = spark.read.parquet(out).orderBy("site_id", "ord").collect()
    docs = {s: json.loads(R.site_document((r.ord, r.json) for r in back if r.site_id == s)) for s in ("w1", "w2")}
    assert docs["w1"]["root_url"] == "http://example.com" and docs["w2"]["pages"] == []
    assert docs["w1"]["pages"][0]["broken_links"] == [{"url": "http://example.com/x", "status_code": 500, "error": ""}]


def test_large_site_keeps_every_page_in_order(spark):
    """No switch by size: 200,000 pages of one site, each with its place."""
    n = 200_000
    pages = spark.range(n).select(
        F.lit("big").alias("site_id"), F.concat(F.lit("http://b/"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("url"),
        F.lit(0).alias("depth"), F.lit(200).alias("http_status"), F.lit("ok").alias("status"), F.lit("").alias("error"),
        F.array().cast("array<struct<url:string,status_code:int,error:string>>").alias("broken_links"),
        F.array().cast("array<struct<url:string,type:string,status_code:int,size_bytes:bigint,error:string>>").alias("assets"),
        F.lit(None).cast("timestamp").alias("discovered_at"), F.struct(F.lit(False).alias("has_title")).alias("seo")) \
        .withColumn("page_norm", F.col("url"))
    sites = spark.createDataFrame([("big", "http://b/", 3)], "site_id string, root_url string, depth int")
    rows = R.report_rows(pages, sites, "2024-01-02 00:00:00")
    got = rows.filter("ord >= 0").select("ord", F.substring(F.get_json_object("json", "$.url"), 10, 7).cast("long").alias("u"))
    assert got.filter("ord = u").count() == n and rows.count() == n + 1


def _documents(path):
    """Each site's document: its files in order of name, joined."""
    out = {}
    for folder in sorted(glob.glob(path.removeprefix("file:") + "/site_id=*")):
        out[folder.rsplit("=", 1)[1]] = "".join(open(f, newline="").read() for f in sorted(glob.glob(folder + "/part-*")))
    return out


def test_documents_compact_and_indented(spark):
    rows = [cap("http://example.com", site="w1", body=html("A <b> & \"c\"", '<a href="/x?a=1&b=2">x</a><img src="/i.png">')),
            cap("http://example.com/x?a=1&b=2", kind="link", method="HEAD", status=500, ctype=None, site="w1")]
    caps = spark.createDataFrame(rows, schemas.CAPTURES)
    sites = spark.createDataFrame([("w1", "http://example.com", 1, 1, 0, 0, "", None), ("w2", "http://none.com", 1, 1, 0, 0, "", None)],
                                  schemas.SITES)
    _, report = audit(caps, sites, "2024-01-02 00:00:00")
    rows = report.orderBy("site_id", "ord").collect()
    for indent in (False, True):
        out = scratch(spark, "t-documents")
        R.write_documents(report, out, indent=indent)
        got = _documents(out)
        assert set(got) == {"w1", "w2"}
        for site, text in got.items():
            value = json.loads(R.site_document((r.ord, r.json) for r in rows if r.site_id == site))
            form = {"indent": 2} if indent else {"separators": (",", ":")}
            expected = json.dumps(value, ensure_ascii=False, **form)
            for plain, escape in R.ESCAPED.items():
                expected = expected.replace(plain, escape)
            assert text == expected


def test_a_large_site_is_one_document_from_many_tasks(spark):
    n = 20_000
    page = F.format_string('{"url":"http://b/%07d","depth":0,"http_status":0,"status":"error","broken_links":null,"assets":[],'
                           '"seo":{"has_title":false}}', "id")
    report = spark.range(n).select(F.lit("big").alias("site_id"), F.col("id").alias("ord"), page.alias("json")).unionByName(
        spark.createDataFrame([("big", -1, '{"root_url":"http://b/","depth":3,"generated_at":"x"}')], "site_id string, ord long, json string"))
    for indent in (False, True):
        out = scratch(spark, "t-large")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # as if the pieces were many
        R.write_documents(report, out, indent=indent)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert len(glob.glob(out.removeprefix("file:") + "/site_id=big/part-*")) > 1
        value = json.loads(_documents(out)["big"])
        assert [p["url"] for p in value["pages"]] == [f"http://b/{k:07d}" for k in range(n)]
        assert value["pages"][0]["broken_links"] is None and value["depth"] == 3


def test_table_level_extraction(spark):
    df = spark.createDataFrame([(1, "http://h.com/a/", '<a href="b">b</a><img src="/i.gif"><title>x</title>', "text/html")],
                               "id int, url string, body string, content_type string")
    assert [(r.pos, r.link, r.link_norm) for r in X.extract_links(df, ["id"]).collect()] == [(0, "http://h.com/b", "http://h.com/b")]
    assert [(r.asset_url, r.type) for r in X.extract_assets(df, ["id"]).collect()] == [("http://h.com/i.gif", "image")]
    assert X.extract_seo(df, ["id"]).select("title").first().title == "x"


def test_read_captures_json_and_clean_text(spark):
    from sitelens.functions import html as H
    from sitelens.sources.captures import read_captures, route_by_media_type
    from tests.helpers import captures
    out = scratch(spark, "t-caps")
    captures(spark, [cap("http://h.com/", body="<title>x</title>"), cap("http://h.com/f", ctype="application/xml"),
                     cap("http://h.com/i", kind="asset", method="HEAD", ctype=None)]).write.json(out)
    caps = read_captures(spark, out, "json")
    assert caps.schema == schemas.CAPTURES and caps.count() == 3
    html_, xml, other = route_by_media_type(caps)
    assert (html_.count(), xml.count(), other.count()) == (1, 1, 1)
    got = spark.createDataFrame([("  A &amp; B\t",)], "t string").select(H.clean_text(F.col("t")).alias("c")).first().c
    assert got == "A & B"


def test_pages_of_one_row_group_are_extracted_by_many_tasks(spark, tmp_path):
    """One file of one row group is one scan task; the pages meet the extraction in more."""
    body = F.concat(*[F.sha2(F.concat(F.col("id"), F.lit(f"/{k}")), 512) for k in range(8)])
    spark.range(9000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.example/"), F.col("id")).alias("url"), body.alias("html")) \
        .coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    pages = FX.web_pages(spark, str(tmp_path)).select("page_id", F.upper("html").alias("html"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")     # less than the pages, more than their ids
    try:
        pages.withColumn("task", F.spark_partition_id()).write.parquet(f"{tmp_path}/out")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    tasks = spark.read.parquet(f"{tmp_path}/out").groupBy("task").count().collect()
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 9000
