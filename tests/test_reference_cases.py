"""Ports of the reference's end-to-end cases (FIXTURES.md section A), all sites in one audit run."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from sitelens import schemas
from sitelens.operators import report as R
from sitelens.operators import requests as Q
from sitelens.plans.audit import report_of, run_audit
from tests.helpers import T0, cap, html

E = "http://example.com"
P = "<!DOCTYPE html><html><body>Some words</body></html>"


def chain(site, pages):
    return [cap(E + path, body=body, site=site) for path, body in pages.items()]


def build_rows():
    rows = []
    # A1: ok page with SEO, one external link, one image
    rows += [cap(E, site="a1", body=html("Test Page", '<h1>Header</h1><a href="https://external.com/page">x</a>'
                                        '<img src="/logo.png">', '<meta name="description" content="Desc">')),
             cap("https://external.com/page", kind="link", method="HEAD", status=200, ctype=None, site="a1"),
             cap(E + "/logo.png", kind="asset", method="HEAD", status=200, ctype="image/png", length=100, site="a1")]
    # A2: every attempt fails with a transport error
    rows += [cap(E, site="a2", status=None, ctype=None, error="network error: connection refused", attempt=a)
             for a in (0, 1)]
    # A3: 404 without headers
    rows += [cap(E, site="a3", status=404, ctype=None, body="Not Found")]
    # A4 / A5: SEO with entities / SEO missing
    rows += [cap(E, site="a4", body=html("Nuts &amp; Bolts", "<h1>Welcome</h1>",
                                         '<meta name="Description" content="Tools &amp; parts">'))]
    rows += [cap(E, site="a5", body="<html><body><p>One line</p></body></html>")]
    # 500 then 200 (retries 2); A7: 429 then 200 with a link and an image
    rows += [cap(E, site="a6", status=500, ctype="text/html", body="err", attempt=0),
             cap(E, site="a6", body=html("OK"), attempt=1, ts_ms=100)]
    rows += [cap(E, site="a7", status=429, ctype=None, attempt=0),
             cap(E, site="a7", body=html("OK", '<a href="/page2">2</a><img src="/image.png">'), attempt=1, ts_ms=100),
             cap(E + "/image.png", kind="asset", method="HEAD", status=200, ctype=None, length=10, site="a7")]
    # The same image three times (+ once inside an unclosed script)
    img = '<img src="/static/logo.png">'
    rows += [cap(E, site="a8", body=html("A", img * 3 + "<script>" + img)),
             cap(E + "/static/logo.png", kind="asset", method="HEAD", status=200, ctype=None, length=12345, site="a8")]
    # Full report at depth 0: one broken link, one asset
    rows += [cap(E, site="a9", body=html("Test Page", '<h1>Header</h1><a href="/missing">m</a><img src="/static/logo.png">',
                                         '<meta name="description" content="Test description">')),
             cap(E + "/missing", kind="link", method="HEAD", status=404, ctype=None, site="a9"),
             cap(E + "/static/logo.png", kind="asset", method="HEAD", status=200, ctype=None, length=12345, site="a9")]
    # A10: depth 1 / 2 / 3
    two = '<a href="/page1">1</a><a href="/page2">2</a>'
    sub = '<p>Subpage</p><a href="/page3">3</a>'
    rows += chain("d1", {"": html("r", two), "/page1": html("s", sub), "/page2": html("s", sub)})
    rows += chain("d2", {"": html("r", two), "/page1": html("s", sub), "/page2": html("s", sub), "/page3": P})
    rows += chain("d3", {"": html("r", '<a href="/level1">1</a>'), "/level1": html("1", '<a href="/level2">2</a>'),
                         "/level2": html("2", '<a href="/level3">3</a>'), "/level3": P})
    # 2 internal + 3 external links, depth 2
    ext = ["https://partner.test/offer", "http://elsewhere.test", "https://static.partner.test/lib.js"]
    rows += chain("a11", {"": html("r", '<a href="/page1">1</a><a href="/page2">2</a>'
                                   + "".join(f'<a href="{u}">e</a>' for u in ext)), "/page1": P, "/page2": P})
    rows += [cap(u, kind="link", method="HEAD", status=200, ctype=None, site="a11") for u in ext]
    # Seven anchors over three URLs, depth 2
    seven = "".join(f'<a href="/page{i}">x</a>' for i in (1, 2, 1, 3, 1, 2, 1))
    rows += chain("a12", {"": html("r", seven), "/page1": P, "/page2": P, "/page3": P})
    # The slow page is not captured before the cut-off
    rows += [cap(E, site="a13", body=html("r", '<a href="/slow">s</a><a href="/fast">f</a>')),
             cap(E + "/fast", site="a13", body=P, ts_ms=50), cap(E + "/slow", site="a13", body=P, ts_ms=500)]
    # Link HEAD/GET fallbacks
    links = {"/l405ok": [("HEAD", 405, None), ("GET", 200, None)], "/l501ok": [("HEAD", 501, None), ("GET", 200, None)],
             "/l405nf": [("HEAD", 405, None), ("GET", 404, None)], "/lhead": [("HEAD", 200, None)],
             "/lerr": [("HEAD", None, "connection reset"), ("GET", 200, None)]}
    rows += [cap(E, site="a15", body=html("r", "".join(f'<a href="{p}">x</a>' for p in links)))]
    rows += [cap(E + p, kind="link", method=m, status=s, ctype=None, error=e, site="a15")
             for p, rs in links.items() for m, s, e in rs]
    # Asset HEAD/GET fallbacks with sizes
    assets = {"/a1.png": [("HEAD", 405, None, -1, None), ("GET", 200, None, 1024, None)],
              "/a2.png": [("HEAD", 501, None, -1, None), ("GET", 200, None, 2048, None)],
              "/a3.png": [("HEAD", 405, None, -1, None), ("GET", 404, None, -1, None)],
              "/a4.png": [("HEAD", 200, None, 4096, None)],
              "/a5.png": [("HEAD", None, "timeout", None, None), ("GET", 200, None, -1, 5120)]}
    rows += [cap(E, site="a16", body=html("r", "".join(f'<img src="{p}">' for p in assets)))]
    rows += [cap(E + p, kind="asset", method=m, status=s, ctype=None, error=e, length=ln, body_bytes=bb, site="a16")
             for p, rs in assets.items() for m, s, e, ln, bb in rs]
    return rows


CFG = {"a1": 1, "a2": 1, "a3": 1, "a4": 1, "a5": 1, "a6": 1, "a7": 1, "a8": 1, "a9": 0, "d1": 1, "d2": 2, "d3": 3,
       "a11": 2, "a12": 2, "a13": 2, "a15": 1, "a16": 1}
RETRIES = {"a6": 2, "a7": 2}
DEADLINE = {"a13": T0 + dt.timedelta(milliseconds=100)}


@pytest.fixture(scope="module")
def audit(spark):
    caps = spark.createDataFrame(build_rows(), schemas.CAPTURES)
    sites = spark.createDataFrame([(s, E, d, RETRIES.get(s, 1), 0, 0, "", DEADLINE.get(s)) for s, d in CFG.items()],
                                  schemas.SITES)
    a = run_audit(caps, sites)
    pages = {}
    for r in a.pages.collect():
        pages.setdefault(r.site_id, []).append(r)
    rows = {}
    for r in report_of(a, sites, "2024-01-02 00:00:00").orderBy("site_id", "ord").collect():
        rows.setdefault(r.site_id, []).append((r.ord, r.json))
    js = {site: json.loads(R.site_document(own)) for site, own in rows.items()}
    return {"a": a, "pages": pages, "json": js}


def one(audit, site):
    ps = audit["pages"][site]
    assert len(ps) == 1
    return ps[0]


def test_a1_ok_page(audit):
    p = one(audit, "a1")
    assert (p.url, p.http_status, p.status, p.error) == (E, 200, "ok", "")
    assert p.seo.asDict() == {"has_title": True, "title": "Test Page", "has_description": True,
                              "description": "Desc", "has_h1": True}


def test_a2_a3_errors(audit):
    p = one(audit, "a2")
    assert (p.http_status, p.status, p.error) == (0, "error", "network error: connection refused")
    p = one(audit, "a3")
    assert (p.http_status, p.status, p.error) == (404, "error", "")
    assert audit["json"]["a3"]["pages"][0]["broken_links"] is None
    assert "discovered_at" in audit["json"]["a2"]["pages"][0]


def test_a4_a5_seo(audit):
    assert one(audit, "a4").seo.asDict() == {"has_title": True, "title": "Nuts & Bolts", "has_description": True,
                                             "description": "Tools & parts", "has_h1": True}
    assert one(audit, "a5").seo.asDict() == {"has_title": False, "title": "", "has_description": False,
                                             "description": "", "has_h1": False}


def test_a6_a7_retries(audit):
    assert (one(audit, "a6").http_status, one(audit, "a6").status) == (200, "ok")
    assert (one(audit, "a7").http_status, one(audit, "a7").status) == (200, "ok")
    assets = audit["json"]["a7"]["pages"][0]["assets"]
    assert [(x["url"], x["status_code"]) for x in assets] == [(E + "/image.png", 200)]


def test_a8_asset_dedupe(audit):
    assets = audit["json"]["a8"]["pages"][0]["assets"]
    assert [(x["url"], x["type"], x["status_code"], x["size_bytes"]) for x in assets] == [(E + "/static/logo.png", "image", 200, 12345)]


def test_a9_full_report(audit):
    doc = audit["json"]["a9"]
    assert doc["root_url"] == E and doc["depth"] == 0 and doc["generated_at"] == "2024-01-02T00:00:00Z"
    (page,) = doc["pages"]
    assert page["broken_links"] == [{"url": E + "/missing", "status_code": 404, "error": ""}]
    assert page["assets"] == [{"url": E + "/static/logo.png", "type": "image", "status_code": 200, "size_bytes": 12345}]
    assert "error" not in page and page["seo"]["title"] == "Test Page"


def test_a10_depth_limit(audit):
    assert len(audit["pages"]["d1"]) == 1
    assert len(audit["pages"]["d2"]) == 3
    assert sorted((p.url, p.depth) for p in audit["pages"]["d3"]) == [(E, 0), (E + "/level1", 1), (E + "/level2", 2)]


def test_a11_external_not_crawled(audit):
    assert sorted(p.url for p in audit["pages"]["a11"]) == [E, E + "/page1", E + "/page2"]
    checked = {r.norm_url for r in audit["a"].link_status.filter(F.col("site_id") == "a11").collect()}
    assert checked == {"https://partner.test/offer", "http://elsewhere.test", "https://static.partner.test/lib.js"}


def test_a12_duplicate_links(audit):
    assert sorted(p.url for p in audit["pages"]["a12"]) == [E, E + "/page1", E + "/page2", E + "/page3"]


def test_a13_cut_off(audit):
    got = {p.url: (p.status, p.error) for p in audit["pages"]["a13"]}
    assert got == {E: ("ok", ""), E + "/fast": ("ok", ""), E + "/slow": ("error", "context canceled")}


def test_a15_link_probes(audit):
    page = audit["json"]["a15"]["pages"][0]
    assert [(b["url"], b["status_code"], b["error"]) for b in page["broken_links"]] == [(E + "/l405nf", 404, "")]


def test_a16_asset_probes(audit):
    got = {x["url"]: (x["status_code"], x["size_bytes"], x.get("error", "")) for x in audit["json"]["a16"]["pages"][0]["assets"]}
    assert got == {E + "/a1.png": (200, 1024, ""), E + "/a2.png": (200, 2048, ""), E + "/a3.png": (404, 0, "HTTP 404"),
                   E + "/a4.png": (200, 4096, ""), E + "/a5.png": (200, 5120, "")}


def test_a17_a18_request_log(spark):
    rows = [("d", f"/p{i}", "GET", T0 + dt.timedelta(milliseconds=100 * i), "Bot/1.0") for i in range(5)]
    rows += [("r", f"/p{i}", "HEAD" if i % 2 else "GET", T0 + dt.timedelta(milliseconds=50 * i), None) for i in range(6)]
    log = spark.createDataFrame(rows, "site_id string, url string, method string, fetched_at timestamp, user_agent string")
    st = {r.site_id: r for r in Q.request_intervals(log).collect()}
    assert st["d"].min_interval_ms >= 90 and st["d"].span_ms >= 400 and st["d"].n == 5
    assert st["r"].avg_interval_ms >= 25 and st["r"].min_interval_ms >= 30
    cfg = spark.createDataFrame([("d", "Bot/1.0"), ("r", "")], "site_id string, user_agent string")
    ua = {r.site_id: r for r in Q.user_agent_audit(log, cfg).collect()}
    assert ua["d"].n_mismatch == 0 and ua["d"].n_agents == 1
    assert ua["r"].n_mismatch == 0 and ua["r"].n_missing == 6
    sites = spark.createDataFrame([("d", 0, 100), ("r", 20, 0)], "site_id string, rps int, delay_ms bigint")
    plan = {(r.site_id, r.url): r.offset_ms for r in Q.pacing_plan(log.withColumn("seq", F.monotonically_increasing_id()),
                                                                  sites).collect()}
    assert plan[("d", "/p4")] == 400.0 and plan[("r", "/p5")] == 250.0


def test_a13_cut_off_drop_option(spark):
    rows = [r for r in build_rows() if r[0] == "a13"]
    caps = spark.createDataFrame(rows, schemas.CAPTURES)
    sites = spark.createDataFrame([("a13", E, 2, 1, 0, 0, "", DEADLINE["a13"])], schemas.SITES)
    got = {r.url: r.error for r in run_audit(caps, sites, missing="drop").pages.collect()}
    assert got == {E: "", E + "/fast": ""}
