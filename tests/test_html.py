import html as pyhtml

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sitelens.functions import html as H
from sitelens.operators import extract as X


def _one(spark, exprs, row, schema):
    df = spark.createDataFrame([row], schema)
    return tuple(df.select(*[e.alias(f"c{i}") for i, e in enumerate(exprs)]).collect()[0])


_tok = st.sampled_from(["&amp;", "&lt;", "&gt;", "&quot;", "&#39;", "&#x27;", "&copy", "&notit;", "&ampx", "&#128;",
                        "&#x1F600;", "&#0;", "&fjlig;", "&bogus;", "&", ";", "a", " ", "é", "&#65;"])


@settings(max_examples=40, deadline=None)
@given(parts=st.lists(_tok, max_size=8))
def test_unescape_matches_html5_decoder(spark, parts):
    s = "".join(parts)
    from sitelens.functions.memo import memo
    got = _one(spark, [memo(("test-unescape",), lambda: H.html_unescape(F.col("t")))], (s,), "t string")[0]
    assert got == pyhtml.unescape(s)


def test_unescape_quirks(spark):
    got = _one(spark, [H.html_unescape(F.col("t")), H.html_unescape(F.col("t"), attribute=True)],
               ("&#5 &amp=x &ampx",), "t string")
    assert got == ("&#5 &=x &x", "&#5 &amp=x &ampx")


DOC = """<!DOCTYPE html><html><head><title> T1 &amp;amp; co </title><meta name="Description" content="D1 &amp; x">
<link rel="icon" href="/f.ico"><link rel="stylesheet" href="/s.css"><link rel="Stylesheet" href="/no.css"></head>
<body><h1></h1><h1>H</h1><!-- <a href="/ghost">no</a> --><a href="/p/1">l</a><A HREF='/p/2#frag'>r</A>
<a href=https://ext.org/x/1/>e</a><a href="#top">t</a><a href="/p/1">dup</a><a href="mailto:x@y.z">m</a>
<img src="/img.png"><img src="/img.png"><IMAGE srcset=" /a.webp 1x, /b.webp 2x" style="background:url('/bg.gif') url(&quot;/c.png&quot;)">
<img src="data:image/png;base64,AAAA"><img src="#x"><script src="/app.js">var t="<a href=/ghost2>";</script>
<textarea><a href="/ghost3"></textarea><script>unclosed <img src=/never.png>"""


def test_extract_page(spark):
    df = spark.createDataFrame([("http://Site.com/dir/", DOC, "text/html; charset=utf-8")], "url string, body string, ct string")
    r = X.extract_pages(df, ctype_col="ct").collect()[0]
    assert r.links == ["http://site.com/p/1", "http://site.com/p/2", "https://ext.org/x/1/", "http://site.com/dir",
                       "mailto:x@y.z"]
    assert [(a.url, a.type) for a in r.assets] == [
        ("http://site.com/s.css", "style"), ("http://site.com/img.png", "image"), ("http://site.com/a.webp", "image"),
        ("http://site.com/bg.gif", "image"), ("http://site.com/c.png", "image"), ("http://site.com/app.js", "script")]
    assert r.seo.asDict() == {"has_title": True, "title": "T1 & co", "has_description": True,
                              "description": "D1 & x", "has_h1": True}


def test_seo_missing_and_media(spark):
    rows = [("http://a.com/", "<html><body><p>x</p></body></html>", "text/html"),
            ("http://a.com/f", "<rss><channel><title> F &amp; G </title></channel></rss>", "application/rss+xml"),
            ("http://a.com/g", "<a href='/x'>", "application/pdf"), ("http://a.com/h", "<h1>\n</h1>", None)]
    out = X.extract_pages(spark.createDataFrame(rows, "url string, body string, ct string"), ctype_col="ct") \
        .orderBy("url").collect()
    assert out[0].seo.asDict() == {"has_title": False, "title": "", "has_description": False, "description": "",
                                   "has_h1": False}
    assert out[1].media == "xml" and out[1].seo.title == "F & G" and out[1].links == []
    assert out[2].media == "other" and out[2].links == []
    assert out[3].media == "other"


def test_asset_type_and_helpers(spark):
    got = _one(spark, [H.asset_type(F.lit(u)) for u in ["http://x/a.JSON", "http://x/app.js?x=.png", "http://x/s.css",
                                                       "http://x/noext", "data:image/svg"]], (1,), "i int")
    assert got == ("script", "image", "style", "image", "image")
    got = _one(spark, [H.srcset_first(F.col("v")), H.css_urls(F.col("w"))],
               ("a.jpg 1x, b.jpg 2x", "url( 'x.png' ) url() url(\"y\")"), "v string, w string")
    assert got == ("a.jpg", ["x.png", "y"])


def test_cap_body_bytes(spark):
    got = _one(spark, [H.cap_text_bytes(F.col("b"), 3), H.cap_text_bytes(F.col("b"), 10)], ("abé",), "b string")
    assert got[0] == "ab"
    assert got[1] == "abé"
