"""Differential check of start-tag extraction (X1 + X2 input) against Python's html.parser."""

from html.parser import HTMLParser

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sitelens.functions import html as H
from sitelens.functions.memo import memo
from sitelens.operators import extract as X

_val = st.sampled_from(["/a", "/b?x=1&amp;y=2", "http://e.com/p", "#top", "c d", "/é", "&lt;x&gt;"])
_fragment = st.one_of(
    _val.map(lambda v: f'<a href="{v}">t</a>'),
    _val.map(lambda v: f"<A HREF='{v}' class=x>t</A>"),
    _val.map(lambda v: f'<a title="a > b" href="{v}">t</a>'),
    _val.map(lambda v: f'<img src="{v}">'),
    _val.map(lambda v: f'<!-- <a href="{v}"> -->'),
    _val.map(lambda v: f'<script>var s = "<a href={v}>";</script>'),
    _val.map(lambda v: f'<style>a[href="{v}"] {{}}</style>'),
    st.sampled_from(["<p>text</p>", "<div><span>x</span></div>", "<br/>", "plain & text", "<a>no href</a>",
                     '<a href="">empty</a>', "<p it's>x</p>", "<b x'y=1>t</b>"]),
    _val.map(lambda v: f"<a data-x=it's href=\"{v}\">t</a>"),
    _val.map(lambda v: f"<a href='{v}' x'y>t</a>"),
    _val.map(lambda v: f'<a alt=John"s href="{v}">t</a>'),
    _val.map(lambda v: f'<![CDATA[<a href="{v}">'),
    _val.map(lambda v: f'<?php echo <a href="{v}"> ?>'),
    _val.map(lambda v: f'</ <a href="{v}">'),
    _val.map(lambda v: f'<!x <a href="{v}">'),
    _val.map(lambda v: f'<b title="<!--"><a href="{v}">t</a>'),
    _val.map(lambda v: f'<b title="<script>"><a title="</a>" href="{v}">t</a>'),
    _val.map(lambda v: f'<script>"<!-- <a href={v}>"</script ><a href="{v}">t</a>'),
)


class _Collector(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hrefs = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.hrefs += [v for k, v in attrs if k == "href" and v]


@settings(max_examples=40, deadline=None)
@given(parts=st.lists(_fragment, max_size=8))
def test_anchor_hrefs_match_html_parser(spark, parts):
    doc = "<html><body>" + "".join(parts) + "</body></html>"
    c = _Collector()
    c.feed(doc)
    c.close()
    expr = memo(("test-link-refs",), lambda: X.link_refs(H.extract_tags(F.col("d"))))
    got = spark.createDataFrame([(doc,)], "d string").select(expr.alias("r")).first().r
    assert got == c.hrefs


def test_stray_quotes_and_unclosed_tags(spark):
    expr = X.link_refs(H.extract_tags(F.col("d")))
    docs = {"<a data-x=it's href='/one'>x</a><a href='/two'>": ["/one", "/two"],
            "<a href='/four' x'y><a href=/five>": ["/four", "/five"],
            "<a href=/six><a href=/seven": ["/six"], "<a href=/a><script <a href=/b>": ["/a"],
            "<script-x><a href=/c></script-x>": ["/c"], '<a href="/d><a href=/e>': []}
    for d, hrefs in docs.items():
        assert spark.createDataFrame([(d,)], "d string").select(expr.alias("r")).first().r == hrefs, d


def test_unclosed_openings_are_read_once(spark):
    """Bodies that only open tags: linear, so a few MB take seconds."""
    import time
    rows = [(x * (3_000_000 // len(x)),) for x in ("<a ", "<script ", "<title ", "<h1 ", "<channel>", '<a href="', "<!--")]
    df = spark.createDataFrame([("http://h.com/", r[0]) for r in rows], "url string, body string").repartition(2)
    began = time.time()
    out = X.extract_pages(df, ctype_col=None).select("links", "seo").collect()
    assert len(out) == len(rows) and all(r.links == [] for r in out)
    assert time.time() - began < 90


def test_comment_ends_and_bogus_comments(spark):
    expr = X.link_refs(H.extract_tags(F.col("d")))
    docs = {'<p><!--><a href="/one">x</a><a href="/two">': ["/one", "/two"], '<!---><a href="/one">': ["/one"],
            '<!-- x --!><a href="/one">x</a><!-- y -->': ["/one"], '<![CDATA[<a href="/no">x]]><a href="/yes">': ["/yes"],
            "<?php echo '<a href=\"/no\">' ?><a href=/yes>": ["/yes"], "</ a href=x><a href=/yes>": ["/yes"], "</><a href=/yes>": ["/yes"],
            "<!-- never closed <a href=/no>": [], "<!doctype html><a href=/yes>": ["/yes"], "a < b <a href=/yes>": ["/yes"],
            "<plaintext><a href=/no>": [], "<style>x</stylex><a href=/no></style foo=bar><a href=/yes>": ["/yes"],
            "<script>1</script/><a href=/yes>": ["/yes"], "<textarea></textarea\n><a href=/yes>": ["/yes"], "<a href=/x": []}
    for d, hrefs in docs.items():
        assert spark.createDataFrame([(d,)], "d string").select(expr.alias("r")).first().r == hrefs, d


def test_elements_that_the_tree_does_not_make(spark):
    """In a select only scripts stay; an image in svg is no img, unless the svg has ended."""
    expr = F.transform(H.extract_tags(F.col("d")), lambda t: F.concat(t["name"], F.lit(" "), F.array_join(t["vals"], " ")))
    docs = {"<a href=1><select><option><a href=2><img src=3><script src=4></script></select><a href=5>": ["a 1", "script 4", "a 5"],
            "<select><a href=1><input><a href=2>": ["a 2"], "<select><a href=1><select><a href=2>": ["a 2"],
            "<svg><image href=1></image><a href=2></svg><image src=3>": ["a 2", "img 3"], "<svg/><image src=1>": ["img 1"],
            "<svg><g><svg><image src=1></svg><image src=2></svg><image src=3>": ["img 3"], "<svg><img src=1><image src=2>": ["img 1", "img 2"],
            "<math><mi><image src=1></math>": [], "</select><a href=1>": ["a 1"], "<selection><a href=1>": ["a 1"]}
    for d, tags in docs.items():
        assert spark.createDataFrame([(d,)], "d string").select(expr.alias("r")).first().r == tags, d


def test_titles_and_headings_beside_markup(spark):
    rows = [("<title>a<b></title x><h1 id=x>t", "a<b>", True), ("<!-- <title>no</title> --><title>y", "y", False),
            ("<p title='<title>'><title></title>", "", False), ("<h1></h1><b x='<h1>y'>", "", False), ("<h1><!--c--></h1>", "", True)]
    df = spark.createDataFrame([(f"http://h.com/{k}", r[0]) for k, r in enumerate(rows)], "url string, body string")
    got = X.extract_pages(df, ctype_col=None).orderBy("url").select("seo.title", "seo.has_h1").collect()
    assert [tuple(r) for r in got] == [r[1:] for r in rows]


def test_a_tag_of_very_many_attributes(spark):
    body = "<a " + "x=y " * 200_000 + "href=/end>" + "<b c='d'>" * 100_000 + "<a href=/last>"
    assert spark.createDataFrame([(body,)], "d string").select(X.link_refs(H.extract_tags(F.col("d"))).alias("r")).first().r == ["/end", "/last"]
