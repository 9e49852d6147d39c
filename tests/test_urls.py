from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sitelens.functions import urls as U

NORMALIZE = [
    ("HTTP://Example.COM:80/a/b/?b=2&a=x y&a=1&bad=%zz&k#frag", "http://example.com/a/b?a=x+y&a=1&b=2&k="),
    ("https://example.com:443/", "https://example.com"),
    ("https://example.com:8443/x//", "https://example.com:8443/x"),
    ("http://example.com:443/x", "http://example.com:443/x"),
    ("http://example.com/für the,", "http://example.com/f%C3%BCr%20the,"),
    ("http://example.com/a(b)/", "http://example.com/a%28b%29"),
    ("http://example.com/a(b)", "http://example.com/a(b)"),
    ("http://example.com/x?", "http://example.com/x?"),
    ("http://a.com/?;", "http://a.com"),
    ("mailto:Foo@Bar.com", "mailto:Foo@Bar.com"),
    ("http://ex ample.com/", None),
    ("http://a.com/%zz", None),
    ("http://a.com:8x/", None),
    ("http://u:p@h.com/", "http://u:p@h.com"),
    ("", ""),
    ("/", ""),
    ("a:b:c", "a:b:c"),
    ("1a:b", None),
    ("http://a.com/x?q=a*b~c", "http://a.com/x?q=a%2Ab~c"),
    ("http://a.com/\x07", None),
    ("http://a.com/p#%zz", None),
    ("http://site.example/p/0", "http://site.example/p/0"),
]


def _eval(spark, exprs, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*[e.alias(f"c{i}") for i, e in enumerate(exprs)]).collect()]


def test_normalize(spark):
    got = _eval(spark, [U.normalize_url("u")], [(raw,) for raw, _ in NORMALIZE], "u string")
    assert [(raw, g[0]) for (raw, _), g in zip(NORMALIZE, got)] == NORMALIZE


RESOLVE = [
    ("/x", "http://site.example/x"), ("x.html", "http://site.example/dir/x.html"),
    ("#top", "http://site.example/dir/page"), ("../a/./b/../c", "http://site.example/a/c"),
    ("//other.org/p#f", "http://other.org/p"), ("https://EXT.org/Q?b=1&a=2", "https://EXT.org/Q?b=1&a=2"),
    ("HTTPS://EXT.org/Q", "https://EXT.org/Q"),
    ("?q=1", "http://site.example/dir/page?q=1"), ("mailto:a@b.c", "mailto:a@b.c"),
    ("javascript:void(0)", "javascript:void(0)"), ("", None), ("/für", "http://site.example/f%C3%BCr"),
    ("/the,", "http://site.example/the,"), (".", "http://site.example/dir/"), ("..", "http://site.example/"),
    ("http://a b/", None), ("/a b", "http://site.example/a%20b"), ("/a/", "http://site.example/a/"),
    ("/a%2Fb", "http://site.example/a%2Fb"), ("/%zz", None),
]


def test_resolve(spark):
    got = _eval(spark, [U.resolve_url(F.col("b"), F.col("r"))], [("http://site.example/dir/page", ref) for ref, _ in RESOLVE],
                "b string, r string")
    assert [(ref, g[0]) for (ref, _), g in zip(RESOLVE, got)] == RESOLVE


def test_resolve_keeps_base_query_for_fragment(spark):
    got = _eval(spark, [U.resolve_url(F.col("b"), F.col("r"))], [("http://h.com/p?a=1", "#x"), ("http://h.com/p?a=1", "q")],
                "b string, r string")
    assert [g[0] for g in got] == ["http://h.com/p?a=1", "http://h.com/q"]


def test_same_domain_scheme_default_special_error(spark):
    rows = [("http://Example.com/a", "https://Example.com/b"), ("http://example.com", "http://sub.example.com"),
            ("http://example.com", "http://example.com:8080/"), ("http://example.com", "::bad")]
    got = _eval(spark, [U.same_domain(F.col("a"), F.col("b"))], rows, "a string, b string")
    assert [g[0] for g in got] == [True, False, False, False]
    got = _eval(spark, [U.with_default_scheme(F.col("u"))],
                [("example.com/x",), ("/x",), ("//h/x",), ("https://h/x",)], "u string")
    assert [g[0] for g in got] == ["http://example.com/x", "http:///x", "http://h/x", "https://h/x"]
    got = _eval(spark, [U.is_special_url(F.col("u"))],
                [("#a",), ("javascript:x",), ("mailto:a",), ("tel:1",), ("data:x",), (" #a",), ("JavaScript:x",)],
                "u string")
    assert [g[0] for g in got] == [True, True, True, True, True, False, False]
    got = _eval(spark, [U.url_error(F.col("u")), U.normalize_or_keep(F.col("u"))], [("http://a b/",), ("http://a/",)],
                "u string")
    assert got == [("invalid URL: http://a b/", "http://a b/"), (None, "http://a")]


def _TWICE():
    from sitelens.functions.memo import memo
    return memo(("test-twice",), lambda: U.normalize_url(U.normalize_url(F.col("u"))))


_seg = st.text(alphabet="abcXYZ019-_.~", min_size=1, max_size=6).filter(lambda s: s not in (".", ".."))


@settings(max_examples=40, deadline=None)
@given(scheme=st.sampled_from(["http", "HTTP", "https"]), host=st.text(alphabet="abcXY", min_size=1, max_size=5),
       segs=st.lists(_seg, max_size=4), slash=st.booleans(), port=st.sampled_from(["", "80", "443", "8080"]),
       query=st.lists(st.tuples(st.text(alphabet="abz", min_size=1, max_size=2),
                                st.text(alphabet="xy 1", max_size=3)), max_size=3))
def test_normalize_model(spark, scheme, host, segs, slash, port, query):
    """Differential check against a small Python model of the canonical form for simple URLs."""
    from urllib.parse import quote_plus
    path = "/" + "/".join(segs) + ("/" if slash else "")
    qs = "&".join(f"{k}={v}" for k, v in query)
    raw = f"{scheme}://{host}" + (f":{port}" if port else "") + path + (f"?{qs}" if qs else "")
    default = (scheme.lower(), port) in (("http", "80"), ("https", "443"))
    want_port = f":{port}" if port and not default else ""
    want_path = path.rstrip("/")
    pairs = sorted(enumerate(query), key=lambda p: (p[1][0], p[0]))
    want_q = "&".join(f"{quote_plus(k)}={quote_plus(v)}" for _, (k, v) in pairs)
    want = f"{scheme.lower()}://{host.lower()}{want_port}{want_path}" + (f"?{want_q}" if want_q else "")
    got = _eval(spark, [U.normalize_url("u"), _TWICE()], [(raw,)], "u string")[0]
    assert got[0] == want
    assert got[1] == got[0]  # idempotent
