import re

from sitelens.llm import queries, url_filter

RULES = queries.URL_RULES
URLS = ["http://a.example.net/en/1", "http://a.example.net/fr/1", "HTTP://A.Example.COM/de/x?y#z", "https://x.org/fr/9", "https://x.org/FR/9",
        "http://net/x", "http://notnet.com/", "http://h.net", "http://h.net?/x", "mailto:x", None, "", "://", "a://b://c/d", "http://U@H.net:80/p",
        "//example.net/en/", "http://example.com/dé/", "http://example.com/de/" + "a" * 5000]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in re.split("[/?#]", rest)[0])
    path = re.split("[?#]", rest[len(host):])[0]
    fits = [r for r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
    return host, path, max(fits, key=len, default=None)


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(None, URLS[0]), (0, URLS[0])], "page_id long, url string")
    got = url_filter.judge(pages, RULES).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path, rule = brute(URLS[r.page_id or 0])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (RULES[rule] if rule else r.verdict) and r.verdict in ("allow", "block")


def test_regression_learns_a_small_table(spark):
    good = [(f"http://news{k}.site.com/story/{k}", 0) for k in range(60)]
    bad = [(f"http://casino{k}.site.com/bonus/{k}", 1) for k in range(60)]
    new = [(k, f"http://news{k + 100}.site.com/story/{k}") for k in range(20)] + [(100 + k, f"http://casino{k + 100}.site.com/bonus/{k}") for k in range(20)]
    got = url_filter.judge(spark.createDataFrame(new, "page_id long, url string"), RULES,
                           spark.createDataFrame(good + bad, "url string, label int")).collect()
    assert all(r.verdict == ("block" if r.page_id >= 100 else "allow") for r in got)


def test_scores_against_plain_python(spark):
    """The constant array of weights gives the sums that plain Python gives."""
    import math

    from pyspark.sql import functions as F
    weights = [((k * 37) % 101 - 50) / 40 for k in range(url_filter.SLOTS)]
    rows = url_filter.parsed(spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string"), RULES) \
        .select(url_filter.features(F.col("host"), F.col("path")).alias("s")) \
        .select("s", url_filter.score(F.col("s"), weights).alias("p")).collect()
    for r in rows:
        assert len(set(r.s)) == len(r.s) and 0 in r.s
        assert abs(r.p - 1 / (1 + math.exp(-sum(weights[i] for i in r.s)))) < 1e-9


def test_empty_and_native(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(empty, RULES).collect() == []
    lone = url_filter.judge(spark.createDataFrame([(1, "http://q.com/")], "page_id long, url string"), RULES)
    assert lone.first().verdict == "allow"
    assert not re.search("Python|Pandas|Arrow", lone._jdf.queryExecution().executedPlan().toString())
