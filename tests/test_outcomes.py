"""One outcome per URL, unresolved probes, and what a deadline cuts off."""

import datetime as dt

from sitelens import schemas
from sitelens.operators import outcomes as O
from sitelens.plans.audit import run_audit
from tests.helpers import T0, cap, captures, html, sites


def at(ms):
    return T0 + dt.timedelta(milliseconds=ms)


def test_repeated_captures_of_one_url_count_once(spark):
    """Two spellings and an exact repeat, all attempt 0: one page, one link row, one broken link."""
    body = html("T", '<a href="/x">x</a>')
    caps = captures(spark, [cap("http://e.com", body=body, ts_ms=5), cap("http://e.com/", body=html("later"), ts_ms=9),
                            cap("http://e.com", body=body, ts_ms=5), cap("http://e.com/x", kind="link", method="HEAD", status=404)])
    a = run_audit(caps, sites(spark, "http://e.com"))
    assert (a.pages.count(), a.links.count(), a.broken.count()) == (1, 1, 1)
    assert a.pages.first().seo.title == "T"


def test_the_first_capture_of_an_attempt_decides(spark):
    rows = [cap("http://e.com/a", status=503, ts_ms=1), cap("http://e.com/a/", status=200, ts_ms=2),
            cap("http://e.com/a", status=200, attempt=1, ts_ms=3)]
    out = O.resolve_attempts(captures(spark, rows), sites(spark)).first()
    assert (out.http_status, out.win_attempt, out.n_attempts, out.fetched_at) == (200, 1, 2, at(3))


def test_a_failed_head_without_a_get_is_unresolved(spark):
    rows = [cap("http://e.com/1", kind="link", method="HEAD", status=405), cap("http://e.com/2", kind="link", method="HEAD", error="reset"),
            cap("http://e.com/3", kind="link", method="HEAD", status=501), cap("http://e.com/3", kind="link", method="GET", status=404),
            cap("http://e.com/4", kind="link", method="GET", status=200)]
    caps = captures(spark, rows)
    assert {r.norm_url: r.status_code for r in O.resolve_link_probe(caps).collect()} == {"http://e.com/3": 404, "http://e.com/4": 200}
    assert {r.norm_url for r in O.resolve_asset_probe(caps).collect()} == {"http://e.com/3", "http://e.com/4"}


def test_sizes_are_whole_unless_a_cap_is_given(spark):
    big = 80 << 20
    caps = captures(spark, [cap("http://e.com/i", kind="asset", method="HEAD", status=405),
                            cap("http://e.com/i", kind="asset", method="GET", status=200, body_bytes=big)])
    assert O.resolve_asset_probe(caps).first().size_bytes == big
    assert O.resolve_asset_probe(caps, size_cap=50 << 20).first().size_bytes == 50 << 20


def test_failed_pages_carry_their_last_attempt_and_cancelled_ones_the_deadline(spark):
    caps = captures(spark, [cap("http://e.com", body=html("r", '<a href="/f">f</a><a href="/m">m</a><a href="/n">n</a>')),
                            cap("http://e.com/f", status=500, ts_ms=1000), cap("http://e.com/f", status=503, attempt=1, ts_ms=2000),
                            cap("http://e.com/m", status=503, ts_ms=1000), cap("http://e.com/m", status=200, attempt=1, ts_ms=90_000)])
    cut = spark.createDataFrame([("s", "http://e.com", 2, 1, 0, 0, "", at(60_000))], schemas.SITES)
    got = {r.norm_url: (r.error, r.discovered_at) for r in run_audit(caps, cut).pages.collect()}
    assert got["http://e.com/f"] == ("HTTP 503 (retriable)", at(2000))
    assert got["http://e.com/m"] == got["http://e.com/n"] == ("context canceled", at(60_000))


def test_cancelled_links_and_assets_under_a_deadline(spark):
    caps = captures(spark, [cap("http://e.com", body=html("r", '<a href="http://o.com/1">x</a><img src="/i.png">')),
                            cap("http://o.com/1", kind="link", method="HEAD", status=405, ts_ms=10),
                            cap("http://o.com/1", kind="link", method="GET", status=200, ts_ms=90_000)])
    cut = spark.createDataFrame([("s", "http://e.com", 1, 1, 0, 0, "", at(60_000))], schemas.SITES)
    a = run_audit(caps, cut)
    assert a.link_status.first().error == "both HEAD and GET requests failed: context canceled"
    assert a.asset_status.first().error == "request failed: context canceled"
    open_end = run_audit(caps.filter("fetched_at < timestamp'2024-01-01 00:01:00'"), sites(spark, "http://e.com"))
    assert open_end.link_status.count() == 0 and open_end.asset_status.count() == 0


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    """Captures of one thing at one time, or without a time, in every order: the same outcome."""
    import itertools

    from pyspark.sql import functions as F
    rows = [cap("http://e.com/a", kind="link", method="HEAD", status=404), cap("http://e.com/a", kind="link", method="HEAD", status=200),
            cap("http://e.com/a/", kind="link", method="HEAD", status=301)]
    frames = [captures(spark, list(order)).coalesce(1) for order in itertools.permutations(rows)]
    for when in (F.col("fetched_at"), F.lit(None).cast("timestamp")):
        timed = [f.withColumn("fetched_at", when) for f in frames]
        assert len({tuple(O.resolve_link_probe(f).first()) for f in timed}) == 1
        assert len({tuple(O.resolve_asset_probe(f).first()) for f in timed}) == 1
        assert len({tuple(O.resolve_attempts(f, sites(spark)).first()) for f in timed}) == 1
    assert O.resolve_link_probe(frames[0]).first().status_code == 200


def test_a_probe_with_two_statuses_keeps_its_first_by_time(spark):
    rows = [cap("http://e.com/a", kind="link", method="HEAD", status=200, ts_ms=9), cap("http://e.com/a", kind="link", method="HEAD", status=404, ts_ms=3)]
    assert O.resolve_link_probe(captures(spark, rows)).first().status_code == 404


def test_backoff_counts_an_attempt_once(spark):
    """Repeats of attempts, in two spellings, add neither rows nor waits."""
    rows = [cap("http://e.com/a", status=503, attempt=k, ts_ms=10 * k + r) for k in (0, 1, 2) for r in (0, 1)]
    rows += [cap("http://e.com/a/", status=200, attempt=1, ts_ms=999)]
    out = O.backoff_plan(captures(spark, rows), sites(spark, retries=2, delay_ms=100)).orderBy("attempt").collect()
    once = O.backoff_plan(captures(spark, rows[0:6:2]), sites(spark, retries=2, delay_ms=100)).orderBy("attempt").collect()
    assert [(r.attempt, r.wait_ms, r.cum_wait_ms) for r in out] == [(r.attempt, r.wait_ms, r.cum_wait_ms) for r in once]
    assert [(r.attempt, r.wait_ms) for r in out] == [(0, 0.0), (1, 100.0), (2, 0.0)]


def test_tied_bodies_give_one_extraction(spark):
    rows = [cap("http://e.com", body=html("B", '<a href="/b">b</a>')), cap("http://e.com", body=html("A", '<a href="/a">a</a>')),
            cap("http://e.com", status=404, body=html("C", '<a href="/0">c</a>'))]
    seen = set()
    for order in (rows, rows[::-1], [rows[1], rows[2], rows[0]]):
        page = run_audit(captures(spark, order), sites(spark, "http://e.com")).pages.first()
        seen.add((page.http_status, page.seo.title))
    assert seen == {(200, "A")}
