"""Outcome resolution over captured attempts and probes.

Every operator here is one aggregation keyed by (site_id, norm_url): partial aggregation runs
before the shuffle, so a URL or a site holding a large share of the rows is combined map-side and
never gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.functions import status as S
from sitelens.functions import urls as U
from sitelens.operators.skew import with_site

_KEYS = ["site_id", "norm_url"]
CANCELLED = "context canceled"   # fixed value: the error of work that a deadline cut off


def with_norm(df: DataFrame, url_col: str = "url") -> DataFrame:
    return df.withColumn("norm_url", F.coalesce(U.normalize_url(url_col), F.lit("")))


def capture_order(captures: DataFrame) -> Column:
    """What decides between several captures of one thing: the first by time, then by spelling, status and error; nulls first."""
    return F.struct(*[c for c in ("fetched_at", "url", "status_code", "error", "body") if c in captures.columns])


def resolve_attempts(attempts: DataFrame, sites: DataFrame) -> DataFrame:
    """one outcome per (site, normalised URL) from attempts 0..retries.

    The first winning attempt (no error, status > 0, not retriable -- a 404 wins) is the outcome;
    when none wins: http_status 0 and the last failing attempt's error.  Input needs
    (site_id, url, attempt, status_code, error[, fetched_at, final_url, content_type, body]).

    Of several captures of one attempt (spellings of one URL, repeats) the first by (fetched_at, url, status_code, error)
    counts, so the order of the input never matters.  ``win_url`` and ``fetched_at`` name the capture that won, or the last that failed.  With a
    ``deadline`` in ``sites``, a URL whose retries were not used up by then is cancelled.
    """
    opt = sites.select("site_id", "retries", *(["deadline"] if "deadline" in sites.columns else []))
    a = with_site(with_norm(attempts), opt, ["url"]).filter(F.col("attempt") <= F.col("retries"))
    carry = [c for c in ("status_code", "fetched_at", "final_url", "content_type", "body", "url", "error") if c in a.columns]
    a = a.groupBy(*_KEYS, "attempt").agg(
        F.min_by(F.struct(*carry), capture_order(a)).alias("c"), F.first("retries").alias("retries"),
        *([F.first("deadline").alias("deadline")] if "deadline" in opt.columns else []))
    win = S.is_win(F.col("c.status_code"), F.col("c.error"))
    last = F.max_by(F.struct(S.attempt_error(F.col("c.status_code"), F.col("c.error")).alias("error"),
                             *([F.col("c.fetched_at").alias("fetched_at")] if "fetched_at" in carry else [])), F.col("attempt"))
    cancelled = F.lit(False)
    if "deadline" in opt.columns:
        cancelled = F.first("deadline").isNotNull() & (F.max("attempt") < F.first("retries"))
    agg = a.groupBy(*_KEYS).agg(
        F.min_by(F.when(win, F.col("c")), F.when(win, F.col("attempt"))).alias("w"),
        F.min(F.when(win, F.col("attempt"))).alias("win_attempt"), last.alias("l"), cancelled.alias("cut"),
        F.min_by(F.col("c.url"), F.col("attempt")).alias("url"),
        F.count(F.lit(1)).alias("n_attempts"))
    ok = F.col("w").isNotNull()
    http = F.when(ok, F.col("w.status_code")).otherwise(F.lit(0))
    out = agg.select(
        *_KEYS, "url",
        http.cast("int").alias("http_status"),
        S.status_label(http).alias("status"),
        F.when(ok, F.lit("")).when(F.col("cut"), F.lit(CANCELLED)).otherwise(F.coalesce(F.col("l.error"), F.lit(""))).alias("error"),
        F.col("win_attempt").cast("int").alias("win_attempt"), F.col("w.url").alias("win_url"),
        F.col("n_attempts"),
        *([F.when(ok, F.col("w.fetched_at")).when(~F.col("cut"), F.col("l.fetched_at")).alias("fetched_at")]
          if "fetched_at" in carry else []),
        *([F.col("w.content_type").alias("content_type")] if "content_type" in carry else []),
        *([F.col("w.body").alias("body")] if "body" in carry else []),
        *([F.col("w.final_url").alias("_final")] if "final_url" in carry else []))
    if "final_url" in carry:
        out = out.withColumn("page_url", F.when(F.col("http_status") > 0, F.coalesce(U.normalize_url("_final"),
                                                                                  F.col("norm_url")))
                             .otherwise(F.col("norm_url"))).drop("_final")
    return out


def backoff_plan(attempts: DataFrame, sites: DataFrame) -> DataFrame:
    """wait before the next attempt = base x attempt after a retriable failure, none after the last.

    One row an attempt: of several captures of one the first counts, as in ``resolve_attempts``.  Adds ``wait_ms`` and the running ``cum_wait_ms`` per URL (window partitioned by URL: URLs are
    many and each has at most retries+1 rows, so no partition is large).
    """
    opt = sites.select("site_id", "retries", "rps", "delay_ms")
    a = with_norm(attempts).filter(F.col("attempt").isNotNull())
    a = a.groupBy(*_KEYS, "attempt").agg(F.min_by(F.struct(*[c for c in a.columns if c not in (*_KEYS, "attempt")]), capture_order(a)).alias("c")) \
        .select(*_KEYS, "attempt", "c.*")
    a = a.join(opt, "site_id").filter(F.col("attempt") <= F.col("retries"))
    fail = ~S.is_win(F.col("status_code"), F.col("error"))
    first_win = F.min(F.when(~fail, F.col("attempt"))).over(Window.partitionBy(*_KEYS))
    a = a.withColumn("_first_win", first_win).filter(F.col("_first_win").isNull()
                                                     | (F.col("attempt") <= F.col("_first_win")))
    wait = F.when(fail & (F.col("attempt") < F.col("retries")),
                  S.backoff_base_ms(F.col("rps"), F.col("delay_ms")) * F.col("attempt")).otherwise(F.lit(0.0))
    w = Window.partitionBy(*_KEYS).orderBy("attempt").rowsBetween(Window.unboundedPreceding, 0)
    return a.withColumn("wait_ms", wait).withColumn("cum_wait_ms", F.sum("wait_ms").over(w)).drop("_first_win")


def _probe_pivot(probes: DataFrame, extra: list[str]) -> DataFrame:
    """HEAD and GET results side by side per (site, norm_url)."""
    p = with_norm(probes)
    streamed = "arrived" in p.columns
    cols = ["status_code", "error", *extra, *(["arrived"] if streamed else [])]

    def pick(method):
        m = F.col("method") == method
        order = F.struct(*[c for c in ("arrived", "fetched_at", "url", *cols) if c in p.columns])
        return F.min_by(F.when(m, F.struct(*cols)), F.when(m, order))

    # a single capture per method is expected; of repeats the first by time counts (one without a time before all others),
    # and equal times are decided by the rest of the capture; in a stream, the first batch with one counts
    return p.groupBy(*_KEYS).agg(pick("HEAD").alias("head"), pick("GET").alias("get"), F.min("url").alias("url"),
                                 *([F.max("arrived").alias("arrived")] if streamed else []))


def _head_stands(head):
    return head.isNotNull() & head["error"].isNull() & ~F.coalesce(head["status_code"].isin(*S.FALLBACK_TO_GET),
                                                                   F.lit(False))


def _resolved():
    return _head_stands(F.col("head")) | F.col("get").isNotNull()


def resolve_link_probe(probes: DataFrame) -> DataFrame:
    """HEAD result unless it errored or returned 405/501, then the GET result; both failing ->
    status 0 and 'both HEAD and GET requests failed: <GET error>'.  A URL whose HEAD failed and whose
    GET is not captured (yet) has no result: it is left out, like one that was never probed.

    Probes of a stream carry ``arrived``, their batch; then ``decided`` is the batch from which on the URL
    is broken, if it is, and ``arrived`` the last batch that touched it."""
    pv = _probe_pivot(probes, []).filter(_resolved())
    head, get = F.col("head"), F.col("get")
    get_ok = get.isNotNull() & get["error"].isNull()
    status = F.when(_head_stands(head), head["status_code"]).when(get_ok, get["status_code"]).otherwise(F.lit(0))
    err = F.when(_head_stands(head) | get_ok, F.lit("")).otherwise(
        F.concat(F.lit("both HEAD and GET requests failed: "), get["error"]))
    out = [*_KEYS, "url", status.cast("int").alias("status_code"), err.alias("error")]
    if "arrived" not in pv.columns:
        return pv.select(*out)
    # a GET that came first and was broken made the URL broken before its HEAD came; else the capture that counts did
    early = get_ok & S.is_broken(get["status_code"], F.lit("")) | get["error"].isNotNull()
    early = F.coalesce(early & (get["arrived"] < head["arrived"]), F.lit(False))
    return pv.select(*out, F.when(_head_stands(head) & ~early, head["arrived"]).otherwise(get["arrived"]).alias("decided"), "arrived")


def resolve_asset_probe(probes: DataFrame, size_cap: int | None = None) -> DataFrame:
    """F5 + F6: HEAD -> GET rule; 2xx gives the size (HEAD: Content-Length verbatim, -1 when unknown;
    GET: Content-Length when known, else bytes read, clipped only by an explicit ``size_cap``); other
    status -> size 0 and 'HTTP <code>'; transport failure -> status 0, 'request failed: <error>'.
    Unresolved URLs are left out as in ``resolve_link_probe``."""
    pv = _probe_pivot(probes, ["content_length", "body_bytes"]).filter(_resolved())
    head, get = F.col("head"), F.col("get")
    get_ok = get.isNotNull() & get["error"].isNull()
    use_head = _head_stands(head)
    status = F.when(use_head, head["status_code"]).when(get_ok, get["status_code"]).otherwise(F.lit(0))
    head_len = F.coalesce(head["content_length"], F.lit(-1).cast("long"))
    get_len = F.when(F.coalesce(get["content_length"], F.lit(-1).cast("long")) >= 0, get["content_length"]) \
        .otherwise(F.least(F.coalesce(get["body_bytes"], F.lit(0).cast("long")), F.lit(size_cap).cast("long")))
    is2xx = (status >= 200) & (status < 300)
    size = F.when(use_head & is2xx, head_len).when(~use_head & get_ok & is2xx, get_len).otherwise(F.lit(0).cast("long"))
    err = F.when(use_head | get_ok, F.when(is2xx, F.lit("")).otherwise(F.concat(F.lit("HTTP "), status.cast("string")))) \
        .otherwise(F.concat(F.lit("request failed: "), get["error"]))
    return pv.select(*_KEYS, "url", status.cast("int").alias("status_code"), size.cast("long").alias("size_bytes"),
                     err.alias("error"))


def page_rows(outcomes: DataFrame, depths: DataFrame, sites: DataFrame) -> DataFrame:
    """F8: page_facts rows: url = normalised final URL on success (requested URL otherwise), status
    label, error '' on success, discovered_at truncated to the second.  A failed page carries the time
    of its last attempt, a cancelled one its site's deadline."""
    j = depths.join(outcomes, _KEYS, "left").join(sites.select("site_id", "deadline"), "site_id")
    ok_row = F.col("http_status").isNotNull()
    return j.select(
        *_KEYS,
        F.coalesce(F.col("page_url"), F.col("norm_url")).alias("url"),
        F.col("depth").cast("int").alias("depth"),
        F.coalesce(F.col("http_status"), F.lit(0)).cast("int").alias("http_status"),
        S.status_label(F.coalesce(F.col("http_status"), F.lit(0))).alias("status"),
        F.when(ok_row, F.col("error")).otherwise(F.lit(CANCELLED)).alias("error"),
        F.date_trunc("second", F.coalesce(F.col("fetched_at"), F.col("deadline"))).alias("discovered_at"))


def apply_deadline(captures: DataFrame, sites: DataFrame) -> DataFrame:
    """captures a site fetched after its deadline are not seen (graceful cut-off)."""
    d = sites.select("site_id", "deadline")
    return captures.join(d, "site_id", "left").filter(
        F.col("deadline").isNull() | (F.col("fetched_at") <= F.col("deadline"))).drop("deadline")
