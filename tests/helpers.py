"""Small builders for capture tables (the reference's mock transport, as rows)."""

from __future__ import annotations

import datetime as dt

from sitelens import schemas

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def cap(url, kind="page", method="GET", status=200, ctype="text/html", body=None, attempt=0, error=None,
        length=None, body_bytes=None, ts_ms=0, site="s", final_url=None, ua="Bot/1.0"):
    return (site, url, method, kind, attempt, status, ctype, length, body, body_bytes, final_url, error, ua,
            T0 + dt.timedelta(milliseconds=ts_ms))


def captures(spark, rows):
    return spark.createDataFrame(rows, schemas.CAPTURES)


def sites(spark, root="http://example.com", depth=1, retries=1, delay_ms=0, rps=0, ua="", deadline=None, site="s"):
    return spark.createDataFrame([(site, root, depth, retries, delay_ms, rps, ua, deadline)], schemas.SITES)


def html(title="", body="", head=""):
    return f"<html><head>{head}<title>{title}</title></head><body>{body}</body></html>"
