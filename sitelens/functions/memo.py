"""Reuse of built Column expressions within one Spark application.

Building the URL / HTML expressions costs thousands of py4j calls on the driver.  Expressions
that only reference fixed column names are built once per application and reused by every
DataFrame that needs them (a Column is an unresolved expression; binding happens per plan).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import SparkContext

_CACHE: dict = {}


def memo(key: tuple, build: Callable):
    sc = SparkContext._active_spark_context
    app = getattr(sc, "_sitelens_app_id", None) if sc is not None else None
    if sc is not None and app is None:
        app = sc.applicationId  # one JVM round trip per application, then cached on the context
        sc._sitelens_app_id = app
    k = (app, key)
    hit = _CACHE.get(k)
    if hit is None:
        hit = build()
        _CACHE[k] = hit
    return hit
