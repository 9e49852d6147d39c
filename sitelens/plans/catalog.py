"""Query catalogue: every registered operator as (Spark job, DuckDB oracle SQL).

Each Spark callable takes (spark, sf_dir) and reads the driver tables (or tables Spark derives
from them).  Each oracle computes the expected rows from fixture *components* with plain SQL, not
by repeating the Spark expressions.  Column names and types are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DESCRIPTIONS: dict[str, str] = {}


def register(name: str, oracle: str | None = None, about: str = ""):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        DESCRIPTIONS[name] = about or (fn.__doc__ or "").strip().splitlines()[0] if fn.__doc__ else about
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from sitelens.plans import queries_urls, queries_extract, queries_outcomes, queries_graph, queries_report  # noqa: F401
    from sitelens.plans import queries_requests, queries_streaming  # noqa: F401
