"""Status predicates and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# These must equal the reference's behaviour.
OK_CODES = (200, 201, 202, 204)
STATUS_OK = "ok"
STATUS_ERROR = "error"
FALLBACK_TO_GET = (405, 501)
TOO_MANY_REQUESTS = 429
DEFAULT_BACKOFF_MS = 100.0


def is_retriable(status: Column, error: Column) -> Column:
    """transport error, 429, or any 5xx."""
    return F.coalesce(error.isNotNull() | (status == TOO_MANY_REQUESTS) | (status >= 500), F.lit(True))


def is_win(status: Column, error: Column) -> Column:
    """A page attempt that ends the retry loop: no error, status > 0, not retriable (a 404 wins)."""
    return F.coalesce(error.isNull() & (status > 0) & ~is_retriable(status, error), F.lit(False))


def status_label(code: Column) -> Column:
    """'ok' only for 200, 201, 202 and 204."""
    return F.when(F.coalesce(code.isin(*OK_CODES), F.lit(False)), F.lit(STATUS_OK)).otherwise(F.lit(STATUS_ERROR))


def is_broken(status: Column, error: Column) -> Column:
    """Status >= 400 or a non-empty error."""
    return F.coalesce(status >= 400, F.lit(False)) | F.coalesce(error != "", F.lit(False))


def attempt_error(status: Column, error: Column) -> Column:
    """Error text a failing attempt leaves behind."""
    return F.coalesce(error, F.when(is_retriable(status, error),
                                    F.concat(F.lit("HTTP "), status.cast("string"), F.lit(" (retriable)"))))


def backoff_base_ms(rps: Column, delay_ms: Column) -> Column:
    """Base wait: one token interval for rps, else the delay, else 100 ms."""
    return F.when(rps > 0, F.lit(1000.0) / rps).when(delay_ms > 0, delay_ms.cast("double")) \
        .otherwise(F.lit(DEFAULT_BACKOFF_MS))
