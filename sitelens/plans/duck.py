"""Small DuckDB SQL helpers for oracle texts (oracle side only)."""

# Characters the reference's path encoder keeps that DuckDB's url_encode escapes.
_PATH_KEEP_BACK = ["$", "&", "+", ",", "/", ":", ";", "=", "@"]


def path_encode(expr: str) -> str:
    out = f"url_encode({expr})"
    for ch in _PATH_KEEP_BACK:
        out = f"replace({out}, '%{ord(ch):02X}', '{ch}')"
    return out


def simple_norm(expr: str) -> str:
    """Canonical form of the simple URL shapes in the driver data: drop '#...', trailing '/' of the path."""
    return f"regexp_replace(regexp_replace({expr}, '#.*$', ''), '/+(\\?|$)', '\\1')"


def origin(expr: str) -> str:
    return f"regexp_extract({expr}, '^([a-z]+://[^/?#]*)', 1)"
