"""Fixed schemas (always passed explicitly, never inferred)."""

from pyspark.sql import types as T

S, I, L, B, TS = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.TimestampType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SITES = _struct(("site_id", S), ("root_url", S), ("depth", I), ("retries", I), ("delay_ms", L), ("rps", I),
                ("user_agent", S), ("deadline", TS))

CAPTURES = _struct(("site_id", S), ("url", S), ("method", S), ("kind", S), ("attempt", I), ("status_code", I),
                   ("content_type", S), ("content_length", L), ("body", S), ("body_bytes", L), ("final_url", S),
                   ("error", S), ("user_agent", S), ("fetched_at", TS))

SEO = _struct(("has_title", B), ("title", S), ("has_description", B), ("description", S), ("has_h1", B))

LINK_STATUS = _struct(("url", S), ("status_code", I), ("error", S))

ASSET = _struct(("url", S), ("type", S), ("status_code", I), ("size_bytes", L), ("error", S))

PAGE = T.StructType([
    T.StructField("url", S), T.StructField("depth", I), T.StructField("http_status", I),
    T.StructField("status", S), T.StructField("error", S),
    T.StructField("broken_links", T.ArrayType(LINK_STATUS)), T.StructField("assets", T.ArrayType(ASSET)),
    T.StructField("discovered_at", TS), T.StructField("seo", SEO),
])

# the first row of a site's report: its JSON object without pages
HEADER = _struct(("root_url", S), ("depth", I), ("generated_at", S))

REPORT = _struct(("site_id", S), ("root_url", S), ("depth", I), ("generated_at", TS), ("pages", T.ArrayType(PAGE)))
