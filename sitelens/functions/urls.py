"""URL canonicalisation and resolution as built-in Column expressions (no Python UDF).

The semantics follow the generic URL syntax as the reference applies it:

* ``normalize_url``  lower-case scheme and host, drop the default port (80 for http, 443 for https),
  strip every trailing ``/`` of the path, drop the fragment, re-encode the query with pairs stably
  sorted by key.  Unparseable input gives NULL.
* ``resolve_url``    reference resolution of an href against a page URL (RFC 3986 section 5.2 with the
  dot-segment rules of the reference's URL library), fragment dropped, query kept verbatim.

Everything is expressed with ``regexp_*``, ``split``, ``url_encode``/``try_url_decode`` and array
higher-order functions, so it stays inside the JVM.  ``canonicalize_urls`` is the table job: it
materialises the split once per row and derives every output column from it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# These must equal the reference's behaviour.
DEFAULT_SCHEME = "http"
DEFAULT_PORTS = (("http", "80"), ("https", "443"))
SPECIAL_PREFIXES = ("#", "javascript:", "mailto:", "tel:", "data:")
# Characters left unescaped (besides ASCII letters and digits) by each encoding mode.
PATH_KEEP = "-_.~$&+,/:;=@"
QUERY_KEEP = "-_.~"
USERINFO_KEEP = "-_.~$&+,;="
HOST_KEEP = "-_.~!$&'()*+,;=:[]<>\""
# ---------------------------------------------------------------------------------------------

_SEP = "\u0001"
# groups: 1 scheme | 2 authority after a scheme | 3 authority without scheme (not '///') | 4 path | 5 ?query | 6 #frag
_SPLIT_RE = (r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):(//[^/?#]*)?|(//(?!/)[^/?#]*))?"
             r"([^?#]*)(\?[^#]*)?(#.*)?\z")
_SPLIT_REPL = "$1" + _SEP + "$2$3" + _SEP + "$4" + _SEP + "$5" + _SEP + "$6"
_CTL_RE = r"[\x00-\x1f\x7f]"
_VALID_ENCODED_PATH_RE = r"^[A-Za-z0-9\-_.~$&+,/:;=@!'()*\[\]%]*$"
_USERINFO_RE = r"^[A-Za-z0-9\-._:~!$&'()*+,;=%@]*$"
_HOST_CHARS_RE = r"^(?:[A-Za-z0-9\-_.~!$&'()*+,;=:\[\]<>\"]|%25|%[89A-Fa-f][0-9A-Fa-f]|[^\x00-\x7F])*$"
_BAD_PCT_RE = r"%(?![0-9A-Fa-f]{2})"
_DOT_SEGMENT_RE = r"(^|/)\.\.?(/|$)"
# Fast paths (exact special cases of the general algorithm, checked with one cheap regex each).
# A canonical http(s) URL without port, query, fragment, trailing or doubled slash, with a
# validly-encoded path and no '%' is its own normal form.
_CANON_RE = r"^https?://[a-z0-9\-.]+(/[A-Za-z0-9\-_.~$&+,:;=@!'()*]+)*$"
# Root-relative reference without query, fragment, '%' or control characters.
_FAST_PATH_REF_RE = r"^/(?!/)[^?#%\x00-\x1f\x7f]*$"
# Absolute http(s) reference with a plain host, optional port, path without query/fragment/'%'.
_FAST_ABS_REF_RE = r"^([hH][tT][tT][pP][sS]?)://([A-Za-z0-9\-.]+(?::[0-9]*)?)(/[^?#%\x00-\x1f\x7f]*)?$"
_ORIGIN_RE = r"^([a-z][a-z0-9+.\-]*://[^/?#]*)"


def _lit(v) -> Column:
    """Literal Column, created once per application (each creation is a JVM round trip)."""
    from sitelens.functions.memo import memo
    return memo(("lit", type(v).__name__, v), lambda: F.lit(v))


def let(value: Column, body) -> Column:
    """Bind ``value`` once and evaluate ``body(bound)``: keeps expression trees linear in size
    when a value is used several times (a one-element ``transform`` acts as a let-binding)."""
    return F.get(F.transform(F.array(value), body), 0)


def _enc(c: Column, keep: str, space_plus: bool = False) -> Column:
    """Percent-encode (UTF-8, upper-case hex) every character except ASCII letters, digits and ``keep``.

    ``url_encode`` keeps ``A-Za-z0-9 . - * _`` and writes space as ``+``; the chain of literal
    replaces below turns that into the requested mode.  Every ``%XX`` it emits stands for exactly one
    byte, so un-escaping kept characters afterwards is unambiguous.
    """
    e = F.url_encode(c)
    if not space_plus:
        e = F.replace(e, _lit("+"), _lit("%20"))
    for ch in ".-*_":
        if ch not in keep:
            e = F.replace(e, _lit(ch), _lit("%%%02X" % ord(ch)))
    for ch in keep:
        if ch.isalnum() or ch in ".-*_":
            continue
        e = F.replace(e, _lit("%%%02X" % ord(ch)), _lit(ch))
    return e


def _dec_path(c: Column) -> Column:
    """Percent-decode where ``+`` is literal; NULL when an escape is malformed."""
    return F.try_url_decode(F.replace(c, _lit("+"), _lit("%2B")))


@dataclass
class UrlParts:
    """Parsed pieces of one URL column (each a Column)."""

    raw: Column
    scheme: Column        # lower-cased, '' when absent
    has_auth: Column      # '//' authority present
    auth: Column          # authority text without '//'
    path: Column          # raw path (or opaque part)
    query: Column         # '' | '?' | '?<raw query>'
    frag: Column          # '' | '#...'

    @property
    def hostport(self) -> Column:
        return F.substring_index(self.auth, "@", -1)

    @property
    def has_user(self) -> Column:
        return self.has_auth & (F.instr(self.auth, "@") > 0)

    @property
    def userinfo(self) -> Column:
        return F.regexp_extract(self.auth, r"(?s)^(.*)@", 1)

    @property
    def is_opaque(self) -> Column:
        return (self.scheme != "") & ~self.has_auth & (self.path != "") & ~self.path.startswith("/")

    @property
    def omit_host(self) -> Column:
        return (self.scheme != "") & ~self.has_auth & self.path.startswith("/")

    @property
    def valid(self) -> Column:
        """True when the URL parses (control characters, bad escapes, bad host/port/userinfo fail)."""
        hp = self.hostport
        ui = self.userinfo
        port_ok = F.when(hp.startswith("["), hp.rlike(r"(?s)^\[.*\](:[0-9]*)?$")) \
            .otherwise(~hp.contains(":") | hp.rlike(r":[0-9]*$"))
        user_ok = ~self.has_user | (
            ui.rlike(_USERINFO_RE) & _dec_path(F.substring_index(ui, ":", 1)).isNotNull()
            & _dec_path(F.regexp_replace(ui, r"^[^:]*:?", "")).isNotNull())
        auth_ok = ~self.has_auth | (port_ok & hp.rlike(_HOST_CHARS_RE) & user_ok)
        first_seg_colon = (self.scheme == "") & ~self.has_auth & ~self.path.startswith("/") \
            & F.substring_index(self.path, "/", 1).contains(":")
        path_ok = self.is_opaque | _dec_path(self.path).isNotNull()
        return (self.raw.isNotNull() & ~self.raw.rlike(_CTL_RE) & ~self.raw.startswith(":")
                & ~self.frag.rlike(_BAD_PCT_RE) & ~first_seg_colon & path_ok & auth_ok)


def split_url(c: Column) -> Column:
    """One regex pass: array(scheme, '//'+authority, path, '?'+query, '#'+fragment)."""
    return F.split(F.regexp_replace(c, _SPLIT_RE, _SPLIT_REPL), _SEP, -1)


def parts_of(raw: Column, split: Column | None = None) -> UrlParts:
    p = split_url(raw) if split is None else split
    a = p.getItem(1)
    return UrlParts(raw=raw, scheme=F.lower(p.getItem(0)), has_auth=a != "", auth=F.substring(a, 3, 1 << 30),
                    path=p.getItem(2), query=p.getItem(3), frag=p.getItem(4))


def _encode_host(decoded: Column) -> Column:
    return _enc(decoded, HOST_KEEP)


def _host_out(hostport: Column, lower: bool) -> Column:
    """Host as the URL library prints it: unescaped (optionally lower-cased) then re-escaped."""
    plain = hostport.rlike(r"^[\x21-\x7E]*$") & ~hostport.contains("%")
    h = F.lower(hostport) if lower else hostport
    slow = _encode_host(F.lower(_dec_path(hostport)) if lower else _dec_path(hostport))
    return F.when(plain, h).otherwise(slow)


def _userinfo_out(ui: Column) -> Column:
    user = F.substring_index(ui, ":", 1)
    pw = F.regexp_replace(ui, r"^[^:]*:", "")
    return F.concat(_enc(_dec_path(user), USERINFO_KEEP),
                    F.when(ui.contains(":"), F.concat(_lit(":"), _enc(_dec_path(pw), USERINFO_KEEP))).otherwise(_lit("")))


def _assemble(scheme: Column, user_present: Column, user_out: Column, host: Column, path: Column,
              omit_host: Column, query: Column) -> Column:
    """Print a non-opaque URL the way the reference's URL library does (fragment already dropped)."""
    def body(v):
        scheme, user_present, user_out, host, path, omit_host, query = (
            v["s"], v["up"], v["uo"], v["h"], v["p"], v["oh"], v["q"])
        scheme_part = F.when(scheme != "", F.concat(scheme, _lit(":"))).otherwise(_lit(""))
        has_auth_part = (scheme != "") | (host != "") | user_present
        omitted = omit_host & (host == "") & ~user_present
        auth_part = F.when(has_auth_part & ~omitted, F.concat(
            F.when((host != "") | (path != "") | user_present, _lit("//")).otherwise(_lit("")),
            F.when(user_present, F.concat(user_out, _lit("@"))).otherwise(_lit("")),
            host)).otherwise(_lit(""))
        slash = F.when((path != "") & ~path.startswith("/") & (host != ""), _lit("/")).otherwise(_lit(""))
        dot = F.when((scheme == "") & ~has_auth_part & F.substring_index(path, "/", 1).contains(":"),
                     _lit("./")).otherwise(_lit(""))
        return F.concat(scheme_part, auth_part, slash, dot, path, query)

    return let(F.struct(scheme.alias("s"), user_present.alias("up"), user_out.alias("uo"), host.alias("h"),
                        path.alias("p"), omit_host.alias("oh"), query.alias("q")), body)


def normalize_query(q: Column) -> Column:
    """U1q: decode pairs, stable-sort by key, re-encode; bad pairs (``;`` or bad ``%``) dropped."""
    items = F.transform(F.split(q, "&", -1), lambda x, i: F.struct(
        F.try_url_decode(F.substring_index(x, "=", 1)).alias("k"),
        i.alias("i"),
        F.try_url_decode(F.regexp_replace(x, r"(?s)^[^=]*=?", "")).alias("v"),
        ((x != "") & ~x.contains(";")).alias("ok")))
    good = F.filter(items, lambda s: s["ok"] & s["k"].isNotNull() & s["v"].isNotNull())
    return F.array_join(F.transform(F.array_sort(good), lambda s: F.concat(
        _enc(s["k"], QUERY_KEEP, space_plus=True), _lit("="), _enc(s["v"], QUERY_KEEP, space_plus=True))), "&")


def _normalized_query_part(query: Column) -> Column:
    norm = let(normalize_query(F.substring(query, 2, 1 << 30)),
               lambda n: F.when(n == "", _lit("")).otherwise(F.concat(_lit("?"), n)))
    return F.when(query == "", _lit("")).when(query == "?", _lit("?")).otherwise(norm)


def escaped_path(path: Column) -> Column:
    """The path as the URL library prints it: verbatim when validly encoded, else re-escaped."""
    return F.when(path.rlike(_VALID_ENCODED_PATH_RE), path).otherwise(_enc(_dec_path(path), PATH_KEEP))


def _normalized_path(path: Column) -> Column:
    def body(dec):
        trimmed = F.regexp_replace(dec, "/+$", "")
        return F.when((trimmed == dec) & path.rlike(_VALID_ENCODED_PATH_RE), path).otherwise(_enc(trimmed, PATH_KEEP))
    return F.when(path.rlike(_VALID_ENCODED_PATH_RE) & ~path.endswith("/") & ~path.contains("%"), path) \
        .otherwise(let(_dec_path(path), body))


def _strip_default_port(scheme: Column, hostport: Column) -> Column:
    port = F.regexp_extract(hostport, r":([0-9]*)$", 1)
    is_default = _lit(False)
    for s, p in DEFAULT_PORTS:
        is_default = is_default | ((scheme == s) & (port == p) & hostport.rlike(r":[0-9]*$"))
    return F.when(is_default, F.regexp_replace(hostport, r":[0-9]*$", "")).otherwise(hostport)


def normalize_parts(u: UrlParts) -> Column:
    host = F.when(u.has_auth, _host_out(_strip_default_port(u.scheme, F.lower(u.hostport)), lower=True)) \
        .otherwise(_lit(""))
    user_present = u.has_user
    user_out = F.when(user_present, _userinfo_out(u.userinfo)).otherwise(_lit(""))
    path = _normalized_path(u.path)
    query = _normalized_query_part(u.query)
    opaque = F.concat(u.scheme, _lit(":"), u.path, query)
    main = _assemble(u.scheme, user_present, user_out, host, path, u.omit_host, query)
    return F.when(u.valid, F.when(u.is_opaque, opaque).otherwise(main))


def normalize_url(c: Column | str) -> Column:
    """Canonical form of a URL, NULL when it does not parse (a column name is memoised)."""
    if isinstance(c, str):
        from sitelens.functions.memo import memo
        return memo(("normalize_url", c), lambda: normalize_url(F.col(c)))
    full = let(F.struct(c.alias("raw"), split_url(c).alias("p")),
               lambda s: normalize_parts(parts_of(s["raw"], s["p"])))
    return F.when(c.rlike(_CANON_RE), c).otherwise(full)


def normalize_or_keep(c: Column | str) -> Column:
    """Canonical form, or the input when it does not parse."""
    return F.coalesce(normalize_url(c), F.col(c) if isinstance(c, str) else c)


def host_of(c: Column) -> Column:
    """Host (with port, without user info) exactly as written, '' for relative/opaque, NULL if unparseable."""
    def body(s):
        u = parts_of(s["raw"], s["p"])
        hp = F.when(u.has_auth, u.hostport).otherwise(_lit(""))
        return F.when(u.valid, F.when(hp.contains("%"), _dec_path(hp)).otherwise(hp))
    return let(F.struct(c.alias("raw"), split_url(c).alias("p")), body)


def same_domain(root: Column | str, link: Column | str) -> Column:
    """Exact, case-sensitive host:port equality; false when either side does not parse."""
    if isinstance(root, str) and isinstance(link, str):
        from sitelens.functions.memo import memo
        return memo(("same_domain", root, link), lambda: same_domain(F.col(root), F.col(link)))
    return F.coalesce(host_of(root) == host_of(link), _lit(False))


def with_default_scheme(c: Column) -> Column:
    """Prefix the default scheme when missing (used for link and asset checks only)."""
    u = parts_of(c)
    return F.when(u.valid & c.isNotNull(), F.when(u.scheme != "", c)
                  .when(c == "", _lit(DEFAULT_SCHEME + ":"))
                  .when(c.startswith("//"), F.concat(_lit(DEFAULT_SCHEME + ":"), c))
                  .otherwise(F.concat(_lit(DEFAULT_SCHEME + "://"), c)))


def is_special_url(c: Column) -> Column:
    """Raw value starts with one of the special prefixes (case-sensitive, untrimmed)."""
    cond = _lit(False)
    for p in SPECIAL_PREFIXES:
        cond = cond | c.startswith(p)
    return cond


def url_error(c: Column) -> Column:
    """U8: error text for URLs that do not parse, NULL otherwise."""
    return F.when(c.isNotNull() & normalize_url(c).isNull(), F.concat(_lit("invalid URL: "), c))


def parse_error(c: Column) -> Column:
    """U8: True for URLs whose normalisation fails (row-level validity flag)."""
    return c.isNotNull() & normalize_url(c).isNull()


def resolve_path(base: Column, ref: Column) -> Column:
    """Merge a base path and a reference path and remove dot segments."""
    merged = F.when(ref == "", base).when(~ref.startswith("/"),
                                          F.concat(F.regexp_replace(base, "[^/]*$", ""), ref)).otherwise(ref)
    return let(merged, _remove_dot_segments)


def _remove_dot_segments(full: Column) -> Column:
    simple = F.when(full.startswith("/"), full).otherwise(F.concat(_lit("/"), full))

    def step(acc, e):
        keep = F.struct(acc["b"].alias("b"), _lit(False).alias("f"), e.alias("l"))
        up = F.when(F.instr(acc["b"], "/") == 0, F.struct(_lit("").alias("b"), _lit(True).alias("f"), e.alias("l"))) \
            .otherwise(F.struct(F.regexp_replace(acc["b"], "/[^/]*$", "").alias("b"), acc["f"].alias("f"),
                                e.alias("l")))
        add = F.struct(F.concat(acc["b"], F.when(acc["f"], "").otherwise("/"), e).alias("b"),
                       _lit(False).alias("f"), e.alias("l"))
        return F.when(e == ".", keep).when(e == "..", up).otherwise(add)

    dotted = F.aggregate(
        F.split(full, "/", -1),
        F.struct(_lit("").alias("b"), _lit(True).alias("f"), _lit("").alias("l")),
        step,
        lambda acc: F.regexp_replace(
            F.concat(_lit("/"), acc["b"], F.when(acc["l"].isin(".", ".."), _lit("/")).otherwise(_lit(""))), "^//", "/"))
    return F.when(full == "", _lit("")).when(full.rlike(_DOT_SEGMENT_RE), dotted).otherwise(simple)


def resolve_url(base: Column, ref: Column, base_split: Column | None = None) -> Column:
    """U4: resolve ``ref`` against the (normalised) page URL ``base``; fragment dropped.

    NULL for an empty or unparseable reference (the reference drops such hrefs).  Pass
    ``base_split`` (``split_url(base)`` materialised once per page) when resolving many references.
    """
    bs = split_url(base) if base_split is None else base_split
    full = let(F.struct(base.alias("b"), bs.alias("bp"), ref.alias("r"), split_url(ref).alias("rp")),
               lambda s: _resolve(parts_of(s["b"], s["bp"]), parts_of(s["r"], s["rp"]), s["b"], s["r"]))
    origin = F.regexp_extract(base, _ORIGIN_RE, 1)
    no_dots = ~ref.rlike(_DOT_SEGMENT_RE)
    fast_rel = ref.rlike(_FAST_PATH_REF_RE) & no_dots & (origin != "")
    fast_abs = ref.rlike(_FAST_ABS_REF_RE) & no_dots
    fast_frag = ref.startswith("#") & ~ref.rlike(_BAD_PCT_RE) & ~ref.rlike(_CTL_RE) & ~base.contains("/.")
    abs_out = F.concat(F.lower(F.regexp_extract(ref, _FAST_ABS_REF_RE, 1)), _lit("://"),
                       F.regexp_extract(ref, _FAST_ABS_REF_RE, 2),
                       _enc(F.regexp_extract(ref, _FAST_ABS_REF_RE, 3), PATH_KEEP))
    return F.when(base.isNull(), F.lit(None).cast("string")) \
        .when(fast_rel, F.concat(origin, _enc(ref, PATH_KEEP))) \
        .when(fast_abs, abs_out) \
        .when(fast_frag, base) \
        .otherwise(full)


def _resolve(b: UrlParts, r: UrlParts, base: Column, ref: Column) -> Column:
    b_auth_present = b.has_auth
    b_user = b.has_user
    b_userinfo = F.when(b_user, b.userinfo).otherwise(_lit(""))
    b_host = F.when(b_auth_present, b.hostport).otherwise(_lit(""))

    r_user = r.has_user
    r_host = F.when(r.has_auth, _host_out(r.hostport, lower=False)).otherwise(_lit(""))
    r_has_sa = (r.scheme != "") | (r.has_auth & (r.hostport != "")) | r_user
    r_path_esc = escaped_path(r.path)

    scheme = F.when(r.scheme != "", r.scheme).otherwise(b.scheme)
    # let-bind the escaped reference path and its merge with the base path
    return let(F.struct(r_path_esc.alias("rpe")), lambda s: _resolve_out(
        b, r, base, ref, scheme, r_user, r_host, r_has_sa, s["rpe"], b_user, b_userinfo, b_host))


def _resolve_out(b, r, base, ref, scheme, r_user, r_host, r_has_sa, r_path_esc, b_user, b_userinfo, b_host):
    """The three cases share one path merge and one assembly; only their inputs differ.

    A  the reference has its own scheme / host: its path (dot segments removed), user, host, query;
    B  empty path and no '?': the base path and the base query;
    C  otherwise: the base path merged with the reference path, and the reference query.
    """
    same_doc = (r.path == "") & (r.query == "")
    path_base = F.when(r_has_sa, r_path_esc).otherwise(b.path)
    path_ref = F.when(r_has_sa | same_doc, _lit("")).otherwise(r_path_esc)
    query = F.when(~r_has_sa & same_doc, b.query).otherwise(r.query)
    user_present = F.when(r_has_sa, r_user).otherwise(b_user)
    user_out = F.when(r_has_sa, F.when(r_user, _userinfo_out(r.userinfo)).otherwise(_lit(""))).otherwise(b_userinfo)
    host = F.when(r_has_sa, r_host).otherwise(b_host)
    omit_host = r_has_sa & r.omit_host
    out = F.when(r_has_sa & r.is_opaque, F.concat(r.scheme, _lit(":"), r.path, r.query)).otherwise(
        _assemble(scheme, user_present, user_out, host, resolve_path(path_base, path_ref), omit_host, query))
    return F.when((ref != "") & r.valid & base.isNotNull(), out)


def canonicalize_urls(df: DataFrame, url_col: str, prefix: str = "") -> DataFrame:
    """Add ``norm_url``, ``scheme``, ``host`` and ``is_valid`` for any URL-bearing table.

    The regex split is materialised once per row; Catalyst will not inline it into the several
    consumers because it is not cheap to duplicate.
    """
    tmp = f"__{prefix}split"
    d = df.withColumn(tmp, split_url(F.col(url_col)))
    u = parts_of(F.col(url_col), F.col(tmp))
    host = F.when(u.has_auth, _host_out(_strip_default_port(u.scheme, F.lower(u.hostport)), lower=True)) \
        .otherwise(_lit(""))
    return d.withColumns({
        f"{prefix}norm_url": normalize_parts(u),
        f"{prefix}scheme": F.when(u.valid, u.scheme),
        f"{prefix}host": F.when(u.valid, host),
        f"{prefix}is_valid": u.valid,
    }).drop(tmp)
