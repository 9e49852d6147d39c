"""HTML text -> structured values, as built-in Column expressions.

One regex pass over a body is the lexer: it reads over comments and raw text and lists the start tags
that matter (``a img image script link meta``), titles and h1 in document order; every later step works
on those short strings with array higher-order functions.  Entity decoding uses the HTML5 named
character references shipped with Python's standard library (``html.entities.html5``) as a map
literal, and numeric references through a UTF-32 round trip -- no Python worker is involved.
"""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitelens.functions.urls import _lit, let

# ---------------------------------------------------------------------------------------------
# These must equal the reference's behaviour.
RAW_TEXT_TAGS = ("script", "style", "textarea", "noscript", "iframe", "xmp", "noembed", "noframes")
TARGET_TAGS = ("a", "img", "image", "script", "link", "meta")
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".gif", ".svg", ".webp", ".ico", ".bmp", ".tiff", ".tif")
SCRIPT_EXTENSIONS = (".js", ".mjs")
STYLE_EXTENSIONS = (".css",)
CSS_URL_TRIM = "'\" \t\n\r"
HTML_BODY_CAP = 10 * 1024 * 1024
ASSET_BODY_CAP = 50 * 1024 * 1024
XML_MEDIA_TYPES = ("application/xml", "text/xml", "application/rss+xml")
HTML_MEDIA_TYPE = "text/html"
# ---------------------------------------------------------------------------------------------

# A quote opens a value only right after '='.  An unclosed quote runs to the end of the body, and so
# does an unclosed tag (``_END``), so no pattern reads the same text again from each of many openings.
_ATTRS = r"""(?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|[^\s>]*+))*+"""
_NAME_END = r"(?=[\s/>]|\z)"
_END = r"(?:>|\z)"
_RAW = "|".join(t for t in RAW_TEXT_TAGS if t != "script")
_TARGET = "|".join(t for t in TARGET_TAGS if t != "script")
# One lexer for a whole body: comments, bogus comments and raw text are read over, and group 2 is what counts: a title
# with its text, a start tag of interest, an h1 with a child, and the marks that ``effective_tokens`` needs.  Group 3 is
# an empty match that only a script sets, so that its text is read over behind the group.  Ends of raw text are left
# for the next match, which reads them as end tags with whatever they carry.
TOKEN_RE = (rf"(?is)<!--(?:-?>|.*?(?:--!?>|\z))"
            rf"|<(?:[?!]|/(?![a-z]))[^>]*(?:>|\z)"
            rf"|<plaintext{_NAME_END}.*"
            rf"|<({_RAW}){_NAME_END}{_ATTRS}{_END}.*?(?:(?=</\1{_NAME_END})|\z)"
            rf"|(<title{_NAME_END}{_ATTRS}{_END}.*?(?:(?=</title{_NAME_END})|\z)"
            rf"|<script(?=[\s/>])(){_ATTRS}>"
            rf"|<h1(?=[\s/>]){_ATTRS}>(?!</h[1-6]\s*>|<h[1-6][\s/>]|\z)"
            rf"|<(?:{_TARGET}|input|keygen)(?=[\s/>]){_ATTRS}>"
            rf"|</?(?:select|svg|math)(?=[\s/>]){_ATTRS}>)(?:\3.*?(?:(?=</script{_NAME_END})|\z)|(?!\3))"
            rf"|</?[a-z][^\s/>]*{_ATTRS}{_END}")
TITLE_RE = rf"(?is)^<title{_NAME_END}{_ATTRS}(?:>(.*)|\z)"
MARK_RE = r"(?i)^</?(?:select|svg|math)(?=[\s/>])"
ATTR_RE = r"""([^\s/>=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?"""
_WS_TRIM_RE = r"^\p{IsWhite_Space}+|\p{IsWhite_Space}+$"

# Entity tokens.  Decimal references need two digits or a ';' (a one-digit reference without ';'
# stays literal in the reference's decoder); hex references need one digit.
_NUM = r"#[xX][0-9a-fA-F]+;?|#[0-9]{2,};?|#[0-9];"
TEXT_ENTITY_RE = rf"&(?:{_NUM}|[A-Za-z0-9]+;?)"
# attribute values: a name without ';' directly followed by '=' is left alone
ATTR_ENTITY_RE = rf"&(?:{_NUM}|[A-Za-z0-9]+(?:;|(?!=)))"
FREQUENT_ENTITIES = ("amp", "lt", "gt", "quot", "nbsp", "apos")
_LEGACY_MAX = max(len(k) for k in html.entities.html5 if not k.endswith(";"))


def _named_map() -> Column:
    """HTML5 named references (name incl. ';' when required -> replacement text)."""
    return F.from_json(F.lit(json.dumps(html.entities.html5, ensure_ascii=True)), "map<string,string>")


def _legacy_map() -> Column:
    """The named references that are also recognised without a trailing ';'."""
    legacy = {k: v for k, v in html.entities.html5.items() if not k.endswith(";")}
    return F.from_json(F.lit(json.dumps(legacy, ensure_ascii=True)), "map<string,string>")


def _cp1252_map() -> Column:
    """Numeric references 0x80-0x9F are read as Windows-1252 (undefined bytes map to themselves)."""
    m = {}
    for x in range(0x80, 0xA0):
        try:
            m[str(x)] = bytes([x]).decode("cp1252")
        except UnicodeDecodeError:
            m[str(x)] = chr(x)
    return F.from_json(F.lit(json.dumps(m)), "map<string,string>")


def _code_point_char(cp: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")


def _numeric_ref(t: Column, cp1252: Column) -> Column:
    hexd = F.regexp_extract(t, r"^&#[xX]([0-9a-fA-F]+)", 1)
    decd = F.regexp_extract(t, r"^&#([0-9]+)", 1)
    cp = F.when(hexd != "", F.conv(hexd, 16, 10)).otherwise(decd).try_cast("long")
    return let(cp, lambda cp: F.when(cp.between(0x80, 0x9F), F.element_at(cp1252, cp.cast("string")))
               .when(cp.isNull() | (cp == 0) | cp.between(0xD800, 0xDFFF) | (cp > 0x10FFFF), F.lit("\ufffd"))
               .otherwise(_code_point_char(cp)))


def _named_ref(t: Column, attribute: bool, named: Column, legacy: Column) -> Column:
    name = F.substring(t, 2, 1 << 30)
    # the frequent names first: the whole table is a linear search
    full = F.lit(None).cast("string")
    for known in FREQUENT_ENTITIES:
        full = F.when(name == known + ";", _lit(html.entities.html5[known + ";"])).otherwise(full)
    full = F.coalesce(full, F.element_at(named, name))
    if attribute:
        return F.coalesce(full, t)
    # longest semicolon-less prefix (2.._LEGACY_MAX chars, shorter than the token), rest kept verbatim
    hits = F.filter(F.transform(F.sequence(F.lit(2), F.lit(_LEGACY_MAX)), lambda j: F.struct(
        j.alias("j"), F.element_at(legacy, F.substring(t, 2, 1 << 30).substr(F.lit(1), j)).alias("v"))),
        lambda h: h["v"].isNotNull() & (h["j"] <= F.length(t) - 2))
    fallback = let(F.element_at(hits, -1), lambda h: F.concat(h["v"], t.substr(h["j"] + 2, F.lit(1 << 30))))
    return F.coalesce(full, F.when(F.size(hits) > 0, fallback), t)


def html_unescape(c: Column, attribute: bool = False) -> Column:
    """Decode character references the way an HTML5 tokenizer does (text or attribute mode)."""
    pat = ATTR_ENTITY_RE if attribute else TEXT_ENTITY_RE
    named, legacy, cp1252 = _named_map(), _legacy_map(), _cp1252_map()

    def body(v):
        toks = F.transform(F.regexp_extract_all(v, F.lit(pat), 0), lambda t: F.when(
            t.startswith("&#"), _numeric_ref(t, cp1252)).otherwise(_named_ref(t, attribute, named, legacy)))
        pieces = F.split(v, pat, -1)
        rest = F.zip_with(toks, F.slice(pieces, 2, 1 << 30), lambda a, b: F.concat(a, b))
        return F.when(~v.contains("&"), v).otherwise(F.concat(F.get(pieces, 0), F.array_join(rest, "")))

    return let(c, body)


def convert_newlines(c: Column) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


def trim_space(c: Column) -> Column:
    return F.regexp_replace(c, _WS_TRIM_RE, "")


def clean_text(c: Column) -> Column:
    """Unicode-whitespace trim, then HTML unescape."""
    return html_unescape(trim_space(c))


def tokens(body: Column) -> Column:
    """The lexer: ARRAY<STRING> of the titles, start tags and marks of a body in document order, in one pass."""
    return F.filter(F.regexp_extract_all(body, _lit(TOKEN_RE), 2), lambda x: x != "")


def token_name(token: Column) -> Column:
    return F.lower(F.regexp_extract(token, r"^</?([^\s/>]+)", 1))


def effective_tokens(found: Column) -> Column:
    """The tokens whose elements a tree builder makes: in a ``select`` only scripts, and no ``image`` in ``svg`` or ``math``.

    A fold over the tokens with two states; bodies without such elements, nearly all, go through as they are.
    ``img``, ``meta`` and ``h1`` end foreign content, ``input``, ``keygen`` and another ``select`` end a ``select``.
    """
    start = F.struct(F.lit(False).alias("inside"), F.lit(0).alias("foreign"), F.array().cast("array<string>").alias("kept"))

    def step(state, t):
        name, ends = token_name(t), t.startswith("</")
        inside, foreign = state["inside"], state["foreign"]
        is_foreign = name.isin("svg", "math")
        dropped = is_foreign | name.isin("select", "input", "keygen") | (inside & (name != "script")) | ((foreign > 0) & (name == "image"))
        return F.struct(
            F.when(name == "select", ~ends & ~inside).when(name.isin("input", "keygen"), _lit(False)).otherwise(inside).alias("inside"),
            F.when(inside, foreign).when(is_foreign & ends, F.greatest(foreign - 1, F.lit(0)))
            .when(is_foreign & ~t.rlike("/>$"), foreign + 1).when(name.isin("img", "meta", "h1"), F.lit(0)).otherwise(foreign).alias("foreign"),
            F.when(dropped, state["kept"]).otherwise(F.concat(state["kept"], F.array(t))).alias("kept"))

    return F.when(F.exists(found, lambda t: t.rlike(MARK_RE)), F.aggregate(found, start, step, lambda s: s["kept"])).otherwise(found)


def start_tags(found: Column) -> Column:
    """ARRAY<STRUCT<name, keys ARRAY<STRING>, vals ARRAY<STRING>>> of the relevant start tags among the tokens."""
    raw = F.filter(found, lambda t: token_name(t).isin(*TARGET_TAGS))

    def to_struct(t):
        name = token_name(t)
        rest = F.regexp_replace(t, r"^<[^\s/>]+", "")
        keys = F.transform(F.regexp_extract_all(rest, _lit(ATTR_RE), 1), lambda k: F.lower(k))
        vals = F.transform(F.regexp_extract_all(rest, _lit(ATTR_RE), 2), lambda v: html_unescape(
            convert_newlines(F.regexp_replace(v, r"""(?s)^"(.*)"$|^'(.*)'$""", "$1$2")), attribute=True))
        return F.struct(F.when(name == "image", F.lit("img")).otherwise(name).alias("name"),
                        keys.alias("keys"), vals.alias("vals"))

    return F.transform(raw, to_struct)


def extract_tags(html_body: Column) -> Column:
    """X1 on a raw body."""
    return start_tags(effective_tokens(tokens(html_body)))


def attr_pairs(tag: Column) -> Column:
    """ARRAY<STRUCT<k, v>> of one tag struct's attributes."""
    return F.arrays_zip(tag["keys"].alias("k"), tag["vals"].alias("v"))


def pair_values(pairs: Column, key: str, non_empty: bool = True) -> Column:
    """All values of attribute ``key`` among zipped attribute pairs, in attribute order."""
    hit = F.filter(pairs, (lambda p: (p["k"] == key) & (p["v"] != "")) if non_empty else (lambda p: p["k"] == key))
    return F.transform(hit, lambda p: p["v"])


def attr_values(tag: Column, key: str, non_empty: bool = True) -> Column:
    """All values of attribute ``key`` on one tag struct, in attribute order."""
    return pair_values(attr_pairs(tag), key, non_empty)


def last_attr(tag: Column, key: str) -> Column:
    vals = attr_values(tag, key, non_empty=False)
    return F.when(F.size(vals) > 0, F.element_at(vals, -1))


def srcset_first(v: Column) -> Column:
    """First candidate of a srcset: text before the first ',', trimmed, up to the first space."""
    return F.substring_index(trim_space(F.substring_index(v, ",", 1)), " ", 1)


def css_urls(style: Column) -> Column:
    """Every ``url(...)`` in an inline style, stripped of quotes and blanks; empties dropped."""
    trim_re = "^[" + CSS_URL_TRIM.replace("\t", r"\t").replace("\n", r"\n").replace("\r", r"\r") + "]+|[" \
        + CSS_URL_TRIM.replace("\t", r"\t").replace("\n", r"\n").replace("\r", r"\r") + "]+$"
    urls = F.transform(F.regexp_extract_all(style, F.lit(r"url\(([^)]*)\)"), 1),
                       lambda u: F.regexp_replace(u, trim_re, ""))
    return F.filter(urls, lambda u: u != "")


def asset_type(url: Column) -> Column:
    """Asset type from URL text (substring match, first family wins, default image)."""
    low = F.lower(url)

    def any_of(exts):
        cond = _lit(False)
        for e in exts:
            cond = cond | low.contains(e)
        return cond

    return F.when(low.startswith("data:image/"), _lit("image")) \
        .when(any_of(IMAGE_EXTENSIONS), _lit("image")) \
        .when(any_of(SCRIPT_EXTENSIONS), F.lit("script")) \
        .when(any_of(STYLE_EXTENSIONS), F.lit("style")) \
        .otherwise(_lit("image"))


detect_asset_type = asset_type


def media_of(content_type: Column) -> Column:
    """S6: 'html' | 'xml' | 'other' by case-sensitive substring of the Content-Type header."""
    is_xml = _lit(False)
    for m in XML_MEDIA_TYPES:
        is_xml = is_xml | content_type.contains(m)
    return F.when(F.coalesce(content_type.contains(HTML_MEDIA_TYPE), _lit(False)), F.lit("html")) \
        .when(F.coalesce(is_xml, _lit(False)), F.lit("xml")).otherwise(F.lit("other"))


def cap_text_bytes(body: Column, cap: int) -> Column:
    """S5, only where a caller asks for a cut: the longest whole-character prefix of the body whose UTF-8 encoding fits in ``cap`` bytes.

    The byte cut is decoded with ``make_valid_utf8``; a character split by the cut comes out as
    U+FFFD and is dropped (the reference keeps the raw partial bytes, which only ever touch the
    last character of a 10 MiB body).
    """
    def cut(v):
        head = F.make_valid_utf8(F.substring(F.encode(v, "UTF-8"), 1, cap).cast("string"))
        return let(head, lambda h: F.when(v.startswith(h), h).otherwise(F.regexp_replace(h, "\ufffd+$", "")))

    return F.when(F.octet_length(body) > cap, let(body, cut)).otherwise(body)


def seo_title(found: Column) -> Column:
    """X5 title: STRUCT<has_title, title>: last title element with any text, decoded twice and trimmed."""
    titles = F.filter(found, lambda t: t.rlike(r"(?i)^<title(?=[\s/>])"))
    texts = F.filter(F.transform(titles, lambda t: F.regexp_extract(t, TITLE_RE, 1)), lambda t: t != "")
    return let(texts, lambda ts: F.struct(
        (F.size(ts) > 0).alias("has_title"),
        F.when(F.size(ts) > 0, html_unescape(trim_space(html_unescape(convert_newlines(F.element_at(ts, -1))))))
        .otherwise(_lit("")).alias("title")))


def seo_description(tags: Column) -> Column:
    """X5 description: STRUCT<has_description, description> from the last qualifying meta tag."""
    metas = F.filter(tags, lambda t: (t["name"] == "meta")
                     & (F.lower(F.coalesce(last_attr(t, "name"), _lit(""))) == "description")
                     & (F.coalesce(last_attr(t, "content"), _lit("")) != ""))
    return let(metas, lambda ms: F.struct(
        (F.size(ms) > 0).alias("has_description"),
        F.when(F.size(ms) > 0, html_unescape(trim_space(last_attr(F.element_at(ms, -1), "content"))))
        .otherwise(_lit("")).alias("description")))


def seo_has_h1(found: Column) -> Column:
    """The lexer lists an h1 only where a child follows it."""
    return F.exists(found, lambda t: t.rlike(r"(?i)^<h1(?=[\s/>])"))


def seo_xml_title(body: Column) -> Column:
    """STRUCT<has_title, title>: first literal <title>...</title> after the first literal <channel>."""
    def after(text: Column, mark: str) -> Column:
        at = F.instr(text, mark)
        return F.when(at > 0, text.substr(at + len(mark), F.length(text)))

    # three searches one behind the other: linear however often the marks repeat
    title = after(after(body, "<channel>"), "<title>")
    return let(F.when(F.instr(title, "</title>") > 0, F.substring_index(title, "</title>", 1)), lambda t: F.struct(
        t.isNotNull().alias("has_title"), F.coalesce(html_unescape(trim_space(t)), _lit("")).alias("title")))
