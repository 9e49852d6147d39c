"""The operators as queries over the given tables, with production parameters, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm import (automaton_dedup, bpe, common, decontaminate, exact_dedup, language_id, prefix_trie, run_index_dedup,
                          secrets, sentence_pieces, simhash, spelling_variants, toxicity, url_filter)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


def ranks_path(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


@query("op2_exact_dedup", r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
     w AS (SELECT *, first_value(doc_id) OVER g AS keep_id,
                  count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d
           WINDOW g AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of all documents through a fresh digest index."""
    return exact_dedup.decisions(common.table(spark, sf_dir, "documents"))


@query("op10_byte_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of all documents: ids and the decoded bytes, as digests."""
    ranks = ranks_path()
    encoded = bpe.encode(common.table(spark, sf_dir, "documents"), ranks, split_pattern())
    return bpe.digests(bpe.decode(encoded, ranks))


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learned from the labels that are not held out."""
    docs = common.table(spark, sf_dir, "documents")
    return toxicity.predict(docs, toxicity.fit(docs, common.table(spark, sf_dir, "labels")))


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents by the byte convolutional network."""
    docs = common.table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs))


@query("op6_simhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and components of all documents."""
    return simhash.report(common.table(spark, sf_dir, "documents"))


@query("op1_decontaminate")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a document and a benchmark item that it contains."""
    return decontaminate.find(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


@query("op7_secrets")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents, with linked weak candidates."""
    return secrets.report(common.table(spark, sf_dir, "documents"))


#: Host and path rules of the URL filter.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


@query("op9_url_filter")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all page URLs."""
    return url_filter.judge(common.table(spark, sf_dir, "pages"), URL_RULES)


@query("op3_suffix_array_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal of repeated 100-byte strings from all documents by run-length indexes."""
    out = run_index_dedup.remove_repeated_bytes(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_substring_dedup", r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
           FROM documents),
     s AS (SELECT doc_id, w, unnest(CASE WHEN len(w) >= 13 THEN range(1, len(w) - 11) ELSE [] END) AS i FROM d),
     g AS (SELECT doc_id, i, list_aggregate(w[i:i + 12], 'string_agg', ' ') AS t FROM s),
     r AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY t) < doc_id AS again FROM g),
     c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM r WHERE again),
     l AS (SELECT doc_id, list(p) AS gone FROM c GROUP BY doc_id),
     k AS (SELECT d.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
                  coalesce(array_to_string(list_filter(w, lambda x, p: NOT list_contains(coalesce(gone, []), p)), ' '), '') AS kept
           FROM d LEFT JOIN l ON l.doc_id = d.doc_id)
SELECT doc_id, n_words, n_removed, sha256(kept) AS kept_sha256 FROM k""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal of repeated 13-word windows from all documents by suffix automata."""
    out = automaton_dedup.remove_repeated_words(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: crc32 of a short text of characters below 256, bit by bit.
CRC32_SQL = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split({0}, ''), lambda ch:
                      CASE WHEN unicode(ch) < 128 THEN [CAST(unicode(ch) AS BIGINT)]
                           ELSE [192 + unicode(ch) // 64, CAST(128 + unicode(ch) % 64 AS BIGINT)] END))),
    lambda a, b: list_reduce(list_concat([xor(a, b)], CAST(range(8) AS BIGINT[])),
                          lambda v, k: xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""


@query("op11_prefix_trie", f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
     c AS (SELECT conv_id, list({{'k': sha256(length(role) || ':' || role || text), 'n': length(text)}}
                                ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS own FROM t GROUP BY conv_id),
     h AS (SELECT *, {CRC32_SQL.format('CAST(conv_id AS VARCHAR)')} % 6 AS h FROM c),
     r AS (SELECT h.conv_id, list_concat(coalesce(b.own, [])[1:h.h], h.own[h.h + 1:]) AS path
           FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 100),
     p AS (SELECT conv_id, len(path) AS last, d, array_to_string(list_transform(path[1:d], lambda x: x.k), ',') AS node,
                  array_to_string(list_transform(path[1:d - 1], lambda x: x.k), ',') AS above, coalesce(path[d].n, 0) AS n
           FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM r) u),
     m AS (SELECT d, node, any_value(above) AS above, any_value(n) AS n, min(conv_id) AS conv_id, count(*) AS n_convs,
                  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last = d), '')) AS ends_sha256
           FROM p GROUP BY d, node),
     k AS (SELECT m.*, a.conv_id AS parent_conv_id, (SELECT count(*) FROM m b WHERE b.d = m.d + 1 AND b.above = m.node) AS n_children
           FROM m LEFT JOIN m a ON a.d = m.d - 1 AND a.node = m.above),
     s AS (SELECT a.d, a.node, sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((b.n_convs - 1) * b.n) AS saved_tokens
           FROM k a JOIN k b ON b.d >= a.d AND (a.d = 0 OR starts_with(b.node, a.node)) GROUP BY a.d, a.node)
SELECT conv_id, k.d AS depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM k JOIN s ON s.d = k.d AND s.node = k.node""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return prefix_trie.report(common.table(spark, sf_dir, "conversations"))


@query("op12_spelling_variants", f"""
WITH RECURSIVE r AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
                                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
     u AS (SELECT doc_id, run, count(*) AS k FROM r WHERE length(run) >= 5 GROUP BY doc_id, run),
     h AS (SELECT run, k, {CRC32_SQL.format("doc_id || ':' || run")} AS h FROM u),
     w AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
                       ELSE run END AS word, k FROM h),
     v AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
     x AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
     d AS (SELECT DISTINCT word, n, left(word, i - 1) || substr(word, i + 1) AS short FROM x),
     g AS (SELECT word, n, i, left(word, i - 1) || chr(1) || substr(word, i + 1) AS gap FROM x),
     p AS (SELECT d.word, v.word AS near, v.n AS near_n FROM d JOIN v ON v.word = d.short
           UNION ALL SELECT v.word, d.word, d.n FROM d JOIN v ON v.word = d.short
           UNION ALL SELECT a.word, b.word, b.n FROM g a JOIN g b ON a.gap = b.gap AND a.word <> b.word),
     b AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS near, max(near_n) AS near_n FROM p GROUP BY word),
     f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * v.n THEN near END AS form,
                  CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n FROM v LEFT JOIN b ON b.word = v.word),
     c AS (SELECT word, word AS at, form AS next FROM f
           UNION ALL SELECT c.word, c.next, f.form FROM c JOIN f ON f.word = c.next)
SELECT f.word, form, c.at AS root, n, n_near, form_n FROM f JOIN c ON c.word = f.word AND c.next IS NULL""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of the words of all documents."""
    return spelling_variants.report(common.table(spark, sf_dir, "documents"))


@query("op13_sentence_pieces")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of all documents and the decoded texts, as digests."""
    model = ranks_path("piece_bpe_32k.model")
    encoded = sentence_pieces.encode(common.table(spark, sf_dir, "documents"), model)
    return sentence_pieces.digests(encoded, model)
