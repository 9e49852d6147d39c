"""The pipeline's stages against brute force, each on its own input."""

import hashlib
import re

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from sitelens.llm import bpe, common, queries
from tests.llm import cases
from tests.llm.test_decontaminate import brute as brute_leaks
from tests.llm.test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_one_after_the_other(spark):
    docs = common.table(spark, SF, "documents")
    columns, items = docs.columns, [tuple(r) for r in common.table(spark, SF, "benchmark").select("item_id", "text").collect()]
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stage(stage(spark, docs, SF), name)
        rows = docs.collect()
        if name != "byte_bpe":
            assert docs.columns == columns
            assert set(rows) <= set(before) and len(rows) == len({r.doc_id for r in rows})
        if name == "language_id":
            gone = {r.doc_id for r in before} - {r.doc_id for r in rows}
            assert gone == {r.doc_id for r in before if not re.search(r"[^\W\d_]", r.text or "")}
        elif name == "exact_dedup":
            best = {}
            for r in before:
                key = re.sub(r"[\x20\x09-\x0D]", "", r.text)
                best[key] = min(best.get(key, (0, 1 << 60)), (-len(r.text), r.doc_id))
            assert {r.doc_id for r in rows} == {d for _, d in best.values()}
        elif name == "simhash":
            ordered = sorted(before, key=lambda r: r.doc_id)
            roots = brute_components([brute_fingerprint(r.text) for r in ordered])
            assert {r.doc_id for r in rows} == {ordered[k].doc_id for k in set(roots)}
        elif name == "decontaminate":
            leaks = {d for d, _ in brute_leaks([(r.doc_id, r.text) for r in before], items)}
            assert {r.doc_id for r in rows} == {r.doc_id for r in before} - leaks
        else:
            with open(queries.ranks_path(), "rb") as f:
                own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(f.read()), special_tokens={})
            texts = {r.doc_id: r.text for r in before}
            assert len(rows) == len(texts)
            assert all(r.token_ids == own.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.token_ids) for r in rows)
        before = rows


def test_odd_documents_pass_all_stages(spark):
    docs = cases.odd_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stage(stage(spark, docs, SF), name)
    assert docs.count() >= 5


def test_empty_documents_pass_all_stages(spark):
    docs = cases.no_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stage(stage(spark, docs, SF), name)
    assert docs.count() == 0


def test_last_stage_decodes_its_ids(spark):
    """The digest is of the ids' own bytes: the text's for a right encoding, another one for a lossy encoding."""
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    docs = cases.odd_docs(spark).where("doc_id is not null")
    rows = corpus_pipeline.encode(spark, docs, SF).collect()
    assert {r.doc_id: r.decoded_sha256 for r in rows} == {i: digest(t or "") for i, t, *_ in cases.odd_rows() if i is not None}
    with open(queries.ranks_path(), "rb") as f:
        encoder = bpe.Encoder(f.read(), queries.split_pattern())
    values = np.frombuffer(encoder.batch(["one two three"])[0], "<i4")
    assert bpe.decoded_digests(encoder.bpe, values, np.array([0, len(values)])) == [digest("one two three")]
    assert bpe.decoded_digests(encoder.bpe, values, np.array([0, len(values) - 1])) != [digest("one two three")]
