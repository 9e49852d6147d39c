import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from sitelens.llm import bpe, queries
from tests.llm import cases


@pytest.fixture(scope="module")
def blob():
    with open(queries.ranks_path(), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(blob):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(blob), special_tokens={})


def test_random_texts_like_the_library(blob, library):
    r = random.Random(1)
    alphabets = ["ab", "aAbBéñ", "abcdefghij", " \n", "thanerinon", "a", "日本語", "a b's 12 \n", "the   \x1f\x85 x", "\t \r\n'll"]
    texts = ["".join(r.choice(a) for _ in range(r.randrange(200))) for a in alphabets for _ in range(150)]
    encoder = bpe.Encoder(blob, public_tokenizers.PATTERN)
    for text, ids in zip(texts, encoder.batch(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), text


def test_long_pieces_join_up_the_tree(blob, library):
    tree = bpe.TreeBpe(bpe.parse_ranks(blob))
    r = random.Random(2)
    for text in ("a" * 5001, "ab" * 3000, "".join(r.choice("thaneriop") for _ in range(5000)), "é" * 3001):
        ids = tree.piece(text.encode())
        assert ids == library.encode_ordinary(text)
        assert tree.decode(ids) == text.encode()
        assert tree._merge_heap(text.encode()[:600]) == tree._merge_list(text.encode()[:600])


def test_merge_many_is_merge(blob):
    tree = bpe.TreeBpe(bpe.parse_ranks(blob))
    r = random.Random(3)
    leaves = [bytes(r.choice(b"thaneriop \xc3\xa9") for _ in range(r.randrange(1, 17))) for _ in range(2000)]
    assert tree.merge_many(leaves) == [tree.merge(x) for x in leaves]


def test_caches_are_bounded_in_bytes(blob, library, monkeypatch):
    """Texts without blanks, thousands of different long cuts: caches stay within their bytes, ids stay right."""
    monkeypatch.setattr(bpe, "CACHED_BYTES", 200_000)
    r = random.Random(4)
    alphabet = "日本語文字列漢字仮名交文章一二三四五六七八九十。、abcdefghij0123456789"
    encoder = bpe.Encoder(blob, public_tokenizers.PATTERN)
    largest = 0
    for _ in range(60):
        texts = ["".join(r.choices(alphabet, k=r.choice((30, 900, 3000)))) for _ in range(20)] + ["short words here", "a" * 2000 + " b"]
        for text, ids in zip(texts, encoder.batch(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert max(map(len, encoder.cut)) <= bpe.LONGEST_CUT
        held = sum(len(k.encode()) + len(v or b"") for c in (encoder.cut, encoder.piece) for k, v in c.items())
        held += sum(len(k) + 36 * len(v) for k, v in encoder.bpe._nodes.items())
        largest = max(largest, held)
    one_batch = 20 * 3000 * 3
    assert largest < 3 * (200_000 + 4 * one_batch)
    assert encoder.cut_bytes < 200_000 + 4 * one_batch


def test_slices_bound_texts_and_characters(monkeypatch):
    monkeypatch.setattr(bpe, "TEXTS_AT_ONCE", 3)
    monkeypatch.setattr(bpe, "CHARACTERS_AT_ONCE", 10)
    texts = ["a" * n for n in (1, 1, 1, 1, 9, 2, 30, 0, 0, 10)]
    assert list(bpe.slices(texts)) == [(0, 3), (3, 5), (5, 6), (6, 7), (7, 10)]
    assert list(bpe.slices([])) == []


def test_odd_documents(spark, library):
    docs = cases.odd_docs(spark)
    got = bpe.digests(bpe.decode(bpe.encode(docs, queries.ranks_path(), public_tokenizers.PATTERN), queries.ranks_path())).collect()
    expected = []
    for doc_id, text, *_ in cases.odd_rows():
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        expected.append((doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    lists = bpe.encode(docs, queries.ranks_path(), public_tokenizers.PATTERN, lists=True).collect()
    assert sorted(len(r.token_ids) for r in lists) == sorted(e[1] for e in expected)
    assert bpe.encode(cases.no_docs(spark), queries.ranks_path(), public_tokenizers.PATTERN).collect() == []
