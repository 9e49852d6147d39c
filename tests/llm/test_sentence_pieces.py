import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from sitelens.llm import queries, sentence_pieces as sp
from tests.llm import cases

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as f:
        return sp.Model(f.read())


def texts(seed=1, n=400):
    r = random.Random(seed)
    words = ["the", "Running", "naïve", "été", "12345", "x=1;", "  ", "\n\n", "日本語", "ไทย", "😀👩‍👩‍👧", "\x00", "a" * 50, " ", "▁", "▁▁x", "<s>", "<0x41>", "ÿ", "\t", "�", "Ω≈ç"]
    out = ["", " ", "  ", "\n", "a", " a", "a ", "▁", " ▁ ", "日本", "x" * 3000, "ab " * 3000, "日本語の文" * 500]
    out += [r.choice(["", " "]).join(r.choice(words) for _ in range(r.randrange(30))) for _ in range(n)]
    return out + ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(0xA0, 0x800), r.randrange(0x4E00, 0x9FFF), r.randrange(0x1F300, 0x1F700)]))
                          for _ in range(r.randrange(60))) for _ in range(n)]


def test_ids_and_text_equal_the_library(model, library):
    for text in texts():
        ids = model.encode(text)[0].tolist()
        assert ids == library.encode(text), text
        assert model.decode(ids) == library.decode(ids)


def test_spans_equal_the_library(model, library):
    for text in texts(2, 150):
        proto = library.encode(text, return_type="proto")
        ends = model.encode(text)[1].tolist()
        assert ends == [p.end for p in proto.pieces], text
        assert [0, *ends][:len(ends)] == [p.begin for p in proto.pieces]


def test_decoding_any_ids_equals_the_library(model, library):
    r = random.Random(5)
    for _ in range(1500):
        ids = [r.choice([r.randrange(32000), r.randrange(260), 0, 1, 2, 29871]) for _ in range(r.randrange(12))]
        assert model.decode(ids) == library.decode(ids), ids
    with pytest.raises(IndexError):
        model.decode([32000])


def test_compiled_character_maps_against_the_library():
    for rule in ("nmt_nfkc", "nfkc", "nmt_nfkc_cf", "nfkc_cf"):
        for extra in (True, False):
            theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=extra)
            spec = dict(sp.fields(dict(sp.fields(theirs.serialized_model_proto()))[sp.NORMALIZER]))
            ours = sp.Normalizer(spec[sp.CHARSMAP], True, extra, True, False, [])
            for text in [*texts(3, 60), "  Ａ ｂ ﬁ  ①ガ  ", "é ", "　x", "Ⅷ­½"]:
                data, source = ours.normalize(text)
                want, offsets = theirs.normalize(text, with_offsets=True)
                assert data.decode() == want, (rule, text)
                assert len(source) == len(data) + 1 and source == sorted(source) and source[-1] <= len(text.encode())


def test_long_texts_go_in_parts(model, library, monkeypatch):
    text = " ".join(texts(4, 60))
    monkeypatch.setattr(sp, "LONG_TEXT", 50)
    monkeypatch.setattr(sp, "SEGMENTS_AT_ONCE", 7)
    ids, ends = model.encode(text.replace("▁", "_"))
    assert ids.tolist() == library.encode(text.replace("▁", "_")) and ends[-1] == len(text.replace("▁", "_").encode())


def test_cache_is_bounded_in_bytes(model, monkeypatch):
    monkeypatch.setattr(sp, "CACHE_BYTES", 50_000)
    for k in range(600):
        model.encode(f"word{k} other{k}")
        assert model.cached <= 52_000 and sum(len(s) + len(a) + len(b) for s, (a, b) in model.cache.items()) <= model.cached


def test_unknown_unused_and_user_defined_pieces():
    """A small model made by hand: without byte fallback unknown neighbours are one id, unused pieces fall apart, symbols stay whole."""
    def field(number, value):
        if isinstance(value, int):
            return bytes([*varint(number << 3), *varint(value)])
        if isinstance(value, float):
            import struct
            return bytes(varint(number << 3 | 5)) + struct.pack("<f", value)
        return bytes(varint(number << 3 | 2)) + bytes(varint(len(value))) + value

    def varint(n):
        while n > 127:
            yield n & 127 | 128
            n >>= 7
        yield n

    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), ("<sep>", 0.0, 4), ("ab", -1.0, 5), ("abc", -2.0, 1), ("▁a", -3.0, 1)]
    pieces += [(c, -10.0 - k, 1) for k, c in enumerate("▁abc")]
    blob = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in pieces)
    blob += field(2, field(3, 2)) + field(3, field(1, b"identity") + field(3, 1) + field(4, 0) + field(5, 1))
    own, library = sp.Model(blob), sentencepiece.SentencePieceProcessor(model_proto=blob)
    r = random.Random(9)
    for _ in range(500):
        text = "".join(r.choice(["a", "b", "c", "ab", "abc", " ", "z", "é", "<sep>"]) for _ in range(r.randrange(14)))
        ids, ends = own.encode(text)
        assert ids.tolist() == library.encode(text), text
        assert own.decode(ids.tolist()) == library.decode(ids.tolist()), text
        assert ends.tolist() == [p.end for p in library.encode(text, return_type="proto").pieces]


def test_odd_documents_and_empty_table(spark, library, tmp_path):
    rows = cases.odd_rows()
    got = sp.decode(sp.encode(cases.odd_docs(spark), PATH), PATH).collect()
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in got) == sorted(
        (str(d), library.encode(t or ""), library.decode(library.encode(t or ""))) for d, t, *_ in rows)
    assert sp.encode(cases.no_docs(spark), PATH).collect() == []
    spark.createDataFrame(rows, cases.SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    digests = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op13(spark, str(tmp_path)).collect()}
    assert digests == {(d, len(i := library.encode(t or "")), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(),
                        hashlib.sha256(library.decode(i).encode()).hexdigest()) for d, t, *_ in rows}
