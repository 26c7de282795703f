"""Piece ids, spans and decoding against the library that the model files are made for."""

from __future__ import annotations

import hashlib
import random
import struct

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece as spm

from lakewright.llm import pieces
from lakewright.llm.words import text_bytes

ODD = [
    "", " ", "   ", " a", "a ", "a  b", "\n\n\t x  ", "▁x ▁▁ y▁", "é☃漢字 𝒳 z", "🎉🎉́", "x" * 300, "<0x41><s></s><unk>", "�￾", "1234567.89",
    "ﬁ ½ Å é ｶﾞ ㌀ Ⅻ ﷺ x́̂", "ＡＢＣ１２３　ｘ", "ein Tag, zwei Wörter — drei", "don't   stop\r\nnow\x0b!", "a" * 49 + "b" * 60, "☃",
]


def varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def field(number: int, value: int | bytes) -> bytes:
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def rules_of(name: str, **flags) -> bytes:
    """The normaliser's part of a model file that follows one of the library's rules."""
    made = spm.SentencePieceNormalizer(rule_name=name, **flags).serialized_model_proto()
    return next(v for n, v in pieces._fields(made) if n == 3)


def same_as_library(data: bytes, texts: list[str]) -> None:
    theirs, mine = spm.SentencePieceProcessor(model_proto=data), pieces.Coder(data)
    cuts, *found = mine.encode(*text_bytes(pa.array(texts, pa.string())))
    for text, a, b in zip(texts, cuts, cuts[1:], strict=False):
        ids, begins, ends = (x[a:b].tolist() for x in found)
        assert ids == theirs.encode(text, add_eos=True), text
        assert mine.decode(np.array(ids)) == theirs.decode(ids), text
        raw, proto = text.encode(), theirs.encode(text, return_type="proto")
        assert [raw[x:y].decode() for x, y in zip(begins[:-1], ends, strict=False)] == [p.surface for p in proto.pieces], text
        assert list(zip(begins[:-1], ends, strict=False)) == [(p.begin, p.end) for p in proto.pieces], text
        assert begins[-1] == ends[-1] == len(raw)


@pytest.fixture(scope="module")
def model():
    return pieces.Model.read()


@pytest.fixture(scope="module")
def corpus(spark):
    return [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]


def test_encode(model, corpus):
    same_as_library(model.data, ODD + corpus)


@pytest.mark.parametrize("flags", [{}, {"remove_extra_whitespaces": False}, {"add_dummy_prefix": False}])
@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nmt_nfkc_cf"])
def test_other_normalisers(model, corpus, rule, flags):
    same_as_library(model.data + field(3, rules_of(rule, **flags)), ODD + corpus[:40])


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nfkc_cf"])
def test_character_map(rule, corpus):
    off = {"add_dummy_prefix": False, "escape_whitespaces": False, "remove_extra_whitespaces": False}
    compiled = dict(pieces._fields(rules_of(rule, **off)))[2]
    library, mine = spm.SentencePieceNormalizer(rule_name=rule, **off), pieces.CharacterMap(compiled)
    draw = random.Random(5)
    for text in ODD + corpus[:20] + ["".join(draw.choices("eéêa ́̂̈ｶﾞ㌀Å½ﬁ가각\t", k=40)) for _ in range(200)]:
        data = np.frombuffer(text.encode(), np.uint8)
        out, origin = mine.replaced(data)
        said, places = library.normalize(text, with_offsets=True)
        assert out.tobytes().decode() == said
        begins = [*np.flatnonzero((out & 0xC0) != 0x80), len(out)]
        assert [len(text.encode()[: origin[b]].decode()) for b in begins] == list(places)


def hand_made(byte_fallback: bool, tie: bool = False) -> bytes:
    """A small model written by hand."""
    kinds = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)]
    kinds += [(f"<0x{b:02X}>", 0, 6) for b in range(256)] if byte_fallback else []
    scores = {"▁": -9, "a": -10, "b": -11, "c": -12, "ab": -1, "bc": -1 if tie else 0, "▁ab": -3, "abc": -4, "aa": -2, "aaa": -2.5}
    kinds += [(p, s, 1) for p, s in scores.items()]
    out = b"".join(field(1, field(1, p.encode()) + varint(2 << 3 | 5) + struct.pack("<f", s) + field(3, k)) for p, s, k in kinds)
    return out + field(2, field(3, 2) + field(35, int(byte_fallback))) + field(3, field(1, b"identity") + field(3, 1) + field(4, 0))


@pytest.mark.parametrize("fallback", [True, False])
@pytest.mark.parametrize("tie", [True, False])
def test_small_models(fallback, tie):
    draw = random.Random(3)
    texts = ["".join(draw.choices("abc abc xé☃", k=draw.randrange(30))) for _ in range(300)] + ["a" * 200, "ab" * 100 + "c", "", "xx", "x y"]
    same_as_library(hand_made(fallback, tie), texts)


def test_together_or_alone(model):
    """Merging many words at once, one by one and by a heap gives the same symbols."""
    coder, draw = model.coder, random.Random(1)
    words = ["".join(draw.choices("▁theranding", k=draw.randrange(1, 30))) for _ in range(500)]
    symbols, of = coder.merged(words)
    for i, word in enumerate(words):
        assert symbols[of == i].tolist() == coder.merged_long(word) == coder.merged([word])[0].tolist()


def test_remembering_has_no_effect(model, monkeypatch):
    data, at = text_bytes(pa.array(ODD, pa.string()))
    want = model.coder.encode(data, at)
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    coder = pieces.Coder(model.data)
    for a in range(len(ODD)):
        cuts, ids, *_ = coder.encode(data[at[a] : at[a + 1]], np.array([0, at[a + 1] - at[a]]))
        assert ids.tolist() == want[1][want[0][a] : want[0][a + 1]].tolist()


def test_decode_any_ids(model):
    library, draw = spm.SentencePieceProcessor(model_proto=model.data), random.Random(1)
    for _ in range(2000):
        ids = [draw.choice([draw.randrange(32000), draw.randrange(3, 300), draw.randrange(3)]) for _ in range(draw.randrange(12))]
        assert model.coder.decode(np.array(ids, np.int64)) == library.decode(ids)
    with pytest.raises(ValueError):
        model.coder.decode(np.array([32000]))


def test_refused(model):
    with pytest.raises(ValueError):
        pieces.Coder(model.data + field(2, field(3, 1)))
    with pytest.raises(ValueError):
        pieces.Coder(model.data + field(1, field(1, b"mine") + field(3, 4)))


def test_tables(spark, model):
    long = "Wide words walk while winter waits. " * 30_000
    rows = [(1, "one two", "x", 1), (1, "one two", "x", 1), (2, None, None, None), (None, "é ☃", "y", 2), (3, "", "z", 3), (4, long, "z", 4), (5, "☃" * 70_000, "z", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, begins int")
    library = spm.SentencePieceProcessor(model_proto=model.data)
    want = []
    for i, text, *_ in rows:
        ids = library.encode(text or "", add_eos=True)
        want.append((i, ids, library.decode(ids)))
    found = pieces.encode_texts(docs, model)
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in found.collect()), key=str) == sorted(want, key=str)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    short = [(i, len(ids), sha(" ".join(map(str, ids))), sha(text), len(text.encode())) for i, ids, text in want]
    assert sorted(map(tuple, pieces.digests(docs, model).collect()), key=str) == sorted(short, key=str)
    assert pieces.digests(docs.limit(0), model).collect() == []
    again = pieces.decode_ids(found.withColumnRenamed("decoded", "was"), model)
    assert again.where("decoded <> was").count() == 0
    assert [r.decoded for r in pieces.decode_ids(spark.createDataFrame([(None,), ([],)], "ids array<int>"), model).collect()] == [None, ""]
    with pytest.raises(ValueError):
        pieces.decode_ids(found, model)


def test_whole_table(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    library = spm.SentencePieceProcessor(model_proto=model.data)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    found = {r.doc_id: r for r in pieces.digests(docs, model).collect()}
    for r in docs.collect():
        ids = library.encode(r.text or "", add_eos=True)
        mine = found.pop(r.doc_id)
        assert (mine.n_tokens, mine.ids_sha256, mine.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))
    assert not found
