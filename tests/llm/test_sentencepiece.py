import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from barlake.llm import sentencepiece as S

PATH = public_tokenizers.path("piece_bpe_32k.model")
CODEC = S.Codec(open(PATH, "rb").read())
OWN = sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_text_and_parity_of_odd_texts():
    rnd = random.Random(3)
    bits = " \n\tab▁é<>s/0x​世界\x00😀Zz\"     "
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 80))) for _ in range(2000)]
    texts += [" " * k for k in range(60)] + ["a" + " " * k + "b" for k in range(60)] + ["<s> </s> <unk> <0x0A>", "q" * 3000]
    ids, same, _ = CODEC.encode(texts)
    assert [x.tolist() for x in ids] == OWN.encode(texts) and all(same)
    assert [CODEC.decode(x) for x in ids] == OWN.decode(OWN.encode(texts))
    assert [e.ids for e in CODEC.whole.encode_batch(texts)] == OWN.encode(texts)
    assert [CODEC.whole.decode(x.tolist(), skip_special_tokens=False) for x in ids] == OWN.decode(OWN.encode(texts))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    ids, same, _ = CODEC.encode([text])
    assert ids[0].tolist() == OWN.encode(text) and same == [True]


def test_a_wrong_model_is_noticed():
    codec = S.Codec(open(PATH, "rb").read())
    codec.own = type("Other", (), {"encode": staticmethod(
        lambda t, num_threads=1: [[0]] * len(t) if isinstance(t, list) else [0]), "piece_to_id": lambda self, p: 0})()
    assert codec.encode(["some words"])[1] == [False]
    assert codec.encode(["x", "more words", "y"])[1] == [False, False, False]


def test_one_wrong_segment_marks_its_texts_only():
    codec = S.Codec(open(PATH, "rb").read())
    right = codec.own

    def encode(text, num_threads=1):
        if isinstance(text, list):
            return [encode(t) for t in text]
        return [0] if "stone" in text else right.encode(text)
    codec.own = type("Other", (), {"encode": staticmethod(encode), "piece_to_id": right.piece_to_id})()
    texts = ["a river", "a stone", "wood ", "stone bridge", "", "two  rivers"]
    assert codec.encode(texts)[1] == [True, False, True, False, True, True]


def field(number, value):
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    if isinstance(value, float):
        return varint(number << 3 | 5) + np.float32(value).tobytes()
    return varint(number << 3 | 2) + varint(len(value)) + value


def test_unigram_model_with_byte_fallback():
    pieces = [("<unk>", 0.0, 2), *[(f"<0x{b:02X}>", -12.0, 6) for b in range(256)], ("▁", -2.0, 1), ("▁ab", -2.5, 1),
              ("a", -3.0, 1), ("b", -3.2, 1), ("abc", -4.0, 1), ("c", -3.1, 1), ("bc", -3.6, 1), ("▁a", -2.8, 1)]
    data = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in pieces)
    data += field(2, field(3, 1) + field(35, 1)) + field(3, field(1, b"identity") + field(4, 0))
    own = sentencepiece.SentencePieceProcessor(model_proto=data)
    codec = S.Codec(data)
    texts = ["abc ab", "a bc cab", "é", "", "  abcabc  ", "ab\ncb"]
    ids, same, _ = codec.encode(texts)
    assert [x.tolist() for x in ids] == own.encode(texts) and all(same)
    assert [codec.decode(x) for x in ids] == texts


@pytest.mark.parametrize("norm", [field(5, 1) + field(3, 1), field(3, 0) + field(4, 0)])
def test_parity_is_compared_whatever_the_normaliser(norm):
    """Space collapsing, or no dummy prefix: no text's parity is taken for granted."""
    pieces = [("<unk>", 0.0, 2), *[(f"<0x{b:02X}>", -12.0, 6) for b in range(256)], ("▁", -2.0, 1),
              ("a", -3.0, 1), ("b", -3.2, 1), ("ab", -2.0, 1), ("▁a", -2.8, 1)]
    data = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in pieces)
    data += field(2, field(3, 1) + field(35, 1)) + field(3, field(1, b"identity") + norm)
    codec = S.Codec(data)
    texts = ["ab a", "b  ab", "", "abab b", "a"]
    ids, same, _ = codec.encode(texts)
    assert same == [x.tolist() == y for x, y in zip(ids, sentencepiece.SentencePieceProcessor(model_proto=data).encode(texts))]
    assert all(same)
    codec.own = type("Other", (), {"encode": staticmethod(
        lambda t, num_threads=1: [[0]] * len(t) if isinstance(t, list) else [0])})()
    assert codec.encode(texts)[1] == [False] * 5


def test_documents(edge_docs, edge_rows, no_docs):
    got = S.encode_documents(edge_docs, PATH).collect()
    want = sorted((str(i), OWN.encode(t or "")) for i, t in edge_rows)
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == want
    assert all(r["round_trip"] and r["parity"] and r["n_tokens"] == len(r["ids"]) for r in got)
    assert all(r["ids_crc32"] == zlib.crc32(np.asarray(r["ids"], "<u4").tobytes()) for r in got)
    assert S.encode_documents(no_docs, PATH).count() == 0


def test_unsupported_models_are_refused():
    with pytest.raises(ValueError):
        S.Model(field(1, field(1, b"x") + field(3, 4)) + field(2, field(3, 2)))
