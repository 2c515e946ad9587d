"""The registered queries' own columns (hex digests, spans as text, checksums) over odd documents, by brute force."""
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from barlake.llm.queries import QUERIES
from tests.llm.test_simhash import brute_components, brute_print

ODD = ["a.b@c.de, A_b%+-@x-y.z.org.", "x@y", "1.2.3.4 256.1.1.1 10.0.0.255", "4111 1111 1111 1111 and 4111111111111112",
       "call +1 (555) 010-9999 now", "+123", "é +49 30 1234567", "a@b.c a@b.c", "<|endoftext|> x", "  \t ", "　wide　",
       "no data", "😀 a@b.co 😀 1.1.1.1", "a" * 3000 + "@" + "b" * 3000 + ".c", "1" * 500, None, "", "same words here", "same words here"]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    rows = [(7 * k - 20, t, "en", "s", 0 if t is None else len(t)) for k, t in enumerate(ODD)]
    folder = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3) \
        .write.parquet(f"{folder}/documents.parquet")
    return folder, {r[0]: r[1] or "" for r in rows}


def test_op4(spark, odd):
    folder, texts = odd
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, want = 0, set()
    for i in sorted(texts):
        ids = [*tokenizer.encode(texts[i], add_special_tokens=False).ids, 0]
        want.add((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = QUERIES["op4_token_records"](spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert set(map(tuple, got.collect())) == want


def test_op8(spark, odd):
    folder, texts = odd
    prints = {i: brute_print(t) for i, t in texts.items()}
    groups = brute_components(set(prints.values()))
    want = {(i, f"{p:016x}", min(j for j, q in prints.items() if q in groups[p])) for i, p in prints.items()}
    got = QUERIES["op8_simhash_near_dedup"](spark, folder).select("doc_id", "fingerprint", "component_id")
    assert set(map(tuple, got.collect())) == want


def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    def found(pattern, good=lambda m: True):
        return [m.span() for m in re.finditer(pattern, text) if good(m)]

    def digits(m):
        return re.sub("[^0-9]", "", m[0])
    return [("email", found(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
            ("ip", found(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split(".")))),
            ("card", found(r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m)))),
            ("phone", found(r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15))]


def test_op10(spark, odd):
    folder, texts = odd
    rows = {r["doc_id"]: r for r in QUERIES["op10_pii"](spark, folder).collect()}
    assert set(rows) == set(texts) and sum(r["n_email"] for r in rows.values()) > 4
    for i, text in texts.items():
        spans, r = base_spans(text), rows[i]
        for kind, own in spans:
            assert r[f"n_{kind}"] == len(own), (i, kind)
        joined = [f"{kind}:{a}:{z}" for kind, own in spans for a, z in own]
        assert r["base_sha256"] == hashlib.sha256(",".join(joined).encode()).hexdigest(), i
        assert set(joined) <= set(r["spans"].split(","))
