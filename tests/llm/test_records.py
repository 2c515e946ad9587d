import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from barlake.llm import records as R
from barlake.llm import segments as S

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_segments_give_the_ids_of_whole_texts(plain):
    rnd = random.Random(8)
    bits = list(" \n\t\r\x0b\x0c\x1c\x1d\x85\xa0    　'.,0") + [
        "  ", "word", "it's", "'ll", "élan", "12", "😀", "中文", "<|endoftext|>", "​", "ﬁ"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30))) for _ in range(4000)] + ["a" * 5000, " " * 300]
    own = R.Encoder(open(PATH, encoding="utf-8").read())
    got = [np.frombuffer(x, "<u4").tolist() for x in own.cache.encode(texts)]
    assert got == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_runs_give_the_ids_of_single_segments(plain, monkeypatch):
    """Odd Unicode after every white space, in runs of any length; a wrong piece length falls back to single ones."""
    rnd = random.Random(11)
    own = R.Encoder(open(PATH, encoding="utf-8").read())
    spaces = " \n\t\r\x85\xa0\u2003\u3000"
    segments = list({rnd.choice(spaces) * rnd.randint(1, 3) + "".join(
        chr(rnd.choice([rnd.randint(33, 126), rnd.randint(0xa1, 0x2fff), rnd.randint(0x1f300, 0x1f700), 0x200b]))
        for _ in range(rnd.randint(1, 9))) for _ in range(5000)})
    segments = [s for s in segments if not s[-1].isspace() and len(own.cache.split(s)) == 1]
    want = [np.asarray(e.ids, "<u4").tobytes() for e in plain.encode_batch(segments, add_special_tokens=False)]
    assert len(segments) > 3000 and own._segments(segments) == want
    own.piece_bytes = own.piece_bytes + 1
    assert own._segments(segments[:50]) == want[:50]


def test_small_cache_changes_nothing(plain):
    own = R.Encoder(open(PATH, encoding="utf-8").read())
    own.cache.limit = 3
    texts = [f"alpha beta {i % 5} gamma" for i in range(50)]
    want = [np.asarray(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert list(own.cache.encode(texts)) == want and list(own.cache.encode(texts)) == want


def test_columns_give_the_ids_of_whole_texts(monkeypatch):
    """White space of every kind next to each other, added tokens, slices, small groups and a small cache."""
    unchanged = Tokenizer.from_file(PATH)
    rnd = random.Random(12)
    bits = [*R.SPACES, " ", " ", "  ", "\n", "\x1c", "\u200b", "word", "it's", "'ll", "é", "è", "р", "12", "😀", "中文", "、",
            "“x”", "©", ".", ",", "<|endoftext|>", "<|endo"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30))) for _ in range(6000)]
    texts += ["", "a" * 5000, " " * 300, "\u3000 x", "", " after an end", "x\u3000  y", ""]
    want = [e.ids for e in unchanged.encode_batch(texts, add_special_tokens=False)]
    own = R.Encoder(open(PATH, encoding="utf-8").read(), special_as_text=False)
    for size, limit, column in ((1 << 24, 10**6, pa.array(texts)), (700, 50, pa.array(texts, pa.large_string()))):
        monkeypatch.setattr(S, "COLUMN_AT_ONCE", size)
        own.words.limit = own.cache.limit = limit
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(column)] == want
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(column.slice(11, 40))] == want[11:51]
        assert list(own.encode(column.slice(0, 0))) == []
        assert max(map(len, own.words.words.to_pylist())) <= S.CACHE_CHARS
        assert len(own.words.words) == len(own.words.ids) == len(own.words.uses) <= limit


def test_only_distinct_unknown_words_reach_python(plain, monkeypatch):
    """Work per occurrence of a word is what kept the operator over its CPU budget."""
    own = R.Encoder(open(PATH, encoding="utf-8").read(), special_as_text=False)
    asked, encode_many = [], own.words.encode_many
    monkeypatch.setattr(own.words, "encode_many", lambda words: asked.extend(words) or encode_many(words))
    monkeypatch.setattr(own.cache, "split", lambda text: pytest.fail("a text was split in Python"))
    texts = [f"alpha beta{i % 7} gamma\n" * 50 for i in range(300)]
    want = [np.asarray(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert list(own.encode(pa.array(texts))) == want and list(own.encode(pa.array(texts))) == want
    assert sorted(asked) == sorted({"alpha", "\nalpha", " gamma", "\n", *(f" beta{i}" for i in range(7))})


def test_written_and_read_back(spark, edge_docs, edge_rows, plain):
    manifest = R.write_records(edge_docs, PATH)
    got = sorted(R.read_records(spark, manifest, with_ids=True).collect(), key=lambda r: r["start"])
    assert len(got) == len(edge_rows) == manifest.groupBy().sum("docs").first()[0]
    ids = [r["doc_id"] for r in got]
    known = [i for i in ids if i is not None]
    assert ids[:2] == [None, None] and known == sorted(known)
    want = sorted([*plain.encode(t or "", add_special_tokens=False).ids, R.END_ID] for _, t in edge_rows)
    assert sorted(r["ids"] for r in got) == want
    start = 0
    for r in got:
        assert r["start"] == start and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.asarray(r["ids"], "<u4").tobytes())
        start += r["n_tokens"]


def test_shuffled_reads_and_damage(edge_docs):
    file = R.write_records(edge_docs.where("doc_id < 40"), PATH).first()
    order = list(reversed(range(file["docs"])))
    back = list(R.read_at(file["path"], order))
    forth = list(R.read_shard(file["path"], file["docs"]))
    assert [x[0] for x in back] == [x[0] for x in reversed(forth)]
    path = file["path"].removeprefix("file://").removeprefix("file:")
    data = bytearray(open(path, "rb").read())
    data[40] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(ValueError, match="damaged"):
        list(R.read_shard(file["path"], file["docs"]))


def test_empty_table(spark, no_docs):
    assert R.read_records(spark, R.write_records(no_docs, PATH)).count() == 0


def test_strings_of_special_tokens_get_their_ids_as_from_the_unchanged_tokenizer(spark):
    unchanged = Tokenizer.from_file(PATH)
    rnd = random.Random(9)
    bits = ["<|endoftext|>", "<|endoftext|>", "<|endo", "text|>", " ", "  ", "\n", "\u3000", "word", "it's", "12", "é"]
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "", "plain"] + [
        "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 20))) for _ in range(2000)]
    want = [e.ids for e in unchanged.encode_batch(texts, add_special_tokens=False)]
    assert want[0] == [31373, 220, 50256, 995]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = R.read_records(spark, R.write_records(docs, PATH), with_ids=True).collect()
    assert {r["doc_id"]: r["ids"][:-1] for r in got} == dict(enumerate(want))
    starts = np.cumsum([0] + [len(x) + 1 for x in want])
    assert all(r["start"] == starts[r["doc_id"]] for r in got)
