import re
from collections import Counter

from pyspark.sql import functions as F

from barlake.llm import langid as L
from barlake.llm.queries import QUERIES
from barlake.llm.shared import fold_of
from tests.conftest import SF_SMALL


def brute(text):
    c = Counter()
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        w = f"\x01{w}\x01"
        c.update(g for n in (1, 2, 3) for g in (w[i:i + n] for i in range(len(w) - n + 1)) if g != "\x01")
    return c


def spelled(key):
    out = ""
    while key:
        out = chr(key & (1 << 21) - 1) + out
        key >>= 21
    return out


def test_counts_and_distances_match_brute_force():
    texts = ["Ab, c! d'été 12 été", "", "1 2 3", "Straße über alles", "ñandú ñandú"]
    for t in texts:
        keys, counts = L.counted(t)
        assert dict(zip(map(spelled, keys.tolist()), counts.tolist())) == dict(brute(t))

    profiles = {"x": L.profile(*L.counted(texts[0])).tolist(), "y": L.profile(*L.counted(texts[3])).tolist()}
    own = L.profile(*L.counted(texts[4]))
    far = L.Identifier(profiles).distances(own)
    for j, lang in enumerate(("x", "y")):
        at = {g: i for i, g in enumerate(profiles[lang])}
        assert far[j] == sum(abs(i - at[g]) if g in at else L.PROFILE for i, g in enumerate(own.tolist()))


def test_learned_counts_cover_all_training_rows(spark):
    docs = spark.createDataFrame([(1, "aa b", "l1"), (2, "aa", "l1"), (3, "zz", "l2"), (4, "qq", None)],
                                 "doc_id bigint, text string, lang string")
    profiles = L.as_lists(L.learn(docs, F.col("doc_id") < 4))
    whole = brute("aa b aa")
    assert {spelled(k) for k in profiles["l1"]} == set(whole)
    assert spelled(profiles["l1"][0]) == "a" and set(profiles) == {"l1", "l2"}


def test_held_out_accuracy(spark):
    got = QUERIES["op3_language_id"](spark, SF_SMALL)
    true = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang")
    rows = got.join(true, "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(rows) > 20 and sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.95
    assert got.where("score < 0 OR score > 1").count() == 0


def test_edges(edge_docs, edge_rows, no_docs):
    profiles = L.learn(edge_docs.withColumn("lang", F.lit("a")), fold_of("doc_id", 5) != 0)
    got = {(r["doc_id"], r["lang_pred"], r["score"]) for r in L.identify(edge_docs, profiles).collect()}
    assert {g for g in got if g[0] in (100, 101, 102)} == {(i, "und", 0.0) for i in (100, 101, 102)}
    assert {g[1] for g in got if g[0] in (103, 106, 107)} == {"a"}
    nothing = L.learn(no_docs, F.lit(True))
    assert L.identify(edge_docs, nothing).where("lang_pred != 'und'").count() == 0
    assert nothing.count() == 0 and L.identify(no_docs, profiles).count() == 0
    assert L.identify(edge_docs, profiles, carry=("score",)).count() == len(edge_rows)


def test_long_texts_count_as_a_whole(monkeypatch):
    """Words, blanks and letters whose lower case depends on their neighbours, on every slice border."""
    text = "Straße ΟΔΥΣΣΕΥΣ d'été  İstanbul, ΑΣ ΣΑ. x" * 40
    want = dict(brute(text))
    for size in (1, 2, 3, 7, 64, 1000):
        monkeypatch.setattr(L, "LETTERS_AT_ONCE", size)
        keys, counts = L.counted(text)
        assert dict(zip(map(spelled, keys.tolist()), counts.tolist())) == want, size
    monkeypatch.undo()
    long = "".join(f"{w}{' ' if k % 3 else ''}" for k, w in enumerate(["help", "wort", "ñandú", "été"] * 220_000))
    assert len(long) > 3_000_000
    keys, counts = L.counted(long)
    assert dict(zip(map(spelled, keys.tolist()), counts.tolist())) == dict(brute(long))


def test_any_number_of_languages(spark):
    """Blocks of languages give what all of them together give, ties by name included."""
    texts = ["".join(chr(97 + (7 * i + 3 * j * j) % 26) + (" " if j % 5 == 4 else "") for j in range(40)) for i in range(30)]
    rows = [(i, t, f"l{i % 23:02d}") for i, t in enumerate(texts)] + [(90, texts[3], "k"), (91, texts[3], "l03b"), (92, "", "l1")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    profiles = L.learn(docs, F.lit(True))
    lists = L.as_lists(profiles)
    want = {}
    for i, t, _ in rows:
        own = L.profile(*L.counted(t)).tolist()
        far = {lang: sum(abs(k - p.index(g)) if g in p else L.PROFILE for k, g in enumerate(own)) for lang, p in lists.items()}
        want[i] = min((d, lang) for lang, d in far.items())[::-1] if own else ("und", None)
    for at_once in (1, 4, 5000):
        got = L.identify(docs, profiles, at_once=at_once).collect()
        assert {r["doc_id"]: r["lang_pred"] for r in got} == {i: x[0] for i, x in want.items()}, at_once
