import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.llm import lm as M
from barlake.llm.shared import fold_of


def tokens(t):
    return bytes(t or "", "utf-8").lower().split() + [None]


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0


@pytest.mark.parametrize("keys_per_range, fan", [(1_000_000, 1024), (17, 1024), (300, 3)])
def test_counts_scores_and_chunks_match_brute_force(edge_docs, edge_rows, keys_per_range, fan, monkeypatch):
    monkeypatch.setattr(M, "CHUNK_CHARS", 2000)
    monkeypatch.setattr(M, "FAN", fan)
    weights = {}
    mixture = M.mixture
    monkeypatch.setattr(M, "mixture", lambda cells, types: weights.setdefault("w", mixture(cells, types)))
    got = M.score_documents(edge_docs, fold_of("doc_id", 10) == 0, keys_per_range=keys_per_range).collect()
    one, two, n_docs = Counter(), Counter(), 0
    for i, t in edge_rows:
        if not held(i):
            w = tokens(t)
            n_docs += 1
            one.update(w)
            two.update(zip(["start", *w], w))
    n, v = sum(one.values()), len(one)
    want = []
    for i, t in edge_rows:
        w = tokens(t)
        base = sum(math.log10((one[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        score = 0.0
        for u, x in zip(["start", *w], w):
            c = n_docs if u == "start" else one[u]
            a, b, z = weights["w"][int(M.bucket(np.array([c]))[0])]
            score += math.log10(a * (two[u, x] / c if c else 0) + b * one[x] / n + z / (v + 1))
        want.append((str(i), held(i), len(w), sum(one[x] > 0 for x in w), n, round(base, 6), round(score, 6)))
    have = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
             round(r["base_score"], 6), round(r["score"], 6)) for r in got]
    assert len(have) == len(want)
    for a, b in zip(sorted(have), sorted(want)):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-4 and abs(a[6] - b[6]) < 1e-4


def test_em_finds_the_best_weights_of_a_bucket():
    rng = np.random.default_rng(1)
    cells, types = [], 99
    for k in range(30):
        n, p2, p1 = rng.integers(1, 50), rng.choice([0, rng.random()]), rng.random() / 10
        cells.append(((1 * M.LEVELS + int(M.level(np.array([p2]))[0])) * M.LEVELS + k, n, n * p2, n * p1))
    w = M.mixture(cells, types)[1]

    def gain(x):
        return sum(c[1] * math.log(x[0] * c[2] / c[1] + x[1] * c[3] / c[1] + x[2] / (types + 1)) for c in cells)
    assert abs(sum(w) - 1) < 1e-9
    for _ in range(200):
        assert gain(rng.dirichlet([1, 1, 1])) <= gain(w) + 1e-6


def test_held_out_text_scores_better_than_the_base(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.array(
        *[F.when(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(2)) == 0, F.lit("red fox")).otherwise(F.lit("blue sea"))
          for k in range(20)])).alias("text"))
    r = M.score_documents(docs, fold_of("doc_id", 10) == 0).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1] * 0.75


def test_packing_round_trip():
    for a in (np.array([], np.uint32), np.array([0, 1, 2**31], np.uint32), np.arange(5000, dtype=np.uint64) * 3**20):
        assert (M.unpacked(M.packed(a)) == a).all()


def test_levels_reach_all_ranges_with_bounded_receivers():
    for units in (1, 2, 3, 4, 9, 10, 27, 28, 1000, 12345):
        depth, width = M.levels(units, 3)
        assert width <= 3 and width ** depth >= units
    assert M.levels(1024, 1024) == (1, 1024) and M.levels(1025, 1024) == (2, 33)


def test_messages_grow_with_the_corpus(spark, monkeypatch):
    """Ten times the chunks and ranges: a sender still has at most FAN receivers, and a node as many keys."""
    monkeypatch.setattr(M, "CHUNK_CHARS", 400)
    monkeypatch.setattr(M, "FAN", 4)
    for docs in (40, 400):
        rows = spark.range(docs).select(F.col("id").alias("doc_id"), F.array_join(F.transform(
            F.sequence(F.lit(1), F.lit(40)), lambda k: F.pmod(F.xxhash64("id", k), F.lit(5000)).cast("string")), " ").alias("text"))
        chunked = M.chunks(rows.repartition(4), F.lit(False), "doc_id", "text")
        keys = chunked.agg(F.sum(F.col("n_words") + F.col("n_pairs"))).first()[0]
        depth, width = M.levels(-(-keys // 100), 4)
        sent = M.from_chunks(chunked, width ** (depth - 1), width)
        assert sent.count() <= 4 * chunked.count()
        counts = sent.groupBy("grp", "part").count().agg(F.max("count")).first()[0]
        assert counts <= 40  # senders of one node: a few, whatever the corpus


def test_nothing_to_learn_from(edge_docs, no_docs):
    rows = M.score_documents(edge_docs, F.lit(True)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 and r["score"] == 0 for r in rows)
    assert M.score_documents(no_docs, F.lit(False)).count() == 0
