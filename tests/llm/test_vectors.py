"""Centroid clustering and vector codes against plain Python on vectors that hold every edge."""
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.llm import clustering, codes
from barlake.llm.vectors import integer_vectors


def floats(n, seed, dims=64):
    rnd = random.Random(seed)
    return [float(np.float32(rnd.gauss(0, 0.2))) for _ in range(dims)]


@pytest.fixture(scope="module")
def vector_rows():
    """(vec_id, embedding, label): ties, copies, null ids, and every kind of unusable vector."""
    rows = [(i, floats(64, i % 70), i % 4 if i % 5 else None) for i in range(120)]
    rows += [(200, None, 1), (201, [], 1), (202, [0.1] * 63, 1), (203, [0.1] * 65, 1), (204, [0.1] * 63 + [None], 1),
             (205, [0.1] * 63 + [math.nan], 1), (206, [math.inf] + [0.1] * 63, 1), (207, [1e30] + [0.0] * 63, 1),
             (208, [0.0] * 64, None), (209, [-0.0] * 64, 2), (210, [5e5] + [-1.0] * 63, 2),
             (None, floats(64, 900), None), (None, floats(64, 901), 3), (211, floats(64, 5), 3), (211, floats(64, 5), 3),
             (-4, [0.25] * 64, 9), (-3, [-0.25] * 64, 9)]
    return rows


@pytest.fixture(scope="module")
def vectors(spark, vector_rows):
    df = spark.createDataFrame(vector_rows, "vec_id bigint, embedding array<float>, label int").repartition(3)
    clash = ["cluster", "id", "v", "code", "error", "n", "entry", "distance", "a.b", "carry0"]
    return df.select("*", *[F.lit("x").alias(c) for c in clash])


def kept(rows, scale):
    """The usable rows with their integers, by plain rules."""
    out = []
    for i, v, label in rows:
        if v is None or len(v) != 64 or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = [math.floor(scale * float(np.float32(x))) for x in v]
        if sum(x * x for x in ints) < 2 ** 60:
            out.append((i, ints, label))
    return out


def far(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def test_kept_vectors(vectors, vector_rows):
    got = integer_vectors(vectors, 64, 64, "vec_id", "embedding", ("label", "a.b")).collect()
    want = sorted((str(i), v, str(label)) for i, v, label in kept(vector_rows, 64))
    assert sorted((str(r["id"]), r["v"], str(r["carry0"])) for r in got) == want
    assert {r["carry1"] for r in got} == {"x"}
    ids = {i for i, _, _ in kept(vector_rows, 64)}
    assert not ids & {200, 201, 202, 203, 204, 205, 206, 207} and {208, 209, 210, None} <= ids


def brute_clusters(rows, k, rounds):
    def key(i):
        return hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()

    centroids = [v for _, v in sorted((key(i), v) for i, v, _ in rows)][:k]

    def nearest(v):
        return min((far(v, c), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v, _ in rows:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c
                     for j, c in enumerate(centroids)]
    return centroids, [(i, *nearest(v)[::-1]) for i, v, _ in rows]


@pytest.mark.parametrize("k,rounds", [(16, 3), (200, 2), (1, 1)])
def test_clusters_equal_brute_force(vectors, vector_rows, k, rounds):
    centroids, want = brute_clusters(kept(vector_rows, 64), k, rounds)
    found, clusters = clustering.cluster(vectors, k=k, rounds=rounds)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))
    facts = {r["cluster"]: r for r in clusters.collect()}
    assert [facts[j]["centroid"] for j in range(len(centroids))] == centroids
    for j in range(len(centroids)):
        assert facts[j]["cluster_inertia"] == sum(d for _, c, d in want if c == j)
        assert facts[j]["n"] == sum(c == j for _, c, _ in want)
        assert facts[j]["inertia"] == sum(d for _, _, d in want)
    row = clustering.with_cluster_facts(found, clusters).where("vec_id = 7").first()
    text = ",".join(map(str, centroids[row["cluster"]]))
    assert row["centroid_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_search_skips_centroids_and_loses_no_tie():
    rng = np.random.default_rng(3)
    # spread out means and deviations, equal centroids, and vectors halfway between two of them
    centroids = (rng.normal(0, 30, (150, 64)) * rng.uniform(0.1, 2, (150, 1)) + rng.normal(0, 40, (150, 1))).astype(int)
    centroids = np.concatenate([centroids, centroids[:20], centroids[:20] + 2])
    v = np.concatenate([centroids[rng.integers(0, len(centroids), 300)] + rng.integers(-3, 4, (300, 64)),
                        centroids, centroids[:20] + 1, rng.integers(-10 ** 6, 10 ** 6, (40, 64))])
    order = clustering.MeanOrder(centroids)
    number, best = order.nearest(v)
    d = ((v[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (best == d.min(axis=1)).all() and (number == d.argmin(axis=1)).all()
    assert order.computed < 0.2 * d.size


def test_no_vectors(vectors):
    for df in (vectors.limit(0), vectors.where("vec_id between 200 and 207")):
        found, clusters = clustering.cluster(df)
        assert clustering.with_cluster_facts(found, clusters).collect() == []
        done = codes.compress(df, carry=("label",))
        assert codes.with_group_error(done.rows, "carry0").collect() == [] and done.codebook_text() == ""


def brute_codes(rows, entries, rounds, parts=16):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = 64 // parts
    cut = [[v[p * size:(p + 1) * size] for p in range(parts)] for _, v, _ in rows]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((far(x, e), j) for j, e in enumerate(books[p]))

    for _ in range(rounds):
        moved = []
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(p, c[p])[1], []).append(c[p])
            moved.append([[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else e
                          for j, e in enumerate(books[p])])
        books = moved
    out = []
    for (i, _, label), c in zip(rows, cut):
        best = [nearest(p, c[p]) for p in range(parts)]
        out.append((i, [j for _, j in best], sum(d for d, _ in best), label))
    return books, out


@pytest.mark.parametrize("entries,rounds", [(64, 2), (300, 1), (2, 3)])
def test_codes_equal_brute_force(vectors, vector_rows, entries, rounds):
    books, want = brute_codes(kept(vector_rows, 256), entries, rounds)
    done = codes.compress(vectors, entries=entries, rounds=rounds, carry=("label",))
    assert done.codebooks.tolist() == books
    got = codes.with_group_error(done.rows, "carry0").collect()
    assert sorted(map(str, ((r["id"], r["code"], r["error"], r["carry0"]) for r in got))) == sorted(map(str, want))
    for r in got:
        assert r["group_error"] == sum(e for _, _, e, label in want if label == r["carry0"])
    first = done.rows.withColumn("approx", codes.decode("code", done.codebooks)).where("id = 3").first()
    assert first["approx"] == [x / 256 for p, k in enumerate(first["code"]) for x in books[p][k]]


@pytest.mark.parametrize("leaves", [1, 3, 64, 5000])
def test_trie_equals_all_distances(monkeypatch, leaves):
    """Depth-first with any size of the subtrees that are expanded at once."""
    monkeypatch.setattr(codes, "LEAVES", leaves)
    rng = np.random.default_rng(leaves)
    parts = np.concatenate([rng.integers(-4, 5, (900, 4)), np.zeros((400, 4), dtype=int),
                            rng.integers(-10 ** 7, 10 ** 7, (300, 4))])
    entries = np.concatenate([rng.integers(-4, 5, (40, 4)), parts[-20:], parts[-20:]])
    trie = codes.PartTrie(parts)
    best, distance = trie.nearest(entries)
    d = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (best[trie.leaf_of] == d.argmin(axis=1)).all() and (distance[trie.leaf_of] == d.min(axis=1)).all()
    assert len(trie.first) == len(np.unique(parts, axis=0))
    assert [len(s) for s in trie.start] == [len(np.unique(parts[:, :j + 1], axis=0)) for j in range(4)]
    count, total = trie.sums(best, len(entries))
    for j in range(len(entries)):
        own = parts[d.argmin(axis=1) == j]
        assert count[j] == len(own) and total[j].tolist() == own.sum(axis=0).tolist()


def test_wide_parts_number_prefixes_anew():
    """Keys of many dimensions with many values would not fit a long in one go."""
    parts = np.random.default_rng(1).integers(-10 ** 6, 10 ** 6, (3000, 8))
    parts[1000:2000] = parts[:1000]
    trie = codes.PartTrie(parts)
    assert len(trie.first) == 2000
    assert (parts[trie.first][trie.leaf_of] == parts).all()
    assert (parts[trie.first] == np.unique(parts, axis=0)).all()


def test_code_text_and_null_codes(spark):
    df = spark.createDataFrame([([0, 255, 16],), (None,)], "code array<int>")
    assert [r[0] for r in df.select(codes.code_text(F.col("code"))).collect()] == ["00ff10", None]
    book = np.zeros((3, 256, 1), dtype=np.int64)
    book[1, 255], book[2, 16] = 5, -2
    assert [r[0] for r in df.select(codes.decode("code", book, scale=2)).collect()] == [[0.0, 2.5, -1.0], None]
