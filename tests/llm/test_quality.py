import numpy as np
from pyspark.sql import functions as F

from barlake.llm import quality as Q
from tests.conftest import SF_CHECK


def test_held_out_labels(spark):
    """Fitted without a fifth of the labels, the classifier gets those right."""
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = Q.fit(docs, labels.where(~held))
    rows = Q.score_documents(docs, model).join(labels.where(held), "doc_id").select("quality", "kept", "score").collect()
    right = [r["kept"] == (r["quality"] == 1) for r in rows]
    assert len(rows) > 50 and sum(right) / len(rows) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)
    good = [r["kept"] for r in rows if r["quality"] == 1]
    assert sum(good) / len(good) > 0.97


def test_views_teach_each_other():
    """The text view has few labels; confident metadata labels of the pool make it usable."""
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 3000).astype(float)
    a = np.column_stack([y + rng.normal(0, 0.4, 3000), rng.normal(0, 1, (3000, 30))])
    b = np.column_stack([y * 2 - 1 + rng.normal(0, 0.2, 3000)])
    few = slice(0, 40)
    alone = Q.fit_logistic(a[few], y[few])
    both = Q.co_train(a[few], b[few], y[few], Q.ArrayPool(a[40:2000], b[40:2000]))

    def right(w):
        return ((Q.logits(a[2000:], w) > 0) == (y[2000:] == 1)).mean()
    assert right(both.text) > right(alone)
    # combining the views takes enough labels to calibrate on
    many = slice(0, 400)
    score = Q.co_train(a[many], b[many], y[many], Q.ArrayPool(a[400:2000], b[400:2000])).score(a[2000:], b[2000:])[2]
    assert ((score > 0.5) == (y[2000:] == 1)).mean() > 0.97


def brute_co_train(a, b, y, pool_a, pool_b):
    """Row by row: the same rounds, every sum spelled out."""
    hold = [i % 5 == 0 for i in range(len(y))]
    rows = [[list(x) + [1.0] for x in v] for v in (a, b)]
    pool = [[list(x) + [1.0] for x in v] for v in (pool_a, pool_b)]
    train = [i for i in range(len(y)) if not hold[i]]
    w = [list(Q.fit_logistic(np.array(v)[train], y[train])) for v in (a, b)]

    def p(x, weights):
        return 1 / (1 + np.exp(-sum(i * j for i, j in zip(x, weights))))
    for k in range(1, Q.ROUNDS + 1):
        teachers = [list(x) for x in w]
        for _ in range(Q.STEPS):
            new = []
            for v in (0, 1):
                used = [(rows[v][i], y[i], 1.0) for i in train]
                sure = [(x, p(o, teachers[1 - v])) for x, o in zip(pool[v], pool[1 - v])]
                for label in (0.0, 1.0):
                    own = [x for x, q in sure if (q >= Q.CONFIDENT if label else q <= 1 - Q.CONFIDENT)]
                    used += [(x, label, min(1.0, Q.SHARE * k * len(train) / len(own))) for x in own]
                d = len(w[v])
                g, h = [0.0] * d, [[1e-9 * (i == j) for j in range(d)] for i in range(d)]
                for x, t, m in used:
                    q = p(x, w[v])
                    for i in range(d):
                        g[i] += m * (q - t) * x[i]
                        for j in range(d):
                            h[i][j] += m * q * (1 - q) * x[i] * x[j]
                for i in range(d):
                    r = Q.RIDGE if i < d - 1 else 1e-6
                    g[i] += r * w[v][i]
                    h[i][i] += r
                new.append([i - j for i, j in zip(w[v], np.linalg.solve(h, g))])
            w = new
    return w


def test_co_training_equals_brute_force():
    rng = np.random.default_rng(6)
    y = rng.integers(0, 2, 400).astype(float)
    a = np.column_stack([y * 4 + rng.normal(0, 0.8, 400), rng.normal(0, 1, 400)])
    b = np.column_stack([y * 5 - 2 + rng.normal(0, 0.7, 400)])
    got = Q.co_train(a[:60], b[:60], y[:60], Q.ArrayPool(a[60:], b[60:]))
    want = brute_co_train(a[:60], b[:60], y[:60], a[60:], b[60:])
    assert np.allclose(got.text, want[0], atol=1e-6) and np.allclose(got.meta, want[1], atol=1e-6)


def test_every_unlabelled_document_counts(spark, edge_docs, monkeypatch):
    """The passes over the stored features give the sums of all rows, however they are spread."""
    taken = []
    stored = Q.stored
    monkeypatch.setattr(Q, "stored", lambda df, name: taken.append(stored(df, name)) or taken[-1])
    monkeypatch.setattr(Q, "CONFIDENT", 0.5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    model = Q.fit(edge_docs, labels)
    rows = taken[0].collect()
    assert len(rows) == edge_docs.count()
    free = [r for r in rows if r["y"] is None]
    views = np.array([r["a"] for r in free], dtype=float), Q.one_hot(np.array([r["b"] for r in free]))
    teachers, w = [model.text * 0.9, model.meta * 1.1], [model.text, model.meta]
    want = Q.pool_sums(views, teachers, w, Q.CONFIDENT)
    assert want[0] + want[1 + len(w[0]) + len(w[0]) ** 2] >= len(free) and want.shape == (2 * sum(1 + len(x) + len(x) ** 2 for x in w),)
    for parts in (1, 7, 40):
        pool = Q.StoredPool(taken[0].where("y IS NULL").repartition(parts))
        assert np.allclose(pool.sums(teachers, w), want, rtol=1e-9, atol=1e-9)
    assert np.allclose(Q.StoredPool(taken[0].limit(0)).sums(teachers, w), 0)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert Q.fit(edge_docs, none) is None
    assert Q.fit(edge_docs, spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id bigint, quality int")) is None
    scored = Q.score_documents(edge_docs, None)
    assert scored.count() == len(edge_rows) and scored.where("NOT kept OR score != 1").count() == 0
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 1), (108, 0)], "doc_id bigint, quality int")
    model = Q.fit(edge_docs, labels)
    kept = Q.score_documents(edge_docs, model, only_kept=True)
    assert kept.columns == edge_docs.columns
    full = Q.score_documents(edge_docs, model)
    assert full.count() == len(edge_rows) and full.where("kept").count() == kept.count()
    assert Q.score_documents(no_docs, model).count() == 0 and Q.fit(no_docs, labels) is None
    bare = Q.score_documents(edge_docs.select("doc_id", "text"), model)
    assert bare.count() == len(edge_rows)
