import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from barlake.llm import simhash as S


def brute_print(text):
    w = bytes(text or "", "utf-8").lower().split()
    runs = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(r, seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(values):
    """value -> set of values reachable over links of 3 bits."""
    left, out = set(values), {}
    while left:
        todo, seen = [left.pop()], set()
        while todo:
            v = todo.pop()
            seen.add(v)
            near = {x for x in left if (x ^ v).bit_count() <= 3}
            left -= near
            todo += near
        out.update({v: seen for v in seen})
    return out


def test_fingerprints_and_components(edge_docs, edge_rows):
    got = S.near_groups(edge_docs).collect()
    assert len(got) == len(edge_rows)
    prints = [(i, brute_print(t)) for i, t in edge_rows]
    groups = brute_components({p for _, p in prints})
    least = {}
    for i, p in prints:
        for v in groups[p]:
            if i is not None:
                least[v] = min(i, least.get(v, i))
    want = sorted((str(i), p, str(least.get(p))) for i, p in prints)
    assert sorted((str(r["id"]), r["fp"] & (1 << 64) - 1, str(r["first"]["id"])) for r in got) == want


def test_links_lose_nothing_in_hot_shards(spark):
    """A dense cluster that shares blocks, chains and random values, over split trees and several block counts."""
    rnd = random.Random(4)
    values = {rnd.getrandbits(64) for _ in range(300)}
    centre = rnd.getrandbits(64)
    for _ in range(250):
        v = centre
        for b in rnd.sample(range(20), rnd.randint(1, 5)):
            v ^= 1 << b
        values.add(v)
    chain = rnd.getrandbits(64)
    for k in range(0, 60, 3):
        chain ^= 0b111 << k
        values.add(chain)
    rows = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    fps = spark.createDataFrame(rows, "fp bigint")
    want = brute_components(values)
    for tree_items in (2048, 40):
        roots = {r["node"] % (1 << 64): r["root"] for r in S.components(S.links(fps, 3, tree_items)).collect()}
        assert set(roots) == {v for v in values if len(want[v]) > 1}
        by_root = {}
        for v, root in roots.items():
            by_root.setdefault(root, set()).add(v)
        assert all(want[v] == by_root[roots[v]] for v in roots)


def test_bk_tree_equals_all_pairs():
    rnd = np.random.default_rng(2)
    base = rnd.integers(0, 1 << 63, 40, dtype=np.uint64)
    items = np.unique(np.concatenate([base ^ np.uint64(1 << k) for k in range(12)] + [base]))
    pairs = set()
    for q, i in S.BKTree(items, np.arange(len(items))).links(items, np.arange(len(items)), 3):
        pairs |= set(zip(q.tolist(), i.tolist()))
    want = np.bitwise_count(items[:, None] ^ items[None, :]) <= 3
    assert pairs == set(zip(*(x.tolist() for x in np.nonzero(want))))


def test_shard_keys_meet_for_every_near_pair(spark):
    rnd = random.Random(9)
    for blocks in (4, 5, 6, 7):
        pairs = []
        for _ in range(200):
            v = rnd.getrandbits(64)
            w = v
            for b in rnd.sample(range(64), 3):
                w ^= 1 << b
            pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (v, w)))
        df = spark.createDataFrame(pairs, "a bigint, b bigint")
        meet = F.arrays_overlap(S.shard_keys(F.col("a"), blocks, 3), S.shard_keys(F.col("b"), blocks, 3))
        assert df.where(~meet).count() == 0


def test_drop_keeps_one_of_each_group(edge_docs, edge_rows, no_docs):
    out = S.drop_near_copies(edge_docs)
    assert out.columns == edge_docs.columns
    left = [brute_print(r["text"]) for r in out.collect()]
    groups = brute_components({brute_print(t) for _, t in edge_rows})
    # one document of each group; (108, "same row") is a repeated row, which stays or goes as one
    assert len({frozenset(groups[p]) for p in left}) == len({frozenset(g) for g in groups.values()})
    assert len(left) - 1 <= len({frozenset(g) for g in groups.values()})
    assert S.near_groups(no_docs).count() == 0 and S.drop_near_copies(no_docs).count() == 0


def test_hot_fingerprints_are_settled_beside_the_rest(spark, monkeypatch):
    """A third of the rows share a text; the heavy side and the shuffled one give every row once."""
    rows = [(i, "one hot text of some words" if i % 3 else f"text number {i} with words {i * i} of its own {i % 7}")
            for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    for share in (1000, 10, 1):
        monkeypatch.setattr(S, "HEAVY_SHARE", share)
        got = {r["id"]: (r["fp"] & (1 << 64) - 1, r["first"]["id"]) for r in S.near_groups(docs).collect()}
        prints = {i: brute_print(t) for i, t in rows}
        groups = brute_components(set(prints.values()))
        least = {v: min(i for i, p in prints.items() if p in groups[v]) for v in groups}
        assert got == {i: (p, least[p]) for i, p in prints.items()}, share
