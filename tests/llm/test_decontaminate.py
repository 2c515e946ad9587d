import re

import pytest

from barlake.llm import decontaminate as D
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items):
    windows = {}
    for item, t in items:
        w = words(t)
        for i in range(max(len(w) - 9, 1) if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).add("" if item is None else str(item))
    out = []
    for i, t in docs:
        w, hit, own = words(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                found = windows.get(tuple(w[k:k + size]))
                if found:
                    hit.update(range(k, k + size))
                    own |= found
        out.append((i, len(w), len(hit), sorted(own)))
    return out


ITEMS = [(1, prose(30, 3)), (2, prose(12, 3)), (10, "Copper WIND"), (11, "under the bridge"), (3, None), (4, "..."),
         (5, prose(30, 3)), (None, "one"), (6, "stone"), (6, "stone"), (7, prose(25, 9))]


@pytest.mark.parametrize("block_rows,block_bytes", [(100_000, 1 << 26), (60, 1 << 26), (100_000, 900)])
def test_matches_brute_force(spark, edge_docs, edge_rows, block_rows, block_bytes):
    planted = [(200, prose(20, 50) + " " + prose(30, 3) + "!" + prose(9, 51)),
               (201, (prose(14, 9) + " ") * 5), (202, "COPPER, wind copper wind"), (203, prose(24, 9).upper())]
    docs = edge_docs.select("doc_id", "text").unionByName(spark.createDataFrame(planted, "doc_id bigint, text string"))
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = D.mark_contaminated(docs, bench, block_rows=block_rows, block_bytes=block_bytes).collect()
    want = brute(edge_rows + planted, ITEMS)

    def key(x):
        return str(x)
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"])) for r in got), key=key) == sorted(want, key=key)
    assert all(r["contaminated"] == (r["n_hit"] > 0) and r["n_items"] == len(r["items"]) for r in got)


def test_drop_keeps_clean_rows_and_columns(spark, edge_docs, edge_rows):
    bench = spark.createDataFrame([(1, prose(30, 3))], "item_id bigint, text string")
    out = D.drop_contaminated(edge_docs, bench)
    assert out.columns == edge_docs.columns
    assert out.count() == sum(not b[2] for b in brute(edge_rows, [(1, prose(30, 3))]))


def test_empty_sides(spark, edge_docs, no_docs, edge_rows):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert D.mark_contaminated(edge_docs, none).where("contaminated OR n_items > 0").count() == 0
    assert D.mark_contaminated(edge_docs, none).count() == len(edge_rows)
    assert D.mark_contaminated(no_docs, none).count() == 0


def test_a_sentence_of_many_items(spark):
    """A third of 3,000 items share a sentence: all are named, and the broadcast windows do not carry them."""
    shared = prose(14, 77)
    items = [(i, f"{prose(11, 1000 + i)} {shared if i % 3 == 0 else ''}") for i in range(3000)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    windows, _ = D.benchmark_windows(bench, "item_id", "text", D.WINDOW)
    assert windows.columns == ["win_id", "win", "width"]
    rows = [(1, f"before {shared} after"), (2, prose(60, 5)), (3, prose(11, 1007) + " " + shared)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in D.mark_contaminated(docs, bench).collect()}
    many = sorted(str(i) for i in range(0, 3000, 3))
    assert list(got[1]["items"]) == many and got[1]["n_hit"] == 14 and got[2]["n_items"] == 0
    assert {i: list(r["items"]) for i, r in got.items()} == {i: own for i, _, _, own in brute(rows, items)}
    assert set(got[3]["items"]) == {*many, "7"}
