import hashlib
import re
from collections import Counter, defaultdict

from barlake.llm import exact_dedup as X


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_matches_brute_force(edge_docs, edge_rows):
    got = [r.asDict() for r in X.mark_copies(edge_docs).collect()]
    assert len(got) == len(edge_rows)
    groups = defaultdict(list)
    for i, t in edge_rows:
        groups[hashlib.sha256(normal(t).encode()).hexdigest()].append(i)
    seen = Counter()
    for r in got:
        ids = groups[r["text_sha256"]]
        known = [i for i in ids if i is not None]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == (min(known) if known else None)
        seen[r["text_sha256"]] += r["kept"]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert set(seen.values()) == {1}


def test_drop_copies_keeps_columns_and_one_row_per_text(edge_docs, edge_rows):
    out = X.drop_copies(edge_docs)
    assert out.columns == edge_docs.columns
    assert out.count() == len({normal(t) for _, t in edge_rows})


def test_hot_group_is_found_by_the_summary(spark):
    df = spark.range(6000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS text")
    rows = X.digests(df, "doc_id", "text")
    winners = X.heavy_winners(rows).collect()
    assert [(w["_keep"], w["_size"]) for w in winners if w["_size"] == 2000] == [(0, 2000)]
    copies, rest = X.split_rows(rows)
    assert copies.count() == 1999 and rest.count() == 4001


def test_empty_table(no_docs):
    assert X.mark_copies(no_docs).count() == 0 and X.drop_copies(no_docs).count() == 0
