"""The wildcard automaton against regular expressions, and the filter against plain string rules."""
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barlake.llm import url_filter as U


def as_regex(glob):
    out, at = "", 0
    while at < len(glob):
        if glob[at:at + 2] == "**":
            out, at = out + "(?s:.*)", at + 2
        elif glob[at] == "*":
            out, at = out + "[^/]*", at + 1
        elif glob[at] == "?":
            out, at = out + "[^/]", at + 1
        else:
            at += glob[at] == "\\" and at + 1 < len(glob)
            out, at = out + re.escape(glob[at]), at + 1
    return re.compile(out)


def matches(globs, texts):
    data = [t.encode() for t in texts]
    ends = np.cumsum([0, *map(len, data)])
    rules = [U.Rule(g, "block", g, 0) for g in globs]
    return U.Automaton(rules).match(np.frombuffer(b"".join(data), dtype=np.uint8), ends[:-1], np.diff(ends))


GLOBS = st.lists(st.text(alphabet="ab/*?é.\\", max_size=12), min_size=1, max_size=40)
TEXTS = st.lists(st.text(alphabet="ab/é.*\\鐵", max_size=40), min_size=1, max_size=30)


@settings(max_examples=300, deadline=None)
@given(GLOBS, TEXTS)
def test_automaton_equals_regular_expressions(globs, texts):
    got = matches(globs, texts)
    assert got.tolist() == [[bool(as_regex(g).fullmatch(t)) for g in globs] for t in texts]


def test_many_rules_over_many_words(monkeypatch):
    rnd = random.Random(2)
    globs = [f"*.{''.join(rnd.choices('abc', k=rnd.randint(1, 60)))}.{rnd.choice(['com', 'net'])}/"
             f"{rnd.choice(['', '**', '*/x**', '??/**'])}" for _ in range(400)]
    texts = []
    for g in rnd.sample(globs, 200):
        texts.append(g.replace("**", rnd.choice(["", "a/b", "x" * 3000])).replace("*", rnd.choice(["", "a", "b.c"]))
                     .replace("?", rnd.choice("ab")))
    want = [[bool(as_regex(g).fullmatch(t)) for g in globs] for t in texts]
    assert matches(globs, texts).tolist() == want and any(map(any, want))
    monkeypatch.setattr(U, "WORDS_AT_ONCE", 1000)  # a few texts at a time
    assert matches(globs, texts).tolist() == want


URLS = [None, "", "no scheme", "http://", "http:///x", "://EXAMPLE.com/en/", "HTTPS://Example.COM/en/1?x=http://a.net/es/",
        "http://www.example.com/en/1", "http://xwww.example.com/en/1", "http://a.www.example.com/en/1",
        "http://notexample.com/en/", "http://example.com/EN/1", "http://example.com/en", "http://example.com?/en/",
        "http://com/", "http://com", "http://acom/", "http://net/fr/#x", "http://a.net/es/x", "http://a.net/de/es/",
        "http://a.net/es", "http://example.org/x.net/es/", "ftp://u:p@example.com:80/en/", "http://a.com:80/en/",
        "http://spam-farm.example.org/de/1", "http://spam-farm.example.org", "http://a.org/spam/", "http://ads.org",
        "http://x.ads.org/a", "http://loads.org/", "http://a.org/wp-login.php", "http://a.com/wp-login.php",
        "http://a.org/blog/wp-admin/x", "http://a.org/x\n/cgi-bin/y", "http://ÉÀ.example.net/fr/é", "http://É.org/ü?",
        "http://a.org/" + "x/" * 60000, "http://a.net/es/" + "y" * 300000, "x" * 100000 + "://a.net/es/", "http://a.org/*\\?",
        "http://.com/", "http://cheap-pills.example.net/en/"]


def brute(url):
    """(host, path, rule, verdict) by the contract's words."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in U.DOMAIN_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, *max(fits)[1:]
    globs = [g for _, g in U.GLOB_RULES]
    return host, path, None, "block" if any(as_regex(g).fullmatch(f".{host}{path}") for g in globs) else "allow"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[6]), (3, URLS[3]), (3, URLS[3])]
    clash = ["host", "path", "rule", "verdict", "_id", "_k", "a.b"]
    return (spark.createDataFrame(rows, "page_id bigint, url string").repartition(3)
            .select("*", *[F.lit("x").alias(c) for c in clash]))


def test_judged_pages(pages):
    want = sorted(str((i, *brute(u))) for i, u in [*enumerate(URLS), (None, URLS[6]), (3, URLS[3]), (3, URLS[3])])
    got = U.judge(pages, U.default_rules()).collect()
    assert sorted(str(tuple(r)) for r in got) == want
    assert {brute(u)[2:] for u in URLS} >= {("com/", "allow"), ("example.com/en/", "block"),
                                            ("www.example.com/en/", "allow"), ("net/es/", "block"),
                                            ("net/fr/", "block"), (None, "allow"), (None, "block")}


def test_allowed_rows_keep_their_columns(pages):
    got = U.allowed(pages, U.default_rules())
    assert got.columns == pages.columns
    ids = {r["page_id"] for r in got.collect()}
    assert ids - {None} == {i for i, u in enumerate(URLS) if brute(u)[3] == "allow"}


def test_order_defaults_and_empty_input(spark, pages):
    rules = [U.glob_rule("allow", "*.a.org/**"), U.glob_rule("block", "*.a.org/x**"),
             U.Rule("*.a.org/xy**", "allow", "second", 5), U.Rule("**xy**", "block", "first of rank 5", 5)]
    df = spark.createDataFrame([(1, "http://a.org/x"), (2, "http://a.org/y"), (3, "http://b.org/xy"), (4, "http://a.org/xy"),
                                (5, "http://b.org/"), (6, None)], "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in U.judge(df, rules, default="block").collect()}
    assert got == {1: (None, "block"), 2: (None, "allow"), 3: ("first of rank 5", "block"), 4: ("second", "allow"),
                   5: (None, "block"), 6: (None, "block")}
    assert {r["page_id"] for r in U.allowed(df, rules, default="block").collect()} == {2, 4}
    assert {r["verdict"] for r in U.judge(df, [], default="allow").collect()} == {"allow"}
    assert U.judge(pages.limit(0), U.default_rules()).collect() == []


def test_sliced_and_null_batches():
    urls = pa.array([None, ".a.net/es/", None, ".a.com/", ".b"])
    rules = tuple(U.default_rules())
    assert U.decide(urls, rules).tolist() == [-1, 3, -1, 0, -1]
    assert U.decide(urls.slice(1, 3), rules).tolist() == [3, -1, 0]
    assert U.decide(pa.array([None, None], pa.string()), rules).tolist() == [-1, -1]
    assert U.decide(pa.array([], pa.string()), rules).tolist() == []
