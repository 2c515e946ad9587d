import random

from barlake.llm import secret_scan as S


def documents():
    rnd = random.Random(1)
    rows, planted = [], {}
    for i in range(150):
        words = " ".join(rnd.choice("ofthedst ingontheverylongword tamenteueesosqueie erscheinachlichheit the on".split())
                         for _ in range(30))
        if i % 3 == 0:
            value = "".join(rnd.choice("0123456789abcdef") for _ in range(40))
            text = f'{words} token = "{value}" {words}'
            planted[i] = (text.index(value), text.index(value) + 40)
        elif i % 3 == 1:
            text = f"{words} 123e4567-e89b-12d3-a456-4266141740{i % 90 + 10} {words} {10**17 + i}"
        else:
            text = words
        rows.append((i, text))
    return rows, planted


def test_finds_planted_and_leaves_false_positives(spark):
    rows, planted = documents()
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["secrets"]]
           for r in S.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {i: s[0] for i, s in got.items() if s} == planted


def test_labels_checked_by_hand_replace_the_rules(spark):
    rows, planted = documents()
    labelled = spark.createDataFrame([(i, a, z, 0 if i % 2 else 1) for i, (a, z) in planted.items()],
                                     "doc_id bigint, start bigint, end bigint, label int")
    got = S.scan(spark.createDataFrame(rows, "doc_id bigint, text string"), labelled=labelled).collect()
    assert len(got) == len(rows) and all(0 <= s["score"] <= 1 for r in got for s in r["secrets"])


def test_features():
    assert S.coverage("thestonexx", {"the", "stone"}) == 0.8
    change, mixed, entropy = S.transitions("aa11")
    assert (round(change, 3), round(mixed, 3), entropy) == (0.333, 0.333, 1.0)
    assert S.rule("AKIA" + "A1" * 8, "", 0.0) == 1.0 and S.rule("x" * 20, "", 0.0) == 0.0


def test_edges(edge_docs, edge_rows, no_docs):
    got = S.scan(edge_docs).collect()
    assert len(got) == len(edge_rows) and all(r["secrets"] == [] for r in got)
    assert S.scan(no_docs).count() == 0


def found(text):
    return [text[a:z] for a, z, _ in S.spans_in(text)]


AWS, GITHUB = "AKIA" + "ABCDEFGHIJKLMNOP", "ghp_" + "a1B2" * 9


def test_candidates_of_usual_forms():
    assert found(f"AWS_KEY={AWS}") == [AWS]
    assert found(f"AWS_SECRET_ACCESS_KEY=wJalrXUtnFEMI/K7MDENG")[-1] == "wJalrXUtnFEMI/K7MDENG"
    assert found(f"token={GITHUB}") == [GITHUB]
    assert found(f"/v1/keys/{AWS}/x") == [AWS]
    assert found("https://h.org/a?user=me&token=ab.c-12&page=2#top") == ["ab.c-12"]
    assert found('password: "hunter2hunter"') == ["hunter2hunter"]
    assert found('{"password": "p@ss!w0rd", "n": 1}') == ["p@ss!w0rd"]
    assert found('key = "abc.def.ghi123456"') == ["abc.def.ghi123456"]
    assert found("DB_PASSWD=a!b@c#1, next") == ["a!b@c#1"]
    assert found('password: str = "hunter2"')[-1] == "hunter2"
    assert found("Authorization: Bearer eyJh.eyJz.c2ln") == ["eyJh.eyJz.c2ln"]
    assert found('x "QUJDREVGR0hJSktMTU5PUA==" y') == ["QUJDREVGR0hJSktMTU5PUA=="]
    assert found("the token and the key of: note") == []
    nested = f"api_url=https://h.org/a?token=ab12cd34&k={AWS}"
    assert {"ab12cd34", AWS} <= set(found(nested))


def test_candidates_never_overlap_and_long_texts_are_fast():
    for text in ("key=" * 50000, "?token=" * 30000, "x" * 300000, "key='a" * 30000, " " * 300000, "key:a,"  * 30000):
        at = 0
        for a, z, _ in S.spans_in(text):
            assert at <= a < z
            at = z


def test_usual_forms_are_found(spark):
    rnd = random.Random(5)
    rows, planted = documents()
    rows = [(i, t) for i, t in rows if i not in planted]

    def value(n, chars="abcdefghijkmnpqrstuvwxyz23456789"):
        return "".join(rnd.choice(chars) for _ in range(n - 1)) + "7"

    want = {}
    for i in range(1000, 1160):
        v = [value(13), value(6) + "." + value(5) + "." + value(6), value(24), value(20)][i % 4]
        text = [f'password: "{v}"', f'key = "{v}"', f"API_TOKEN={v}", f"https://h.org/a?token={v}&page=2"][i % 4]
        rows.append((i, f"the on the {text} the on"))
        want[i] = [v]
    rows.append((2000, f"AWS_KEY={AWS}"))
    rows.append((2001, f"the on the /on/{GITHUB}/on the"))
    want.update({2000: [AWS], 2001: [GITHUB]})
    texts = dict(rows)
    got = S.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: [texts[r["doc_id"]][s["start"]:s["end"]] for s in r["secrets"]]
            for r in got if r["secrets"]} == want


def test_provider_format_stays_whatever_the_forest_says(spark):
    rows, planted = documents()
    rows.append((3000, f"the on {AWS} the on"))
    other = [(i, a, z, i % 2) for i, (a, z) in planted.items()]
    schema = "doc_id bigint, start bigint, end bigint, label int"
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")

    def spans(labels):
        got = S.scan(docs, labelled=spark.createDataFrame(labels, schema)).where("doc_id = 3000").first()
        return [(s["start"], s["end"], s["score"]) for s in got["secrets"]]
    assert spans(other) == [(7, 27, 1.0)]
    assert S.scan(docs).where("doc_id = 3000").first()["secrets"][0]["score"] == 1.0


def test_frequent_words_are_the_first_of_all_texts(spark):
    """Ties by word, from every text, whatever group a word falls in."""
    import random
    import re
    from collections import Counter

    rnd = random.Random(2)
    names = ["".join(rnd.choices("abcdefgh", k=rnd.randint(3, 5))) for _ in range(3000)]
    texts = [" ".join(rnd.choices(names, weights=range(3000, 0, -1), k=200)) + " ab x9y Zürich" for _ in range(60)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(7)
    counts = Counter(w for t in texts if t for w in re.findall(r"(?<![a-z0-9])[a-z]{3,16}(?![a-z0-9])", t.lower()))
    for size in (1, 50, 700, 100_000):
        want = sorted(counts, key=lambda w: (-counts[w], w))[:size]
        assert S.frequent_words(docs, size=size) == set(want)


def brute_features(text, start, end, path, dictionary):
    """The features of one candidate, spelled out by definition."""
    import math
    import re
    import string
    import zlib
    word, before = text[start:end], text[max(0, start - 48):start]
    kind = ["l" if c in string.ascii_lowercase else "u" if c in string.ascii_uppercase else
            "d" if c in string.digits else "s" for c in word]
    steps = [(kind[k], kind[k + 1]) for k in range(len(word) - 1)]
    changed = [a != b for a, b in steps]
    digit_edge = [a != b and "d" in (a, b) for a, b in steps]
    entropy = 0.0
    for c in sorted(set(word), key=word.index):
        entropy -= word.count(c) / len(word) * math.log2(word.count(c) / len(word))
    known, k = 0, 0
    while k < len(word):
        fits = [n for n in range(3, 17) if k + n <= len(word) and word[k:k + n].lower() in dictionary]
        known += max(fits, default=0)
        k += max(fits, default=1)
    names = re.findall(r"[A-Za-z_]+", before)[-3:]
    name_slot, path_slot = [0.0] * 16, [0.0] * 16
    if names:
        name_slot[zlib.crc32(names[-1].lower().encode()) % 16] = 1.0
    path_slot[zlib.crc32((path or "").encode()) % 16] = 1.0
    telling = ("key", "token", "secret", "passw", "pwd", "auth", "bearer", "credential", "api")
    sign = before.rstrip("\"'`") if len(before) - len(before.rstrip("\"'`")) <= 1 else ""
    return [float(min(len(word), 200)), sum(changed) / len(steps), sum(digit_edge) / len(steps), entropy,
            kind.count("d") / len(word), kind.count("u") / len(word), kind.count("s") / len(word),
            float(all(c in string.hexdigits for c in word)), known / len(word), float(word.count("/")),
            float(any(t in n.lower() for t in telling for n in names)), float(sign.rstrip()[-1:] in (":", "=") and sign != ""),
            float(before[-1:] in tuple("\"'`") and text[end:end + 1] in tuple("\"'`")), *name_slot, *path_slot]


def tree_of(node):
    if node.getClass().getSimpleName() == "LeafNode":
        counts = list(node.impurityStats().stats())
        return counts[1] / sum(counts)
    split = node.split()
    return split.featureIndex(), split.threshold(), tree_of(node.leftChild()), tree_of(node.rightChild())


def brute_score(trees, x):
    votes = 0.0
    for node in trees:
        while isinstance(node, tuple):
            feature, threshold, low, high = node
            node = low if x[feature] <= threshold else high
        votes += node
    return votes / len(trees)


def test_features_labels_and_decisions_equal_brute_force(spark, monkeypatch):
    """What the forest learns from and what it decides, against features by definition and a walk through its trees."""
    import re

    from pyspark.ml.classification import RandomForestClassifier
    seen = []

    class Watched(RandomForestClassifier):
        def fit(self, dataset, params=None):
            model = super().fit(dataset, params)
            seen.append((dataset.collect(), model))
            return model
    monkeypatch.setattr(S, "RandomForestClassifier", Watched)
    rnd = random.Random(8)
    rows, planted = documents()
    rows = [(i, text, [None, "", "src/a.py", "notes/é.txt"][i % 4]) for i, text in rows]
    for i in range(500, 560):  # the rules can't tell these
        run = "".join(rnd.choice("abcDEF0123456789+/") for _ in range(rnd.randint(16, 60)))
        rows.append((i, ["the on %s the", "a/path \"%s\" on", "id %s, on"][i % 3] % run, "src/b.py"))
    texts = {i: (text, path) for i, text, path in rows}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    dictionary = S.frequent_words(docs)
    got = {r["doc_id"]: r for r in S.scan(docs).collect()}
    spans = {i: [m.span() for m in re.finditer("[A-Za-z0-9+/_-]{16,}", text)] for i, (text, _) in texts.items()}
    x = {(i, *s): brute_features(texts[i][0], *s, texts[i][1], dictionary) for i in spans for s in spans[i]}
    labelled = sorted(([round(v, 9) for v in x[i, *s]], float(planted.get(i) == s))
                      for i in spans if i < 500 for s in spans[i])
    (learned, model), = seen
    learned = sorted(([round(v, 9) for v in r["features"].tolist()], r["label"]) for r in learned)
    assert learned == labelled and len(learned) > 300 and {y for _, y in learned} == {0.0, 1.0}
    trees = [tree_of(t._call_java("rootNode")) for t in model.trees]
    scores = {k: brute_score(trees, v) for k, v in x.items()}
    for i in texts:
        want = [(s, scores[i, *s]) for s in spans[i] if scores[i, *s] >= 0.5]
        assert got[i]["n_candidates"] == len(spans[i])
        assert [(s["start"], s["end"]) for s in got[i]["secrets"]] == [s for s, _ in want]
        assert all(abs(s["score"] - p) < 1e-9 for s, (_, p) in zip(got[i]["secrets"], want))
