"""Secret scan: candidate strings judged by a random forest.

Candidates are strings of a format that a provider publishes, values assigned
on one line to a telling name, whatever their length and characters, and all
other unbroken runs of at least ``SHORTEST`` key characters.  Strict rules label some of them as findings (provider formats, a mixed value
assigned to a telling name) or as false positives (plain words, numbers,
identifiers, placeholders); findings labelled by hand can be passed instead.
A random forest learns from a bounded number of labelled candidates, on
length, character transitions, dictionary coverage, path and neighbouring
words, and judges every candidate, so false positives of any kind go.  Only a
provider's format that is no placeholder is a finding whatever the forest says.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.shared import col, stored, text_of

SHORTEST = 16
# Characters before a candidate that hold its neighbouring words.
AROUND = 48
# Words of the dictionary (a broadcast of well under a megabyte) and their shortest length.
DICTIONARY, WORD = 5_000, 3
WORD_GROUPS = 64
# Labelled candidates the forest is fitted on, at most about this many.
FINDINGS = 20_000
TREES, DEPTH, SEED = 40, 8, 11
ACCEPT = 0.5
NAME_SLOTS, PATH_SLOTS = 16, 16

# '=' belongs to a run as padding at its end only.
CANDIDATE = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}(?:={1,2}(?![A-Za-z0-9+/=_-]))?" % SHORTEST)
TELLING = re.compile(r"(?i)(?:key|token|secret|passw|pwd|auth|bearer|credential|api)")
ASSIGNED = re.compile(r"[:=]\s*[\"'`]?$")
# Formats that providers publish for their keys.
PROVIDERS = re.compile(
    r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[0-9A-Za-z]{24,}"
    r"|AIza[0-9A-Za-z_-]{35}|glpat-[0-9A-Za-z_-]{20}")
PUBLISHED = re.compile(rf"(?<![A-Za-z0-9])(?:{PROVIDERS.pattern})(?![A-Za-z0-9])")
# An assignment: the name (with a type) that ends at most NAMED characters before its sign, and the value after it.
NAMED = 96
SIGN = re.compile(r"(?<![:=])(?::=|=>|={1,3}|:(?!:))[ \t]*")
NAME = re.compile(r"([?&]?)([\w.-]+)[\"'`\])]{0,2}(?:[ \t]*:[ \t]*[A-Za-z_][\w.\[\]|]*)?[ \t]*$")
SCHEME = re.compile(r"(?i)(?:bearer|basic|token)[ \t]+(?=\S)")
QUOTED = re.compile(r"[A-Za-z]{0,2}([\"'`])((?:\\.|(?!\1)[^\\\n])+)\1")
PLAIN = re.compile(r"[\"'`]*((?:(?![,;&][\w\"'.-]+[:=])\S)+)")
PARAMETER = re.compile(r"([^\s&#\"'`<>]+)")
CODE = re.compile(r"[\s(){}\[\]$<>]")
PUBLISHED_FORMAT, VALUE, RUN = range(3)
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
PLACEHOLDER = re.compile(r"(?i)example|placeholder|your[_-]|changeme|dummy|(.)\1{7}")
HEX = re.compile(r"[0-9a-fA-F]+")
CLASSES = str.maketrans({**{c: "l" for c in "abcdefghijklmnopqrstuvwxyz"}, **{c: "u" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"},
                         **{c: "d" for c in "0123456789"}, **{c: "s" for c in "+/=_-"}})


def shape(word: str) -> str:
    """The class of each character: lower or upper case letter, digit, any other."""
    return re.sub("[^luds]", "s", word.translate(CLASSES))


def assigned(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the values assigned to telling names, from the last to the first."""
    plain = parameter = len(text)  # where the value after begins: values that are not quoted end there
    for m in reversed(list(SIGN.finditer(text))):
        name = NAME.search(text[max(0, m.start() - NAMED):m.start()])
        if not name or not TELLING.search(name[0]):
            continue
        at = m.end()
        if q := QUOTED.match(text, at):
            start, end = q.span(2)
            if scheme := SCHEME.match(text, start, end):
                start = scheme.end()
        else:
            if scheme := SCHEME.match(text, at):
                at = scheme.end()
            v = PARAMETER.match(text, at, parameter) if name[1] else PLAIN.match(text, at, plain)
            if not v:
                continue
            start, end = v.span(1)
            parameter = start
            if not name[1]:
                plain = start
                end = start + len(v[1].rstrip(",;.)]}>\"'`"))
        yield start, end


def spans_in(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of all candidates, none over another.

    Formats come first, then values, the inner of nested ones before the
    outer, then runs; each keeps the parts that those before it leave.
    """
    out, taken = [], bytearray(len(text))

    def add(start: int, end: int, kind: int, shortest: int = 1) -> None:
        while start < end:
            stop = taken.find(1, start, end)
            stop = end if stop < 0 else stop
            if stop - start >= shortest and any(map(str.isalnum, text[start:stop])):
                out.append((start, stop, kind))
            taken[start:stop] = b"\1" * (stop - start)
            rest = taken.find(0, stop, end)
            start = end if rest < 0 else rest

    for m in PUBLISHED.finditer(text):
        add(*m.span(), PUBLISHED_FORMAT)
    for start, end in assigned(text):
        add(start, end, VALUE)
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        bare = start + len(m[0].rstrip("="))
        # a sign after a name is no padding
        if bare < end and ((end - start) % 4 or (text[end:end + 1] in ("'", '"', "`") and text[start - 1:start] != text[end])):
            end = bare
        add(start, end, RUN, SHORTEST)
    return sorted(out)


def coverage(word: str, dictionary: set[str], longest: int = 16) -> float:
    """Share of the characters that dictionary words cover, longest first from the left."""
    low, at, covered = word.lower(), 0, 0
    while at < len(low):
        for size in range(min(longest, len(low) - at), WORD - 1, -1):
            if low[at:at + size] in dictionary:
                covered += size
                at += size
                break
        else:
            at += 1
    return covered / len(low)


def transitions(word: str) -> tuple[float, float, float]:
    """Changes of character class, changes between letter and digit, and entropy in bits."""
    kinds = shape(word)
    pairs = list(zip(kinds, kinds[1:]))
    change = sum(a != b for a, b in pairs) / max(1, len(pairs))
    mixed = sum((a == "d") != (b == "d") for a, b in pairs) / max(1, len(pairs))
    n = len(word)
    return change, mixed, -sum(c / n * math.log2(c / n) for c in Counter(word).values())


def features(word: str, before: str, after: str, path: str | None, dictionary: set[str]) -> list[float]:
    change, mixed, entropy = transitions(word)
    kinds = Counter(shape(word))
    n = len(word)
    names = re.findall(r"[A-Za-z_]+", before)[-3:]
    slots = [0.0] * (NAME_SLOTS + PATH_SLOTS)
    if names:
        slots[zlib.crc32(names[-1].lower().encode()) % NAME_SLOTS] = 1.0
    slots[NAME_SLOTS + zlib.crc32((path or "").encode("utf-8", "replace")) % PATH_SLOTS] = 1.0
    return [float(min(n, 200)), change, mixed, entropy, kinds["d"] / n, kinds["u"] / n, kinds["s"] / n,
            float(HEX.fullmatch(word) is not None), coverage(word, dictionary),
            float(word.count("/")), float(any(TELLING.search(x) for x in names)),
            float(ASSIGNED.search(before) is not None), float(before[-1:] in "\"'`" and after[:1] in "\"'`" and bool(after)),
            *slots]


def rule(word: str, before: str, known: float, kind: int = RUN) -> float | None:
    """1 for a certain finding, 0 for a certain false positive, None if the rules can't tell."""
    kinds = set(shape(word))
    if PLACEHOLDER.search(word) or UUID.fullmatch(word) or (kinds == {"d"} and kind != VALUE):
        return 0.0
    if PROVIDERS.fullmatch(word):
        return 1.0
    if kind == VALUE:
        if CODE.search(word):
            return None
        if "d" in kinds:
            mixed = len(word) >= SHORTEST or (len(word) >= 8 and kinds & {"l", "u"})
            return 1.0 if len(kinds) > 1 and mixed else None
        if before[-1:] in ("'", '"', "`"):
            return None
    if "d" in kinds and len(kinds) > 1 and ASSIGNED.search(before) and TELLING.search(before[-24:]):
        return 1.0
    if "d" not in kinds and (known >= 0.3 or kinds == {"l"} or word[1:].translate(CLASSES).strip("l") == ""):
        return 0.0
    return None


def frequent_words(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> set[str]:
    """The ``size`` most frequent words of letters over all texts; ties by word."""
    words = docs.select(F.explode_outer(F.regexp_extract_all(
        F.lower(text_of(text_col)), F.lit(r"(?<![a-z0-9])[a-z]{3,16}(?![a-z0-9])"), F.lit(0))).alias("w")).where("w IS NOT NULL")
    counts = words.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    # the first of every hash group, then of those: one task ranks groups x size rows, the driver gets ``size``
    group = Window.partitionBy(F.pmod(F.xxhash64("w"), F.lit(WORD_GROUPS))).orderBy(F.desc("n"), "w")
    some = counts.withColumn("nth", F.row_number().over(group)).where(F.col("nth") <= size).drop("nth")
    top = some.repartition(1).orderBy(F.desc("n"), "w").limit(size)
    return {r["w"] for r in top.collect()}


def candidates(docs: DataFrame, dictionary: set[str], id_col: str, text_col: str, path_col: str) -> DataFrame:
    """All candidates with features and rule label, and one row of null ``start`` per document."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)
    path = col(path_col).cast("string") if path_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select(col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"),
                       text_of(text_col).alias("text"), path.alias("path"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                b = whole.slice(k, 500)
                out = []
                for i, (text, where) in enumerate(zip(b.column("text").to_pylist(), b.column("path").to_pylist())):
                    out.append((i, None, None, None, None, None))
                    for start, end, kind in spans_in(text):
                        word, before, after = text[start:end], text[max(0, start - AROUND):start], text[end:end + 1]
                        x = features(word, before, after, where, words)
                        y = rule(word, before, x[8], kind)
                        out.append((i, start, end, x, y, kind == PUBLISHED_FORMAT and y == 1.0))
                at, start, end, x, y, sure = zip(*out)
                at = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(at), b.column("row").take(at), pa.array(start, pa.int64()),
                     pa.array(end, pa.int64()), pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.float64()),
                     pa.array(sure, pa.bool_())],
                    ["id", "row", "start", "end", "x", "rule", "sure"])

    kind = rows.schema["id"].dataType.simpleString()
    return stored(rows.mapInArrow(of, f"id {kind}, row bigint, start bigint, end bigint, x array<double>, rule double, "
                                    "sure boolean"),
                  "secret-candidates")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source",
         labelled: DataFrame | None = None, findings: int = FINDINGS) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_candidates`` and ``secrets``.

    ``secrets`` is an array of struct(start, end, score) in code points, end
    exclusive, by start.  ``labelled`` may name findings checked by hand: id,
    ``start``, ``end`` and ``label`` (1 or 0); it replaces the rules' labels.
    Candidates of a provider's format have score 1 unless labelled 0.

    Null text counts as empty, a null or missing path as the empty path.
    Without labels of both classes nothing can be learned and the certain
    findings are returned with score 1.  Repeated rows are reported each;
    null ids stay null; an empty table gives an empty result.  Texts of any
    length are scanned whole.  Other columns are not returned, whatever they
    are called.
    """
    found = candidates(docs, frequent_words(docs, text_col), id_col, text_col, path_col)
    spans = found.where("start IS NOT NULL")
    if labelled is not None:
        own = labelled.select(col(id_col).alias("_id"), F.col("start").alias("_start"), F.col("end").alias("_end"),
                              F.col("label").cast("double").alias("_label"))
        spans = spans.join(own, (F.col("id") == F.col("_id")) & (F.col("start") == F.col("_start"))
                           & (F.col("end") == F.col("_end")), "left").withColumn("rule", F.col("_label"))
        spans = spans.withColumn("sure", F.col("sure") & F.coalesce(F.col("_label") != 0.0, F.lit(True)))
    known = spans.where("rule IS NOT NULL")
    sizes = {r["rule"]: r["n"] for r in known.groupBy("rule").agg(F.count(F.lit(1)).alias("n")).collect()}
    if {0.0, 1.0} <= sizes.keys():
        # An equal share of either class, drawn by hash: at most about `findings` rows.
        share = F.when(F.col("rule") == 1.0, min(1.0, findings / 2 / sizes[1.0])).otherwise(
            min(1.0, findings / 2 / sizes[0.0]))
        drawn = F.pmod(F.xxhash64("id", "start", F.lit("draw")), F.lit(1 << 30)) < share * (1 << 30)
        train = known.where(drawn).select(array_to_vector("x").alias("features"), F.col("rule").alias("label"))
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt")
        model = forest.fit(stored(train.select(vector_to_array("features").alias("x"), "label"), "secret-labelled")
                           .select(array_to_vector("x").alias("features"), "label").coalesce(4))
        judged = model.transform(spans.withColumn("features", array_to_vector("x")))
        judged = judged.withColumn("score", vector_to_array("probability")[1])
    else:
        judged = spans.withColumn("score", F.coalesce("rule", F.lit(0.0)))
    judged = judged.withColumn("score", F.when(F.col("sure"), 1.0).otherwise(F.col("score")))
    some = judged.select("row", F.struct("start", "end", "score").alias("s"))
    whole = (found.where("start IS NULL").select("row", "id").withColumn("s", F.lit(None).cast(
        "struct<start:bigint,end:bigint,score:double>")).unionByName(some, allowMissingColumns=True))
    spans_of = F.filter(F.sort_array(F.collect_list("s")), lambda s: s["score"] >= ACCEPT)
    return (whole.groupBy("row").agg(F.first("id", ignorenulls=True).alias(id_col),
                                     F.count("s").alias("n_candidates"), spans_of.alias("secrets")).drop("row"))
