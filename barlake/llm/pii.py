"""Personal data spans by weak supervision, in DataFrame functions only.

Candidates are all matches of the four base patterns and of looser ones.
Three labelers vote for (1), against (-1) or abstain (0) on each:

- regex: does the match pass its kind's own check (octets, Luhn, digits)?
- gazetteer: a known top-level domain, calling code, issuer or public range?
- context: do the words before it name the kind, or something else?

Expectation-maximisation over the vote patterns (at most 27 for each kind)
estimates how reliable each labeler is for each kind.  The posteriors train a
naive Bayes span classifier on the form and surroundings of the spans, which
decides on the loose candidates.  Base matches that pass their check are
always spans; those that fail it never are.

Patterns are equal to their plain forms but possessive, with the starts that
cannot match excluded, so that a long run of characters is scanned once.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.shared import col, stored, text_of

KINDS = ["email", "ip", "card", "phone"]
# (kind, loose, pattern); the plain base patterns are
#   [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+      [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   [0-9]([\x20-]?[0-9])+                                  \+[0-9][\x20().0-9-]+[0-9]
PATTERNS = [
    ("email", False, r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", False, r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    ("card", False, r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", False, r"\+[0-9][\x20().0-9-]+[0-9]"),
    ("email", True, r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{2,63}"
                    r"(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z]{2,24}){1,3}(?![A-Za-z0-9])"),
    ("phone", True, r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9.-]*[0-9])"),
]
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
# Gazetteers and context words.
DOMAINS = ("com org net edu gov mil info biz io co me us uk de fr es it nl be ch at pl se no fi dk pt ie cz ru ua "
           "br mx ar cl in cn jp kr au nz za ca eu").split()
CALLING_CODES = ("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 "
                 "81 82 84 86 90 91 92 93 94 95 98 351 352 353 354 358 359 370 371 372 380 385 386 420 421 971 972").split()
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|6011|62|64|65)"
NOT_PUBLIC = r"^(?:0|10|127|169\.254|192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|22[4-9]|2[3-5][0-9])\."
NAMES = {"email": r"e-?mail|contact|write|courriel|correo|kontakt", "ip": r"\bip\b|address|host|server|client",
         "card": r"card|visa|credit|debit|karte|carte|tarjeta", "phone": r"phone|tel|call|fax|mobile|cell|dial"}
OTHERS = r"version|release|section|chapter|isbn|order|invoice|serial|part|item|page|score|price|total|ref"
BEFORE, AFTER = 24, 12
# A loose candidate is a span from this probability on.
ACCEPT = 0.9
ROUNDS, SMOOTH = 100, 1.0
FEATURES = ["length", "digits", "mark", "led", "followed", "named"]


def occurrences(text: Column, number: int, pattern: str, likely: Column) -> Column:
    """Array of (pattern, nth, gap, m, before, head): matches with the text between them.

    ``m`` is null in the last element, the rest after the last match.
    """
    between = F.arrays_zip(F.split(text, pattern, -1).alias("p"),
                           F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    found = F.transform(between, lambda s, i: F.struct(
        F.lit(number).alias("pattern"), i.alias("nth"), F.length(s["p"]).cast("bigint").alias("gap"),
        s["m"].alias("m"), F.right(s["p"], F.lit(BEFORE)).alias("before"), F.left(s["p"], F.lit(AFTER)).alias("head")))
    return F.when(likely, found)


def candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """All matches of all patterns with positions, and one row of ``kind`` null per document.

    Columns ``row``, ``id``, ``kind``, ``loose``, ``start``, ``end``, ``m``,
    ``before`` and ``after``; the texts are scanned once and not shuffled.
    """
    text = F.col("text")
    some = {"email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike("[0-9]"),
            "phone": text.contains("+")}
    hints = [some[k] if not loose else
             text.rlike(r"[(\[]at[)\]]") if k == "email" else text.rlike(r"[0-9]{3}[.-][0-9]{4}")
             for k, loose, _ in PATTERNS]
    found = [occurrences(text, i, p, h) for i, ((_, _, p), h) in enumerate(zip(PATTERNS, hints))]
    none = F.struct(F.lit(-1).alias("pattern"), F.lit(0).alias("nth"), F.lit(0).cast("bigint").alias("gap"),
                    F.lit(None).cast("string").alias("m"), F.lit("").alias("before"), F.lit("").alias("head"))
    empty = F.filter(F.array(none), lambda s: F.lit(False))
    rows = (docs.select(col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"),
                        text_of(text_col).alias("text"))
            .select("id", "row", F.inline_outer(reduce(F.concat, [F.coalesce(f, empty) for f in found], F.array(none)))))
    kept = stored(rows, "pii-matches")
    in_order = Window.partitionBy("row", "pattern").orderBy("nth")
    size = F.length("m").cast("bigint")
    end = F.sum(F.col("gap") + F.coalesce(size, F.lit(0).cast("bigint"))).over(in_order)
    kinds = F.create_map(*[F.lit(x) for i, (k, _, _) in enumerate(PATTERNS) for x in (i, k)])
    loose = F.create_map(*[F.lit(x) for i, (_, b, _) in enumerate(PATTERNS) for x in (i, b)])
    return (kept.withColumn("end", end).withColumn("after", F.lead("head", 1, "").over(in_order))
            .where("m IS NOT NULL OR pattern = -1")
            .select("row", "id", kinds[F.col("pattern")].alias("kind"), loose[F.col("pattern")].alias("loose"),
                    (F.col("end") - size).alias("start"), F.when(F.col("m").isNotNull(), F.col("end")).alias("end"),
                    "m", "before", "after"))


def checked(found: DataFrame) -> DataFrame:
    """Adds ``passes`` (the kind's own check), the three votes and the span features.

    A card run of 13 to 15 digits that passes Luhn becomes a loose candidate.
    """
    m, digits = F.col("m"), F.regexp_replace("m", "[^0-9]", "")
    count = F.length(digits)
    luhn = F.call_function("luhn_check", digits)

    def by_kind(**of: Column) -> Column:
        return F.coalesce(*[F.when(F.col("kind") == k, c) for k, c in of.items()])

    domain = F.lower(F.regexp_extract("m", r"([A-Za-z0-9-]+)$", 1))
    code = reduce(lambda a, c: a | digits.startswith(c), CALLING_CODES, F.lit(False))
    short = (F.col("kind") == "card") & count.between(13, 15) & luhn
    passes = by_kind(email=F.lit(True), ip=m.rlike(f"^{OCTET}(?:\\.{OCTET}){{3}}$"),
                     card=count.between(16, 19) & luhn, phone=count.between(8, 15))
    known = by_kind(email=domain.isin(DOMAINS), ip=~m.rlike(NOT_PUBLIC), card=digits.rlike(ISSUERS),
                    phone=F.when(F.col("loose"), digits.rlike("^[2-9]")).otherwise(code))
    lead = F.lower("before")
    named = by_kind(**{k: lead.rlike(v) for k, v in NAMES.items()})

    def vote(c: Column) -> Column:
        return F.when(c, 1).otherwise(-1)

    first = F.substring("after", 1, 1)
    last = F.right("before", F.lit(1))
    return (found.where("kind IS NOT NULL")
            .withColumn("loose", F.col("loose") | short)
            .withColumn("passes", ~F.col("loose") & passes)
            .withColumn("v_regex", F.when(F.col("loose"), 0).otherwise(vote(passes)))
            .withColumn("v_gazetteer", vote(known))
            .withColumn("v_context", F.when(named, 1).when(lead.rlike(OTHERS), -1).otherwise(0))
            .withColumn("length", F.least(F.floor(F.length("m") / 4), F.lit(10)).cast("string"))
            .withColumn("digits", F.least(count, F.lit(20)).cast("string"))
            .withColumn("mark", F.when(m.rlike("[()]"), "()").when(m.rlike(r"\x20"), "blank")
                        .when(m.contains("-"), "-").otherwise("none"))
            .withColumn("led", F.when(last == "", "start").when(last.rlike(r"[\s(\[\"':]"), "open").otherwise("tight"))
            .withColumn("followed", F.when(first == "", "stop").when(first.rlike(r"[\s)\]\"',.;]"), "open").otherwise("tight"))
            .withColumn("named", F.col("v_context").cast("string")))


VOTES = ["v_regex", "v_gazetteer", "v_context"]


def reliabilities(patterns: list[tuple[str, tuple[int, ...], int]]) -> dict[tuple[str, tuple[int, ...]], float]:
    """EM over (kind, votes, count): the probability that a span with these votes is personal data.

    Starts from the majority of the votes, so the classes cannot change places.
    """
    post = {(k, v): 0.5 + 0.4 * (sum(v) > 0) - 0.4 * (sum(v) < 0) for k, v, _ in patterns}
    for _ in range(ROUNDS):
        mass: dict = defaultdict(lambda: SMOOTH)
        for k, v, n in patterns:
            p = post[k, v]
            for y, w in ((1, p), (0, 1 - p)):
                mass[k, y] += n * w
                for j, x in enumerate(v):
                    mass[k, y, j, x] += n * w
        new = {}
        for k, v, _ in patterns:
            odds = math.log(mass[k, 1] / mass[k, 0])
            for j, x in enumerate(v):
                total = [sum(mass[k, y, j, z] for z in (-1, 0, 1)) for y in (0, 1)]
                odds += math.log(mass[k, 1, j, x] / total[1]) - math.log(mass[k, 0, j, x] / total[0])
            new[k, v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        moved = max((abs(new[x] - post[x]) for x in new), default=0.0)
        post = new
        if moved < 1e-9:
            break
    return post


def table_of(values: dict) -> Column:
    """Literal map with string keys."""
    return F.create_map(*[F.lit(x) for k, v in values.items() for x in (k, float(v))])


def classify(spans: DataFrame) -> DataFrame:
    """Adds ``p``: the naive Bayes probability of a span, learned from the labelers' posteriors.

    The driver holds vote patterns and feature values only: at most 27 per
    kind, and a few dozen per kind and feature.
    """
    grouped = spans.groupBy("kind", *VOTES).agg(F.count(F.lit(1)).alias("n")).collect()
    post = reliabilities(sorted((r["kind"], tuple(r[v] for v in VOTES), r["n"]) for r in grouped))
    if not post:
        return spans.withColumn("p", F.lit(None).cast("double"))
    key = F.concat_ws(":", "kind", *VOTES)
    soft = spans.withColumn("y", table_of({":".join([k, *map(str, v)]): p for (k, v), p in post.items()})[key])
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("x")) for f in FEATURES]))
    seen = (soft.select("kind", "y", values.alias("v")).groupBy("kind", "v.f", "v.x")
            .agg(F.sum("y").alias("yes"), F.sum(1 - F.col("y")).alias("no")).collect())
    total: dict = defaultdict(lambda: [0.0, 0.0, 0])
    for r in seen:
        t = total[r["kind"], r["f"]]
        t[0], t[1], t[2] = t[0] + r["yes"], t[1] + r["no"], t[2] + 1
    weight, prior = {}, {}
    for r in seen:
        yes, no, n = total[r["kind"], r["f"]]
        weight[f"{r['kind']}:{r['f']}:{r['x']}"] = (
            math.log((r["yes"] + SMOOTH) / (yes + SMOOTH * n)) - math.log((r["no"] + SMOOTH) / (no + SMOOTH * n)))
        prior[r["kind"]] = math.log((yes + SMOOTH) / (no + SMOOTH))
    odds = table_of(prior)[F.col("kind")]
    for f in FEATURES:
        own = {k: v for k, v in weight.items() if k.split(":", 2)[1] == f}
        odds = odds + F.coalesce(table_of(own)[F.concat_ws(":", "kind", F.lit(f), F.col(f))], F.lit(0.0))
    return spans.withColumn("p", 1 / (1 + F.exp(-odds)))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``spans``, sorted by kind as listed, then start.

    A span is ``struct(order, start, end, kind, base)`` in code points, end
    exclusive.  Null text counts as empty; documents without spans have an
    empty array; null ids stay null; repeated rows are reported each.  An
    empty table gives an empty result; other columns are not used.
    """
    found = candidates(docs, id_col, text_col)
    spans = classify(stored(checked(found), "pii-candidates"))
    judged = spans.select("row", "start", "end", "kind", F.col("passes").alias("base"),
                          (F.col("loose") & (F.col("p") >= ACCEPT)).alias("extra")).where("base OR extra")
    ahead = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    behind = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    clear = (judged.withColumn("upto", F.max(F.when(F.col("base"), F.col("end"))).over(ahead))
             .withColumn("from", F.min(F.when(F.col("base"), F.col("start"))).over(behind))
             .where(F.col("base") | ((F.coalesce("upto", F.lit(0)) <= F.col("start"))
                                     & (F.coalesce("from", F.col("end")) >= F.col("end")))))
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    span = F.struct(order[F.col("kind")].alias("order"), "start", "end", "kind", "base")
    whole = (found.where("kind IS NULL").select("row", "id", F.lit(None).cast(
        "struct<order:int,start:bigint,end:bigint,kind:string,base:boolean>").alias("span"))
        .unionByName(clear.select("row", span.alias("span")), allowMissingColumns=True))
    return (whole.groupBy("row").agg(F.first("id", ignorenulls=True).alias(id_col),
                                     F.sort_array(F.collect_list("span")).alias("spans")).drop("row"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
