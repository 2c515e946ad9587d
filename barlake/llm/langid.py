"""Language identification by rank-order n-gram profiles.

A profile is the list of the ``PROFILE`` most frequent letter n-grams (1 to 3
letters, words bounded by blanks).  Profiles of the languages are counted
over every training document; a document's own profile is compared with each
by the out-of-place distance: the sum of rank differences, with ``PROFILE``
for an n-gram the language does not have.

Counts are summed in the Python worker, then by Spark with map-side
combining, so a common language costs one row per n-gram and task.  Only
profiles are broadcast, those of so many languages at a time.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.shared import col, stored, text_of

PROFILE = 300
LONGEST = 3
# Languages whose profiles are broadcast together, and letters counted at a time.
LANGUAGES_AT_ONCE = 5_000
LETTERS_AT_ONCE = 1 << 20
BITS = 21  # of a code point; three of them fit a 64-bit key
BLANK = 1  # stands for everything that is no letter; not 0, so keys of different lengths differ
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """True at the code points of letters."""
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)


def slices(text: str) -> Iterator[tuple[np.ndarray, int]]:
    """Lower-cased text with each run of other characters as one ``BLANK``, bounded by it, in bounded steps.

    Each slice is led by the points of the one before that an n-gram may
    still need; their number comes with it.
    """
    low = text.lower()  # whole: a letter's lower case may depend on its neighbours
    tail = np.array([BLANK], dtype=np.int64)
    for at in range(0, max(len(low), 1), LETTERS_AT_ONCE):
        raw = np.frombuffer(low[at:at + LETTERS_AT_ONCE].encode("utf-32-le", "replace"), dtype="<u4")
        end = [BLANK] if at + LETTERS_AT_ONCE >= len(low) else []
        points = np.concatenate([tail, np.where(letters()[raw], raw, BLANK), end]).astype(np.int64)
        keep = np.ones(len(points), dtype=bool)
        keep[1:] = (points[1:] != BLANK) | (points[:-1] != BLANK)
        points = points[keep]
        yield points, len(tail)
        tail = points[1 - LONGEST:]


def grams(points: np.ndarray, seen: int = 0) -> np.ndarray:
    """Keys of all n-grams that end after the first ``seen`` points.

    A blank may be an n-gram's first or last character, not one within.
    """
    key = points
    parts = [points[seen:][points[seen:] != BLANK]]
    for n in range(2, LONGEST + 1):
        key = (key[:-1] << BITS) | points[n - 1:]
        within = [points[k:len(points) - n + 1 + k] != BLANK for k in range(1, n - 1)]
        new = np.arange(len(key)) >= seen - n + 1
        parts.append(key[np.logical_and.reduce([new, *within])])
    return np.concatenate(parts)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text and their counts, over the whole text in bounded steps."""
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for points, seen in slices(text):
        k, c = np.unique(grams(points, seen), return_counts=True)
        if len(keys):
            both, place = np.unique(np.concatenate([keys, k]), return_inverse=True)
            keys, counts = both, np.bincount(place, weights=np.concatenate([counts, c])).astype(np.int64)
        else:
            keys, counts = k, c
    return keys, counts


def profile(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The most frequent n-grams in rank order; ties by key."""
    return keys[np.lexsort((keys, -counts))[:PROFILE]]


def learn(docs: DataFrame, training: Column, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Profile of each language over all training rows with a language and a letter, written once.

    One row per language and n-gram: ``lang``, ``gram`` and ``nth`` (its rank;
    equally frequent n-grams rank by key).  Null texts and languages teach
    nothing; repeated rows count each; texts of any length count whole.  Other
    columns are not read, whatever they are called; an empty table teaches no
    language.
    """
    rows = docs.where(training & col(lang_col).isNotNull()).select(
        col(lang_col).cast("string").alias("lang"), text_of(text_col).alias("text"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def flush():
            for lang, parts in held.items():
                k = np.concatenate([p[0] for p in parts])
                keys, place = np.unique(k, return_inverse=True)
                total = np.bincount(place, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys),
                                                  pa.array(total)], ["lang", "gram", "n"])

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                k, c = counted(text)
                if len(k):
                    held.setdefault(lang, []).append((k, c))
                    size += len(k)
                if size > LETTERS_AT_ONCE:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    counts = (rows.mapInArrow(of, "lang string, gram bigint, n bigint")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("nth", nth).where(F.col("nth") <= PROFILE).select("lang", "gram", "nth")
    return stored(top, "profiles")


def as_lists(profiles: DataFrame) -> dict[str, list[int]]:
    """The profiles of a bounded number of languages."""
    found: dict[str, list[int]] = {}
    for r in sorted(profiles.collect(), key=lambda r: (r["lang"], r["nth"])):
        found.setdefault(r["lang"], []).append(r["gram"])
    return found


class Identifier:
    """Distances of a document to all profiles at once."""

    def __init__(self, profiles: dict[str, list[int]]):
        self.langs = sorted(profiles)
        self.vocab = np.unique(np.concatenate([np.array(profiles[x], dtype=np.int64) for x in self.langs]))
        self.rank = np.full((len(self.vocab) + 1, len(self.langs)), -1, dtype=np.int32)
        for j, lang in enumerate(self.langs):
            self.rank[np.searchsorted(self.vocab, profiles[lang]), j] = np.arange(len(profiles[lang]))

    def distances(self, own: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.vocab, own)
        at[self.vocab[np.minimum(at, len(self.vocab) - 1)] != own] = len(self.vocab)
        rank = self.rank[at]
        return np.where(rank < 0, PROFILE, np.abs(rank - np.arange(len(own))[:, None])).sum(axis=0)

    def nearest(self, own: np.ndarray) -> tuple[int, str]:
        """(distance, language) of the nearest one; ties go to the first by name."""
        far = self.distances(own)
        best = int(far.argmin())
        return int(far[best]), self.langs[best]


def identify(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             carry: tuple[str, ...] = (), at_once: int = LANGUAGES_AT_ONCE) -> DataFrame:
    """Predict the language of every whole text.

    Columns: the id, those of ``carry``, ``lang_pred`` and ``score`` (0 to 1:
    1 less its distance as a share of the largest possible one).  Null text or
    text without letters gives ``und`` and score 0, as does an empty table of
    profiles.  Equally near languages go by name; repeated rows are predicted
    alike; null ids stay; texts of any length count whole.

    Languages are dealt to blocks of about ``at_once`` by hash and a block's
    profiles are broadcast.  Documents pass the blocks one after another in
    one task, each time keeping the nearest language so far, so any number of
    languages gives the result of all together.
    """
    spark = docs.sparkSession
    blocks = max(1, -(-profiles.select("lang").distinct().count() // at_once))
    names = [id_col, *carry]
    kept = [f"_in{i}" for i in range(len(names))]
    rows = docs.select(*[col(c).alias(k) for c, k in zip(names, kept)], text_of(text_col).alias("_text"),
                       F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    for block in range(blocks):
        some = as_lists(profiles.where(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == block))
        if some:
            rows = rows.mapInArrow(nearer(spark.sparkContext.broadcast(some)), rows.schema)
    return rows.drop("_text").withColumnsRenamed(dict(zip(kept, names)))


def nearer(data):
    """mapInArrow body: replace ``lang_pred`` and ``score`` where a language of the block is nearer, or as near and
    first by name."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Identifier(data.value)
        for b in batches:
            langs, scores = [], []
            for text, lang, score in zip(*(b.column(c).to_pylist() for c in ("_text", "lang_pred", "score"))):
                own = profile(*counted(text))
                if len(own):
                    far, near = block.nearest(own)
                    now = 1.0 - far / (PROFILE * len(own))
                    if lang == UNKNOWN or (-now, near) < (-score, lang):
                        lang, score = near, now
                langs.append(lang)
                scores.append(score)
            yield (b.set_column(b.schema.get_field_index("lang_pred"), "lang_pred", pa.array(langs, pa.string()))
                   .set_column(b.schema.get_field_index("score"), "score", pa.array(scores, pa.float64())))

    return of
