"""Quality classifier by co-training on two views of a document.

The text view sees what a text is made of (byte shares, words, repetition);
the metadata view sees source, language tag and stated length.  Each view
has its own logistic regression.  Over several rounds each one labels all
unlabelled documents, and every label it is confident of becomes a training
row of the *other* view.  Both are then calibrated on labelled rows that they
were not trained on, and a small logistic model combines the two calibrated
views into the score of every document.

At most about ``LABELLED`` labelled documents are used, drawn by a hash of
their id; they go to the driver.  The unlabelled ones are the whole corpus and
stay where they are: their features are written once, and every Newton step is
one pass in which each task adds up the gradients and curvatures of its
confident rows.  What they weigh together, against the labelled rows, is fixed
per class and round (``SHARE``), so it does not depend on the corpus' size.
Scoring is one map over all documents without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.shared import col, stored, text_of
from barlake.llm.vectors import list_column, list_rows

LABELLED = 20_000
ROUNDS = 4
# Newton steps per round, the confidence that a pseudo-label needs, and what all pseudo-labels of a
# class weigh after the first round, as a share of the labelled rows; later rounds add as much each.
STEPS = 2
CONFIDENT = 0.97
SHARE = 0.03
# Tasks' sums are first added up in so many groups.
SUM_SLOTS = 32
RIDGE = 1.0
KEEP_FROM = 0.5
META = ("source", "lang", "n_chars")
SOURCE_SLOTS, LANG_SLOTS, LENGTH_SLOTS = 64, 16, 24
TEXT_FEATURES = 128 + 5
META_FEATURES = SOURCE_SLOTS + LANG_SLOTS + LENGTH_SLOTS


def text_features(text: str) -> np.ndarray:
    """Square roots of the byte shares (all non-ASCII as one), word length, repetition and size."""
    x = np.zeros(TEXT_FEATURES)
    raw = text.encode("utf-8", errors="replace")
    if not raw:
        return x
    share = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256) / len(raw)
    x[:128] = np.sqrt(share[:128])
    x[128] = np.sqrt(share[128:].sum())
    words = text.split()
    if words:
        x[129] = min(len(text) / len(words), 40) / 10
        x[130] = len(set(words)) / len(words)
        x[131] = sum(map(eq, words, words[1:])) / len(words)
    x[132] = np.log1p(len(text)) / 10
    return x


def meta_slots(source: str | None, lang: str | None, n_chars: float | None) -> tuple[int, int, int]:
    """One slot each for the source, the language tag and the stated length; nulls have slots too.

    Sources are hashed: of many hosts those that share a slot share its weight.
    """
    length = 0 if n_chars is None or not n_chars >= 0 else 1 + min(int(np.log2(n_chars + 1)), LENGTH_SLOTS - 2)
    return (zlib.crc32(b"\0" if source is None else source.encode("utf-8", "replace")) % SOURCE_SLOTS,
            SOURCE_SLOTS + zlib.crc32(b"\0" if lang is None else lang.encode("utf-8", "replace")) % LANG_SLOTS,
            SOURCE_SLOTS + LANG_SLOTS + length)


def one_hot(slots: np.ndarray) -> np.ndarray:
    x = np.zeros((len(slots), META_FEATURES))
    x[np.arange(len(slots))[:, None], slots] = 1
    return x


def features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Text features and metadata slots of a batch with columns text, source, lang, n_chars."""
    a = np.array([text_features(t) for t in batch.column("text").to_pylist()]).reshape(-1, TEXT_FEATURES)
    b = np.array([meta_slots(*m) for m in zip(*(batch.column(c).to_pylist() for c in META))], dtype=np.int32)
    return a, b.reshape(-1, 3)


def views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Both feature matrices of a batch."""
    a, slots = features(batch)
    return a, one_hot(slots)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights and bias (last) by Newton steps; the bias is not shrunk."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[-1] = 1e-6
    for _ in range(30):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(shrink),
                               x.T @ (p - y) + shrink * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def logits(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


@dataclass
class Model:
    text: np.ndarray
    meta: np.ndarray
    text_scale: np.ndarray
    meta_scale: np.ndarray
    mix: np.ndarray

    def score(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated text view, calibrated metadata view, both combined."""
        la = logits(logits(a, self.text)[:, None], self.text_scale)
        lb = logits(logits(b, self.meta)[:, None], self.meta_scale)
        return sigmoid(la), sigmoid(lb), sigmoid(logits(np.column_stack([la, lb]), self.mix))


def with_bias(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1))])


def newton_sums(x: np.ndarray, label: float, w: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, gradient, curvature) of rows of one label at the weights ``w``."""
    x = with_bias(x)
    p = sigmoid(x @ w)
    return len(x), x.T @ (p - label), (x * (p * (1 - p))[:, None]).T @ x


def pool_sums(views: tuple[np.ndarray, np.ndarray], teachers: list[np.ndarray], w: list[np.ndarray],
              confident: float) -> np.ndarray:
    """What a step needs of some unlabelled rows: the sums of each view's pseudo-labelled rows by class, end to end.

    The labels of a view's rows are those that the other view's teacher is confident of.
    """
    out = []
    for v in (0, 1):
        p = sigmoid(logits(views[1 - v], teachers[1 - v]))
        for label, sure in ((0.0, p <= 1 - confident), (1.0, p >= confident)):
            n, gradient, curvature = newton_sums(views[v][sure], label, w[v])
            out += [[float(n)], gradient, curvature.reshape(-1)]
    return np.concatenate(out)


def split_sums(flat: np.ndarray, sizes: list[int]) -> list[list[tuple[float, np.ndarray, np.ndarray]]]:
    """The sums of :func:`pool_sums` again, by view and class."""
    out, at = [], 0
    for d in sizes:
        out.append([])
        for _ in range(2):
            out[-1].append((flat[at], flat[at + 1:at + 1 + d], flat[at + 1 + d:at + 1 + d + d * d].reshape(d, d)))
            at += 1 + d + d * d
    return out


class ArrayPool:
    """Unlabelled rows held in memory."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.views = a, b

    def sums(self, teachers: list[np.ndarray], w: list[np.ndarray]) -> np.ndarray:
        return pool_sums(self.views, teachers, w, CONFIDENT)


class StoredPool:
    """Unlabelled rows as a table of features ``a`` and slots ``b``: every step is one pass over all of it."""

    def __init__(self, rows: DataFrame):
        self.rows = rows.select("a", "b")

    def sums(self, teachers: list[np.ndarray], w: list[np.ndarray]) -> np.ndarray:
        size, confident = 2 * sum(1 + len(x) + len(x) ** 2 for x in w), CONFIDENT

        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for b in batches:
                if b.num_rows:
                    _, text = list_rows(b.column("a"), TEXT_FEATURES)
                    _, slots = list_rows(b.column("b"), 3)
                    total += pool_sums((text.astype(float), one_hot(slots)), teachers, w, confident)
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict({"slot": pa.array([task % SUM_SLOTS], pa.int32()),
                                              "task": pa.array([task], pa.int32()), "total": [total.tobytes()]})

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            slots: dict[int, np.ndarray] = {}
            for b in batches:
                for slot, total in zip(b.column("slot").to_pylist(), b.column("total")):
                    slots[slot] = slots.get(slot, 0) + np.frombuffer(total.as_py())
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots, pa.int32()), pa.array([x.tobytes() for x in slots.values()], pa.binary())],
                ["slot", "total"])

        by_task = self.rows.mapInArrow(of, "slot int, task int, total binary")
        by_slot = (by_task.repartition(SUM_SLOTS, "slot").sortWithinPartitions("slot", "task")
                   .mapInArrow(add, "slot int, total binary"))
        found = by_slot.collect()  # at most SUM_SLOTS rows of fixed size
        return sum((np.frombuffer(r["total"]) for r in sorted(found, key=lambda r: r["slot"])), np.zeros(size))


def co_train(a: np.ndarray, b: np.ndarray, y: np.ndarray, pool, rounds: int = ROUNDS) -> Model:
    """Co-train on labelled rows ``(a, b, y)`` and a pool of unlabelled ones; every fifth labelled row calibrates.

    In each round the views as they were at its start label the pool for each
    other, and both take ``STEPS`` Newton steps on the labelled rows and all
    confident pseudo-labels.
    """
    hold = np.arange(len(y)) % 5 == 0
    if len(set(y[hold])) < 2 or len(set(y[~hold])) < 2:
        hold = np.zeros(len(y), dtype=bool)
    labelled = [x[~hold] for x in (a, b)]
    w = [fit_logistic(x, y[~hold]) for x in labelled]
    for k in range(1, rounds + 1):
        teachers = [x.copy() for x in w]
        mass = SHARE * k * len(labelled[0])
        for _ in range(STEPS):
            sums = split_sums(pool.sums(teachers, w), [len(x) for x in w])
            for v in (0, 1):
                shrink = np.full(len(w[v]), RIDGE)
                shrink[-1] = 1e-6
                gradient, curvature = shrink * w[v], np.diag(shrink)
                for label in (0.0, 1.0):
                    _, g, h = newton_sums(labelled[v][y[~hold] == label], label, w[v])
                    n, pool_g, pool_h = sums[v][int(label)]
                    weight = min(1.0, mass / max(n, 1.0))
                    gradient, curvature = gradient + g + weight * pool_g, curvature + h + weight * pool_h
                w[v] = w[v] - np.linalg.solve(curvature + 1e-9 * np.eye(len(w[v])), gradient)
    held = hold if hold.any() else ~hold
    scale = [fit_logistic(logits(x[held], v)[:, None], y[held], 1e-3) for x, v in ((a, w[0]), (b, w[1]))]
    both = np.column_stack([logits(logits(x[held], v)[:, None], s) for x, v, s in zip((a, b), w, scale)])
    return Model(w[0], w[1], scale[0], scale[1], fit_logistic(both, y[held], 1e-2))


def inputs(docs: DataFrame, text_col: str, meta_cols: tuple[str, ...]) -> list[Column]:
    """Columns text, source, lang, n_chars; a missing metadata column is null."""
    have = {name: col(c) if c in docs.columns else F.lit(None) for name, c in zip(META, meta_cols)}
    return [text_of(text_col).alias("text"), have["source"].cast("string").alias("source"),
            have["lang"].cast("string").alias("lang"), have["n_chars"].try_cast("double").alias("n_chars")]


def drawn(key: Column, wanted: int, rows: int) -> Column:
    """True for about ``wanted`` of ``rows`` keys, chosen by hash."""
    return F.pmod(F.xxhash64(key, F.lit("draw")), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, wanted / max(rows, 1))))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        meta_cols: tuple[str, ...] = META, label_col: str = "quality", labelled: int = LABELLED) -> Model | None:
    """Fit on about ``labelled`` labelled documents and all others; None without labels of both classes.

    Null labels are ignored; several labels of a document count by their mean
    (0.5 and more is good).  A labelled document that is repeated counts once;
    unlabelled rows, those with a null id among them, count each.
    """
    known = (labels.select(col(id_col).alias("_lid"), col(label_col).cast("double").alias("_y"))
             .where("_lid IS NOT NULL AND _y IS NOT NULL").groupBy("_lid")
             .agg((F.avg("_y") >= 0.5).cast("double").alias("_y")))
    known = known.where(drawn(F.col("_lid"), labelled, known.count()))
    if known.select("_y").distinct().count() < 2:
        return None
    rows = (docs.select(col(id_col).alias("_id"), *inputs(docs, text_col, meta_cols))
            .join(F.broadcast(known), F.col("_id") == F.col("_lid"), "left"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                part = whole.slice(at, 500)
                a, b = features(part)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_y"), list_column(a.astype(np.float32)), list_column(b)],
                    ["id", "y", "a", "b"])

    kind = rows.schema["_id"].dataType.simpleString()
    seen = stored(rows.select("_id", "_y", "text", *META)
                  .mapInArrow(of, f"id {kind}, y double, a array<float>, b array<int>"), "features")
    taught = (seen.where("y IS NOT NULL").groupBy("id").agg(F.first("y").alias("y"), F.min(F.struct("a", "b")).alias("v"))
              .select("id", "y", "v.a", "v.b").toArrow())  # at most about ``labelled`` rows
    order = np.argsort(np.array([zlib.crc32(str(i).encode()) for i in taught.column("id").to_pylist()]), kind="stable")
    y = taught.column("y").to_numpy()[order].astype(float)
    if len(set(y)) < 2:
        return None
    a, b = (np.array(taught.column(v).to_pylist())[order] for v in ("a", "b"))
    return co_train(a.astype(float), one_hot(b), y, StoredPool(seen.where("y IS NULL")))


SCORES = ["p_text", "p_meta", "score", "kept"]


def score_documents(docs: DataFrame, model: Model | None, text_col: str = "text",
                    meta_cols: tuple[str, ...] = META, keep_from: float = KEEP_FROM,
                    only_kept: bool = False) -> DataFrame:
    """All rows and columns of ``docs`` and ``p_text``, ``p_meta``, ``score`` (0 to 1) and ``kept``.

    Without a model every score is 1 and every row is kept.  Null text counts
    as empty; null metadata has values of its own; repeated rows are scored
    alike.  Input columns of the four names are replaced.  ``only_kept``
    returns the kept rows with all columns of ``docs`` instead.
    """
    carried = [c for c in docs.columns if only_kept or c not in SCORES]
    rows = docs.select(*[col(c).alias(f"_in{i}") for i, c in enumerate(carried)], *inputs(docs, text_col, meta_cols))
    out = [f"_in{i}" for i in range(len(carried))]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                part = whole.slice(at, 500)
                if model is None:
                    p = np.ones((3, part.num_rows))
                else:
                    p = np.array(model.score(*views(part)))
                kept = p[2] >= keep_from
                if only_kept:
                    yield part.select(out).filter(pa.array(kept))
                    continue
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in out] + [pa.array(x) for x in p] + [pa.array(kept)], out + SCORES)

    schema = rows.select(*out).schema
    if not only_kept:
        for name in SCORES[:3]:
            schema = schema.add(name, "double")
        schema = schema.add("kept", "boolean")
    return rows.mapInArrow(of, schema).withColumnsRenamed({f"_in{i}": c for i, c in enumerate(carried)})
