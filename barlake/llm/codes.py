"""Vectors as codes: a codebook per part, searched by a trie over the distinct parts.

A vector is cut into equal parts; each part position has a codebook of
entries.  The distinct parts of a chunk of vectors, in lexicographic order,
are a trie whose levels are the part's dimensions.  The trie is walked depth
first; a node adds its value's squared differences from all entries to its
parent's vector of distances, so parts that share a prefix share that work.
A leaf takes the smallest of its distances, and its part times how often it
occurs goes into its entry's sums.  Subtrees of at most ``LEAVES`` leaves are
expanded level by level at once, which bounds the distances held.

A round is one pass without a shuffle of vectors: every task hands on the
sums of its parts, one row per entry, and an aggregation adds them up.  The
driver holds the codebooks (parts x entries x part dimensions).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.shared import stored
from barlake.llm.vectors import chunks, component_sums, integer_vectors, list_column, list_rows

DIMS = 64
SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
# Vectors whose parts make one trie, and leaves of a subtree expanded at once.
ROWS_AT_ONCE = 1 << 15
LEAVES = 2048


class PartTrie:
    """The distinct parts of a matrix, as the nodes of a lexicographic trie.

    ``start[j]`` has, per node of level j, the number of its first leaf;
    ``value[j]`` its value's place in ``values[j]``.
    """

    def __init__(self, parts: np.ndarray):
        self.parts = parts
        self.values, codes = [], []
        key, keys = np.zeros(len(parts), dtype=np.int64), 1
        for j in range(parts.shape[1]):
            values, code = np.unique(parts[:, j], return_inverse=True)
            if keys * len(values) >= 1 << 62:  # number the prefixes found so far anew, in order
                found, key = np.unique(key, return_inverse=True)
                keys = len(found)
            key, keys = key * len(values) + code, keys * len(values)
            self.values.append(values)
            codes.append(code)
        leaves, self.first, self.leaf_of, self.count = np.unique(
            key, return_index=True, return_inverse=True, return_counts=True)
        self.start, self.value = [], []
        changed = np.zeros(len(leaves), dtype=bool)
        for code in codes:
            of_leaf = code[self.first]
            changed[1:] |= of_leaf[1:] != of_leaf[:-1]
            changed[:1] = True
            at = np.flatnonzero(changed)
            self.start.append(at)
            self.value.append(of_leaf[at])

    def nearest(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of every leaf; ties go to the lower entry."""
        n = len(self.first)
        best, far = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
        # squared difference of each distinct value from each entry, per dimension
        table = [(v[:, None] - entries[None, :, j]) ** 2 for j, v in enumerate(self.values)]
        depth = len(table)

        def nodes(level: int, low: int, high: int) -> slice:
            return slice(*np.searchsorted(self.start[level], [low, high]))

        def expand(level: int, low: int, high: int, shared: np.ndarray) -> None:
            """All levels below the node of leaves ``low:high`` whose distances are ``shared``."""
            held, held_start = shared[None, :], np.array([low])
            for j in range(level, depth):
                own = nodes(j, low, high)
                parent = np.searchsorted(held_start, self.start[j][own], side="right") - 1
                held, held_start = held[parent] + table[j][self.value[j][own]], self.start[j][own]
            best[low:high] = held.argmin(axis=1)
            far[low:high] = held[np.arange(high - low), best[low:high]]

        todo = [(0, 0, n, np.zeros(entries.shape[0], dtype=np.int64))] if n else []
        while todo:
            level, low, high, shared = todo.pop()
            if high - low <= LEAVES or level == depth - 1:
                for a in range(low, high, LEAVES):
                    expand(level, a, min(a + LEAVES, high), shared)
                continue
            own = nodes(level, low, high)
            ends = np.append(self.start[level][own][1:], high)
            children = list(zip(self.start[level][own].tolist(), ends.tolist(), self.value[level][own].tolist()))
            # runs of small subtrees are expanded together, from their common parent
            run = None
            for a, z, v in children:
                if z - a > LEAVES:
                    if run is not None:
                        expand(level, run, a, shared)
                        run = None
                    todo.append((level + 1, a, z, shared + table[level][v]))
                elif run is None:
                    run = a
                elif z - run > LEAVES:
                    expand(level, run, a, shared)
                    run = a
            if run is not None:
                expand(level, run, high, shared)
        return best, far

    def sums(self, best: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
        """(count, sum of the parts) per entry: each distinct part weighted by how often it occurs."""
        count = np.zeros(entries, dtype=np.int64)
        total = np.zeros((entries, self.parts.shape[1]), dtype=np.int64)
        np.add.at(count, best, self.count)
        np.add.at(total, best, self.parts[self.first] * self.count[:, None])
        return count, total


def part_slices(dims: int, parts: int) -> list[slice]:
    """The columns of each part."""
    size = dims // parts
    return [slice(p * size, (p + 1) * size) for p in range(parts)]


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    """The parts of the ``entries`` vectors with the smallest ids (null ids last), as (part, entry, dimension)."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    if not first:
        return np.zeros((parts, 0, 0), dtype=np.int64)
    whole = np.array([r["v"] for r in first], dtype=np.int64)
    return np.stack([whole[:, s] for s in part_slices(whole.shape[1], parts)])


def next_codebooks(rows: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Every entry replaced by floor(sum / count) of the parts nearest to it; one without parts stays."""
    parts, entries, size = codebooks.shape

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, entries), dtype=np.int64)
        total = np.zeros((parts, entries, size), dtype=np.int64)
        for b in chunks(batches, ROWS_AT_ONCE):
            v = list_rows(b.column("v"), parts * size)[1]
            for p, columns in enumerate(part_slices(parts * size, parts)):
                trie = PartTrie(v[:, columns])
                n, s = trie.sums(trie.nearest(codebooks[p])[0], entries)
                count[p] += n
                total[p] += s
        used = np.flatnonzero(count)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array(count.reshape(-1)[used]), list_column(total.reshape(-1, size)[used])],
                ["entry", "n", "total"])

    partial = rows.select("v").mapInArrow(of, "entry bigint, n bigint, total array<bigint>")
    moved = codebooks.copy()
    for r in component_sums(partial, "entry").collect():  # at most parts x entries x size rows
        moved[(*divmod(r["entry"], entries), r["at"])] = int(r["total"]) // r["n"]
    return moved


def encoded(rows: DataFrame, codebooks: np.ndarray, carry: list[str]) -> DataFrame:
    """``id``, ``code`` (one entry number per part) and ``error`` (squared distances summed) of every vector."""
    parts, _, size = codebooks.shape

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, ROWS_AT_ONCE):
            v = list_rows(b.column("v"), parts * size)[1]
            code, error = np.empty((len(v), parts), dtype=np.int32), np.zeros(len(v), dtype=np.int64)
            for p, columns in enumerate(part_slices(parts * size, parts)):
                trie = PartTrie(v[:, columns])
                best, far = trie.nearest(codebooks[p])
                code[:, p] = best[trie.leaf_of]
                error += far[trie.leaf_of]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), list_column(code), pa.array(error), *map(b.column, carry)],
                ["id", "code", "error", *carry])

    types = "".join(f", {x} {rows.schema[x].dataType.simpleString()}" for x in carry)
    return rows.mapInArrow(of, "id bigint, code array<int>, error bigint" + types)


@dataclass
class Compressed:
    """What :func:`compress` gives: ``rows`` (id, ``code``, ``error``, carried columns) and ``codebooks``."""
    rows: DataFrame
    codebooks: np.ndarray

    def codebook_text(self) -> str:
        """All components by part, entry and position, as decimal integers joined by commas."""
        return ",".join(map(str, self.codebooks.reshape(-1).tolist()))


def compress(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             dims: int = DIMS, id_col: str = "vec_id", vec_col: str = "embedding",
             carry: tuple[str, ...] = ()) -> Compressed:
    """Learn the codebooks and encode every vector; the encoded rows are written once.

    Which vectors count, see :func:`barlake.llm.vectors.integer_vectors`;
    ``dims`` must be a multiple of ``parts``.  Repeated rows each count; rows
    of one id start by component order, null ids last; fewer than ``entries``
    vectors make as many entries; an empty table gives no rows and empty
    codebooks.  ``carry`` columns (of any name and type, nulls included) come
    along unchanged; other columns of ``df`` are not used.
    """
    if dims % parts:
        raise ValueError(f"{dims} dimensions cannot be cut into {parts} equal parts")
    rows = integer_vectors(df, scale, dims, id_col, vec_col, carry)
    codebooks = first_codebooks(rows, parts, entries)
    extra = [f"carry{i}" for i in range(len(carry))]
    if codebooks.shape[1]:
        for _ in range(rounds):
            codebooks = next_codebooks(rows, codebooks)
        found = stored(encoded(rows, codebooks, extra), "codes")
    else:
        found = rows.selectExpr("id", "cast(null as array<int>) as code", "cast(0 as bigint) as error", *extra)
    return Compressed(found, codebooks)


def with_group_error(rows: DataFrame, group: str) -> DataFrame:
    """``rows`` with ``group_error``: ``error`` summed over the rows of an equal ``group`` value, nulls together.

    The sums are an ordinary aggregation and are joined back by value; one
    row per value, broadcast only if the planner measures it as small.
    """
    sums = rows.groupBy(F.col(group).alias("_value")).agg(F.sum("error").alias("group_error"))
    return rows.join(sums, F.col(group).eqNullSafe(F.col("_value")), "left").drop("_value")


def code_text(code: Column) -> Column:
    """A code of up to 256 entries as text: two lower-case hex digits per part."""
    return F.array_join(F.transform(code, lambda k: F.lower(F.lpad(F.hex(k), 2, "0"))), "")


def decode(code: Column | str, codebooks: np.ndarray, scale: int = SCALE) -> Column:
    """The vector that a ``code`` stands for: its entries' integers divided by ``scale``; null for null."""
    parts, _, size = codebooks.shape

    @F.arrow_udf("array<double>")
    def vectors(codes: pa.Array) -> pa.Array:
        found = codes.is_valid().to_numpy(zero_copy_only=False)
        k = codes.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, parts)
        whole = codebooks[np.arange(parts), k].reshape(len(k), parts * size) / scale
        ends = np.concatenate([[0], np.cumsum(found * parts * size)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(whole.reshape(-1)), mask=pa.array(~found))

    return vectors(code)
