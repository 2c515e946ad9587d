"""k-means on integer vectors with the equal-average equal-variance nearest-centroid search.

For vectors x and c of d components with means m and deviations
s = sqrt(sum of (component - mean)^2):

    |x - c|^2  >=  d (m_x - m_c)^2 + (s_x - s_c)^2

Centroids are sorted by mean.  Each vector starts at its own mean and scans
outward, nearer mean first.  As soon as the mean term alone exceeds the best
distance so far, no further centroid can win; a centroid that the sum rejects
is skipped; all others get their exact integer distance.  The inequalities are
evaluated in floating point with a margin far above its error, so that they
only ever skip centroids that cannot win or tie.

A round is one pass without a shuffle of vectors: every task adds up its
vectors per centroid and hands on at most ``k`` rows, which are summed by an
aggregation.  The driver holds ``k`` centroids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.shared import stored
from barlake.llm.vectors import chunks, component_sums, integer_vectors, list_column, list_rows

DIMS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
ROWS_AT_ONCE = 1 << 14
# Share of the squared lengths that the bounds may be off by; their error is below 1e-13.
MARGIN = 1e-9


def spread(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each row's components, times sqrt(d) and 1: their squares add up to its squared length."""
    x = v.astype(np.float64)
    mean = x.mean(axis=1)
    return mean * np.sqrt(x.shape[1]), np.sqrt(((x - mean[:, None]) ** 2).sum(axis=1))


class MeanOrder:
    """Centroids sorted by component mean, searched outward from a vector's mean."""

    def __init__(self, centroids: np.ndarray):
        mean, _ = spread(centroids)
        self.number = np.argsort(mean, kind="stable")
        self.centroids = centroids[self.number]
        self.mean, self.dev = spread(self.centroids)
        self.computed = 0

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, ties to the smaller one; squared distance) of each row."""
        k, n = len(self.centroids), len(v)
        mean, dev = spread(v)
        margin = MARGIN * (mean ** 2 + dev ** 2)
        best = np.full(n, np.iinfo(np.int64).max)
        winner = np.full(n, k)
        right = np.searchsorted(self.mean, mean)
        left = right - 1
        open_rows = np.arange(n)
        for _ in range(k):
            lo, hi, m = left[open_rows], right[open_rows], mean[open_rows]
            below = np.where(lo >= 0, m - self.mean[np.maximum(lo, 0)], np.inf)
            above = np.where(hi < k, self.mean[np.minimum(hi, k - 1)] - m, np.inf)
            down = below <= above
            c = np.where(down, lo, hi)
            left[open_rows] -= down
            right[open_rows] += ~down
            slack = margin[open_rows] + MARGIN * (self.mean[c] ** 2 + self.dev[c] ** 2)
            by_mean = np.minimum(below, above) ** 2 - slack
            go_on = by_mean <= best[open_rows]
            open_rows, c, by_mean = open_rows[go_on], c[go_on], by_mean[go_on]
            if not len(open_rows):
                break
            may = by_mean + (dev[open_rows] - self.dev[c]) ** 2 <= best[open_rows]
            rows, c = open_rows[may], c[may]
            diff = v[rows] - self.centroids[c]
            far = np.einsum("ij,ij->i", diff, diff)
            self.computed += len(rows)
            number = self.number[c]
            wins = (far < best[rows]) | ((far == best[rows]) & (number < winner[rows]))
            best[rows[wins]], winner[rows[wins]] = far[wins], number[wins]
        return winner, best


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``<seed>:<id>``, in that order (a null id counts as empty text)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    return np.array([r["v"] for r in rows.orderBy(key, "v").limit(k).collect()], dtype=np.int64)


def next_centroids(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid replaced by floor(sum / count) of its vectors; one without vectors stays."""
    k, dims = centroids.shape

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = MeanOrder(centroids)
        total, count = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for b in chunks(batches, ROWS_AT_ONCE):
            _, v = list_rows(b.column("v"), dims)
            cluster, _ = order.nearest(v)
            by = np.argsort(cluster, kind="stable")
            found, first = np.unique(cluster[by], return_index=True)
            total[found] += np.add.reduceat(v[by], first, axis=0)
            count += np.bincount(cluster, minlength=k)
        used = np.flatnonzero(count)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array(count[used]), list_column(total[used])], ["cluster", "n", "total"])

    partial = rows.select("v").mapInArrow(of, "cluster bigint, n bigint, total array<bigint>")
    moved = centroids.copy()
    for r in component_sums(partial, "cluster").collect():  # at most k x dims rows
        moved[r["cluster"], r["at"]] = int(r["total"]) // r["n"]
    return moved


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``id``, ``cluster`` and ``distance`` (squared) of every vector; written once."""
    dims = centroids.shape[1]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = MeanOrder(centroids)
        for b in chunks(batches, ROWS_AT_ONCE):
            cluster, far = order.nearest(list_rows(b.column("v"), dims)[1])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(cluster.astype(np.int32)), pa.array(far)], ["id", "cluster", "distance"])

    return stored(rows.select("id", "v").mapInArrow(of, "id bigint, cluster int, distance bigint"), "assigned")


def cluster(df: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, dims: int = DIMS,
            seed: int = 1, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """(vectors with their cluster, clusters).

    Vectors: the id, ``cluster`` and ``distance`` (squared, exact).  Clusters,
    at most ``k`` rows: ``cluster``, ``centroid``, ``n`` (vectors),
    ``cluster_inertia`` (their distances summed) and ``inertia`` (of all).

    Which vectors count, see :func:`barlake.llm.vectors.integer_vectors`.
    Repeated rows each count; vectors with equal hashes start by component
    order; with fewer than ``k`` vectors there are as many clusters; an empty
    table gives none.  Other columns of ``df`` are not used.
    """
    spark = df.sparkSession
    rows = integer_vectors(df, scale, dims, id_col, vec_col)
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return (spark.createDataFrame([], f"`{id_col}` bigint, cluster int, distance bigint"),
                spark.createDataFrame([], "cluster int, centroid array<bigint>, n bigint, cluster_inertia bigint, "
                                          "inertia bigint"))
    for _ in range(rounds):
        centroids = next_centroids(rows, centroids)
    found = assigned(rows, centroids)
    sums = {r["cluster"]: (r["n"], int(r["far"])) for r in found.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("far")).collect()}
    inertia = sum(far for _, far in sums.values())
    clusters = [(i, c, *sums.get(i, (0, 0)), inertia) for i, c in enumerate(centroids.tolist())]
    return (found.withColumnRenamed("id", id_col),
            spark.createDataFrame(clusters, "cluster int, centroid array<bigint>, n bigint, cluster_inertia bigint, "
                                            "inertia bigint"))



def with_cluster_facts(found: DataFrame, clusters: DataFrame) -> DataFrame:
    """The vectors with their cluster's sums and the SHA-256 of its centroid's components (a broadcast of ``k`` rows)."""
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256)
    facts = clusters.select("cluster", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))
    return found.join(F.broadcast(facts), "cluster")
