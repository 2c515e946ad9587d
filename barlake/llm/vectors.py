"""Integer vectors: what the two vector operators compute with, exactly."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.shared import col, stored

# Squared length from which on squared distances need more than a long.
LONG_NORM = float(1 << 60)


def list_rows(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows hold exactly ``dims`` values, these rows as a matrix; a null value is a NaN)."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    fits = sizes == dims
    if not fits.all():
        flat = flat[np.repeat(fits, sizes)]
    return fits, flat.reshape(-1, dims)


def list_column(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as an Arrow list column."""
    ends = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.reshape(-1)))


def integer_vectors(df: DataFrame, scale: int, dims: int, id_col: str, vec_col: str,
                    carry: Sequence[str] = ()) -> DataFrame:
    """``id``, ``v`` = floor(scale * x) of each component, and ``carry`` as ``carry0`` ...; written once.

    Kept are vectors of exactly ``dims`` components, none null or not
    finite.  A vector whose scaled length is 2^30 or more is left out as
    well: its squared distances do not fit a long.
    """
    extra = [f"carry{i}" for i in range(len(carry))]
    rows = df.select(col(id_col).cast("bigint").alias("id"), col(vec_col).alias("v"),
                     *[col(c).alias(x) for c, x in zip(carry, extra)])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fits, x = list_rows(b.column("v"), dims)
            with np.errstate(all="ignore"):
                scaled = np.floor(scale * x.astype(np.float64))
                good = (scaled * scaled).sum(axis=1) < LONG_NORM  # False for NaN and infinity too
            fits[fits] = good
            kept = b.filter(pa.array(fits))
            yield pa.RecordBatch.from_arrays(
                [kept.column("id"), list_column(scaled[good].astype(np.int64)), *map(kept.column, extra)],
                ["id", "v", *extra])

    types = "".join(f", {x} {rows.schema[x].dataType.simpleString()}" for x in extra)
    return stored(rows.mapInArrow(of, "id bigint, v array<bigint>" + types), "vectors")


def chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``rows``."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= rows:
            yield pa.concat_batches(held)
            held, size = [], 0
    if size:
        yield pa.concat_batches(held)


def component_sums(partial: DataFrame, key: str) -> DataFrame:
    """Add up what the tasks hand on (``key``, ``n``, ``total`` list): ``key``, ``at``, ``n``, ``total`` (exact)."""
    return (partial.select(key, "n", F.posexplode("total").alias("at", "x"))
            .groupBy(key, "at").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("total")))
