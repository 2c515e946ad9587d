"""Skew-safe row-frame windows.

``Window.partitionBy("symbol")`` sends every row of a symbol to one task;
if one symbol holds a third of the table that task holds a third of the
table.  The indicators here only look a bounded number of rows back or
ahead (3-row moving windows, ``lag``, the +-K neighbours of the forest
model), so we partition by ``(symbol, block)`` instead, where ``block`` is
a time bucket (month, year, day), and hand each block the few rows it
needs from its neighbours ("halo" rows):

1. ``tails``: the last ``before`` rows of every (symbol, block), a
   ``row_number() <= k`` filter that Spark turns into a partial
   ``WindowGroupLimit`` before the shuffle, so only k rows per block and
   map task move.
2. Sorted by time within a symbol, the ``before`` tail rows that precede
   the first tail row of block B are exactly the ``before`` rows that
   precede B in the full series (a block with fewer than k rows
   contributes all of them).  A window over this small table (k rows per
   block) tells every tail row which later blocks it serves.
3. Halo rows are unioned into the blocks, the real window runs over
   ``(symbol, block)``, and halo rows are dropped again.

The result is identical to the unsplit window for any frame inside
``[-before, +after]`` rows; the largest task holds one block plus
``before + after`` rows.  Ordering columns must be unique per symbol
(guaranteed after keep-last dedup).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "_blk"
HALO = "_halo"


def time_block(col: str, unit: str) -> Column:
    """Block id of a DATE/TIMESTAMP column: 'year', 'month', 'day' or 'none'."""
    if unit == "none":
        return F.lit(0)
    if unit == "day":
        return F.unix_date(F.to_date(col))
    if unit == "month":
        c = F.to_date(col)
        return F.year(c) * 12 + F.month(c)
    if unit == "year":
        return F.year(F.to_date(col))
    raise ValueError(f"unknown block unit {unit!r}")


def _halo_rows(b: DataFrame, key: str, order: str, k: int, forward: bool) -> DataFrame:
    """Rows that blocks need from their neighbours, re-labelled with the target block."""
    cols = [c for c in b.columns if c not in (BLOCK, HALO)]
    edge_order = F.col(order).asc() if forward else F.col(order).desc()
    rn = F.row_number().over(Window.partitionBy(key, BLOCK).orderBy(edge_order))
    edge = b.withColumn("_rn", rn).where(F.col("_rn") <= k).drop("_rn")
    w = Window.partitionBy(key).orderBy(order)
    if not forward:
        # tail rows: serve later blocks whose first tail row is <= k positions ahead
        edge = edge.withColumn(
            "_mark", F.coalesce(F.lag(BLOCK, 1).over(w) != F.col(BLOCK), F.lit(True)))
    else:
        # head rows: serve earlier blocks whose last head row is <= k positions behind
        edge = edge.withColumn(
            "_mark", F.coalesce(F.lead(BLOCK, 1).over(w) != F.col(BLOCK), F.lit(True)))
    # the k neighbouring edge rows in one sliding frame (instead of k offset
    # functions); keep the blocks whose first (last) edge row is among them
    frame = w.rowsBetween(1, k) if not forward else w.rowsBetween(-k, -1)
    near = F.collect_list(F.struct(F.col("_mark").alias("m"), F.col(BLOCK).alias("b"))).over(frame)
    return (edge.select(*cols, near.alias("_near"))
            .select(*cols, F.explode(F.transform(F.filter("_near", lambda x: x["m"]),
                                                 lambda x: x["b"])).alias(BLOCK))
            .withColumn(HALO, F.lit(True)))


def blocked_window(df: DataFrame, key: str, order: str, block: Column,
                   before: int, after: int,
                   compute: Callable[[DataFrame, Window], DataFrame]) -> DataFrame:
    """Run ``compute(df_with_halo, window)`` over (key, block) partitions.

    ``compute`` receives the block-partitioned frame and the window spec
    ``partitionBy(key, block).orderBy(order)`` and must only use frames
    within ``before`` preceding / ``after`` following rows.  Helper columns
    are removed from the result.
    """
    b = df.withColumn(BLOCK, block).withColumn(HALO, F.lit(False))
    parts = [b]
    if before > 0:
        parts.append(_halo_rows(b, key, order, before, forward=False))
    if after > 0:
        parts.append(_halo_rows(b, key, order, after, forward=True))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    w = Window.partitionBy(key, BLOCK).orderBy(order)
    out = compute(u, w)
    return out.where(~F.col(HALO)).drop(BLOCK, HALO)


def blocked_row_number(df: DataFrame, key: str, order: str, block: Column,
                       name: str = "rn") -> DataFrame:
    """Exact ``row_number()`` over ``partitionBy(key).orderBy(order)`` without a per-key task.

    Rows are counted per (key, block); a running sum over that small count
    table gives each block's offset; the final number is the offset plus the
    row number inside the block.  ``block`` must be non-decreasing in
    ``order`` (a time bucket of the ordering column).
    """
    b = df.withColumn(BLOCK, block)
    counts = b.groupBy(key, BLOCK).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, BLOCK, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    w = Window.partitionBy(key, BLOCK).orderBy(order)
    return (b.join(offsets, [key, BLOCK])
            .withColumn(name, F.col("_off") + F.row_number().over(w))
            .drop(BLOCK, "_off"))
