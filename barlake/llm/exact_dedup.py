"""Exact deduplication by a heavy-hitter split.

1. Every text is reduced to the SHA-256 of its normalised form.
2. A Misra-Gries summary (Spark's mergeable frequent-items sketch, built per
   salt first, so no task merges the summaries of all input partitions) names
   at most ``HEAVY_LIMIT`` digests that may be frequent.
3. The named digests are verified: one exact count and smallest id each, with
   map-side combining.  These winners are at most ``HEAVY_LIMIT`` rows of
   about 100 bytes, so they are broadcast and settle the large groups without
   moving their rows.
4. All other digests belong to groups below about ``4 * rows / SKETCH_ITEMS``
   rows (a thousandth of them), the sketch's error, and go through one ordinary
   shuffle by digest.

The summary decides only which way a row takes, never its result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.shared import ASCII_SPACE, col, stored, text_of

# Counters per Misra-Gries summary, digests kept from it, and first-level salts.
SKETCH_ITEMS = 4096
HEAVY_LIMIT = 4096
SALTS = 64


def text_digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the text with each ASCII space run as one space."""
    return F.sha2(F.regexp_replace(text, ASCII_SPACE, " ").cast("binary"), 256)


def frequent_digests(rows: DataFrame, digest: str) -> DataFrame:
    """Misra-Gries candidates: column ``_heavy``, at most ``HEAVY_LIMIT`` 64-bit hashes."""
    part = rows.groupBy((F.spark_partition_id() % SALTS).alias("_salt")).agg(
        F.expr(f"approx_top_k_accumulate(xxhash64(`{digest}`), {SKETCH_ITEMS})").alias("_mg"))
    whole = part.groupBy(F.lit("all")).agg(F.expr(f"approx_top_k_combine(_mg, {SKETCH_ITEMS})").alias("_mg"))
    item = F.explode(F.expr(f"approx_top_k_estimate(_mg, {HEAVY_LIMIT})")).alias("_e")
    return whole.select(item).where("_e.count > 1").select(F.col("_e.item").alias("_heavy"))


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id`` and ``_sha`` of every row, written once: the texts are read and hashed one time."""
    return stored(docs.select(col(id_col).alias("_id"), text_digest(text_of(text_col)).alias("_sha")), "digests")


def heavy_winners(rows: DataFrame) -> DataFrame:
    """Verified frequent digests: ``_won``, the smallest id ``_keep`` and the group's ``_size``."""
    heavy = frequent_digests(rows, "_sha")
    return (rows.join(F.broadcast(heavy), F.xxhash64("_sha") == F.col("_heavy"), "left_semi")
            .groupBy("_sha").agg(F.min("_id").alias("_keep"), F.count(F.lit(1)).alias("_size"))
            .select(F.col("_sha").alias("_won"), "_keep", "_size"))


def split_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(copies of heavy digests, settled map-side; all rows that still go through a shuffle).

    The second part holds one row per heavy digest, its smallest id, besides
    the rows of all other digests.
    """
    split = rows.join(F.broadcast(heavy_winners(rows.select("_id", "_sha"))), F.col("_sha") == F.col("_won"), "left")
    copy = F.col("_won").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_keep"))
    return split.where(copy), split.where(~copy)


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: does it stay, and for which row does it go.

    Columns: the id, ``keep_id`` (id of the row that stays), ``group_size``
    (rows with an equal text), ``kept`` and ``text_sha256``.

    Null text counts as empty.  Of equal texts the smallest id stays; null
    ids come last, and a group of null ids only has a null ``keep_id``.  Rows
    that repeat id and text are copies like any other: exactly one has
    ``kept``.  An empty table gives an empty result; other columns of
    ``docs`` are not used.
    """
    copies, rest = split_rows(digests(docs, id_col, text_col))
    by_digest = Window.partitionBy("_sha")
    first = by_digest.orderBy(F.col("_id").asc_nulls_last())
    decided = rest.select(
        "_id", "_sha", F.coalesce("_keep", F.min("_id").over(by_digest)).alias("_keep"),
        F.coalesce("_size", F.count(F.lit(1)).over(by_digest)).alias("_size"),
        (F.row_number().over(first) == 1).alias("_kept"))
    lost = copies.select("_id", "_sha", "_keep", "_size", F.lit(False).alias("_kept"))
    return lost.unionByName(decided).select(
        F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"),
        F.col("_kept").alias("kept"), F.col("_sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay (see :func:`mark_copies`), with the columns of ``docs``.

    Copies of heavy digests are filtered before the shuffle; the texts of all
    other rows are moved once.
    """
    rows = docs.select(*[col(c).alias(f"_in{i}") for i, c in enumerate(docs.columns)],
                       col(id_col).alias("_id"), text_digest(text_of(text_col)).alias("_sha"))
    winners = heavy_winners(digests(docs, id_col, text_col))
    ahead = (rows.join(F.broadcast(winners), F.col("_sha") == F.col("_won"), "left")
             .where(F.col("_won").isNull() | F.col("_id").eqNullSafe(F.col("_keep"))))
    first = Window.partitionBy("_sha").orderBy(F.col("_id").asc_nulls_last())
    return (ahead.withColumn("_nth", F.row_number().over(first)).where("_nth = 1")
            .select(*[F.col(f"_in{i}").alias(c) for i, c in enumerate(docs.columns)]))
