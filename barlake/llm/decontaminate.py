"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of ``WINDOW`` consecutive words (an item
of fewer words is one window).  A window occurs in a document only if all its
word shingles do, so one necessary prefix token per window is enough:

1. Global order: benchmark shingles are counted over all documents and each
   window is keyed by its rarest shingle (ties by hash, then offset).
2. The documents' shingles are joined with these prefix tokens only.  The
   windows are a broadcast side of about ``BLOCK_ROWS`` rows and
   ``BLOCK_BYTES`` bytes; a larger benchmark is joined in several blocks, each
   over all documents.  A window goes along with its number, not with the items
   it is from: those are joined by number to the documents that were hit.
3. Position and length bounds: a shingle at position ``p`` that is the
   ``o``-th of its window puts the window at ``p - o``, which must start in
   the document and end within its length.
4. The words there are compared with the window's words exactly.

Tokens never leave their task: only verified hits and one row per document
are shuffled, pre-aggregated per document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.shared import col, lower_ascii, stored, text_of

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 5
# Broadcast bounds of a block: windows (or shingles), and bytes of their words.
BLOCK_ROWS = 100_000
BLOCK_BYTES = 64 << 20


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def shingle_hash(words: Column, start: Column, length: int) -> Column:
    return F.xxhash64(*[words[start + k] for k in range(length)])


def shingle_hashes(words: Column, length: int) -> Column:
    """Hashes of all runs of ``length`` words, in order; empty if there are fewer words."""
    n = F.size(words)
    return (F.when(n >= length, F.transform(F.sequence(F.lit(0), n - length),
                                            lambda i: shingle_hash(words, i, length)))
            .otherwise(F.array().cast("array<bigint>")))


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> tuple[DataFrame, DataFrame]:
    """(distinct windows: ``win_id``, ``win`` (words), ``width``; ``win_id`` and ``item`` (id as text) pairs), written once.
    """
    items = benchmark.select(F.coalesce(col(id_col).cast("string"), F.lit("")).alias("item"),
                             words_of(text_of(text_col)).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    win = items.select("item", F.explode_outer(F.transform(
        starts, lambda i: F.slice(F.col("words"), i, window))).alias("win")).distinct()
    pairs = stored(win, "windows")
    numbered = stored(pairs.select("win").distinct().select(
        F.monotonically_increasing_id().alias("win_id"), "win", F.size("win").alias("width")), "windows-numbered")
    return numbered, pairs.join(numbered, "win").select("win_id", "item")


def window_tokens(windows: DataFrame, shingle: int) -> DataFrame:
    """Every shingle of every window: ``token``, ``offset`` and ``sh`` (its words)."""
    def of(length: int) -> Column:
        return F.transform(shingle_hashes(F.col("win"), length), lambda h, i: F.struct(
            h.alias("token"), i.alias("offset"), F.lit(length).alias("sh")))
    arrays = F.when(F.col("width") >= shingle, of(shingle))
    for length in range(1, shingle):
        arrays = arrays.when(F.col("width") == length, of(length))
    return windows.select("win_id", "win", "width", F.inline_outer(arrays))


def document_tokens(words: Column, lengths: list[int]) -> Column:
    """One null (the document itself), then the shingles of each length in turn."""
    return reduce(lambda a, b: F.concat(a, b), [shingle_hashes(words, n) for n in lengths],
                  F.array(F.lit(None).cast("bigint")))


def position(pos: Column, words: Column, sh: Column, lengths: list[int]) -> Column:
    """Word position of the token that ``document_tokens`` puts at ``pos``."""
    first, at = F.lit(1), None
    for length in lengths:
        at = F.when(sh == length, first) if at is None else at.when(sh == length, first)
        first = first + F.greatest(F.size(words) - (length - 1), F.lit(0))
    return pos - at


def hits(docs: DataFrame, windows: DataFrame, id_col: str, text_col: str, shingle: int, block_rows: int,
         block_bytes: int) -> DataFrame:
    """One row per row of ``docs``: ``_row``, ``_id``, ``_key``, ``n_words``, ``n_hit`` and ``wins``, the numbers of the
    windows that occur."""
    tokens = window_tokens(windows, shingle)
    facts = tokens.groupBy("sh").agg(F.count(F.lit(1)).alias("n")).collect()  # at most `shingle` rows
    size = windows.agg(F.sum(F.octet_length(F.concat_ws(" ", "win")))).first()[0] or 0
    lengths = sorted({r["sh"] for r in facts} | {shingle}, reverse=True)
    blocks = max(1, -(-sum(r["n"] for r in facts) // block_rows), -(-size // block_bytes))
    if blocks > 1:  # read several times: rows must keep their numbers
        docs = stored(docs.select(col(id_col).alias(id_col), col(text_col).alias(text_col)), "decontaminate-docs")

    rows = docs.select(col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_row"),
                       F.xxhash64(text_of(text_col)).alias("_key"), words_of(text_of(text_col)).alias("_words"))
    # The tokens are a column of their own: Spark then runs explode, join and bounds as one generated
    # loop that points at the document's words, instead of copying them for every token.  The outer
    # explode (no array is empty) keeps Spark from adding a filter that would tokenise each text again,
    # and once for every shingle.
    shingled = rows.withColumn("_tokens", document_tokens(F.col("_words"), lengths))
    exploded = shingled.select("_id", "_row", "_key", "_words", F.posexplode_outer("_tokens").alias("_pos", "_token"))

    def block(df: DataFrame, token: str, b: int) -> DataFrame:
        return df if blocks == 1 else df.where(F.pmod(F.col(token), F.lit(blocks)) == b)

    seen = shingled.select(F.explode_outer("_tokens").alias("_token"))
    asked = tokens.select("token").distinct()
    counts = reduce(DataFrame.unionByName, [
        seen.join(F.broadcast(block(asked, "token", b)), F.col("_token") == F.col("token"))
        .groupBy("token").agg(F.count(F.lit(1)).alias("freq")) for b in range(blocks)])
    index = (tokens.join(counts, "token", "left")
             .groupBy("win_id", "win", "width")
             .agg(F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "token", "offset", "sh")).alias("rarest"))
             .select("win_id", "win", "width", F.col("rarest.token").alias("token"),
                     F.col("rarest.offset").alias("offset"), F.col("rarest.sh").alias("sh")))

    start = position(F.col("_pos"), F.col("_words"), F.col("sh"), lengths) - F.col("offset")
    found = ((start >= 0) & (start + F.col("width") <= F.size("_words"))
             & (F.slice("_words", F.greatest(start, F.lit(0)) + 1, F.col("width")) == F.col("win")))
    parts = []
    for b in range(blocks):
        side = F.broadcast(block(index, "token", b))
        joined = exploded.join(side, F.col("_token") == F.col("token"), "left")
        keep = F.coalesce(found, F.lit(False))
        if b == 0:
            keep = keep | (F.col("_pos") == 0)
        parts.append(joined.where(keep).select(
            "_id", "_row", "_key", F.size("_words").cast("bigint").alias("n_words"),
            F.when(F.col("token").isNotNull(), F.struct(
                start.cast("bigint").alias("a"), (start + F.col("width")).cast("bigint").alias("z"))).alias("hit"),
            "win_id"))
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to"))
    covered = F.aggregate(
        F.array_sort("hits"), zero,
        lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0).cast("bigint"),
                                                   x["z"] - F.greatest(x["a"], s["to"]))).alias("n"),
                              F.greatest(s["to"], x["z"]).alias("to")),
        lambda s: s["n"])
    whole = (reduce(DataFrame.unionByName, parts).groupBy("_row", "_id", "_key", "n_words")
             .agg(F.collect_set("hit").alias("hits"), F.collect_set("win_id").alias("wins")))
    return whole.select("_row", "_id", "_key", "n_words", covered.alias("n_hit"), "wins")


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text",
                      window: int = WINDOW, shingle: int = SHINGLE,
                      block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: the words hit by benchmark windows.

    Columns: ``doc_id`` (as ``id_col``), ``n_words``, ``n_hit`` (words inside
    any occurrence of a window), ``n_items``, ``items`` (their ids as text,
    sorted), ``contaminated`` and ``text_key`` (hash of the raw text).

    Null text has no words; a null document id stays null; a null item id is
    the empty text; repeated items and items of equal words are all named;
    repeated documents give repeated rows.  Without benchmark windows nothing
    is contaminated.  Other columns of the inputs are not used.
    """
    windows, items = benchmark_windows(benchmark, item_col, item_text_col, window)
    marked = stored(hits(docs, windows, id_col, text_col, shingle, block_rows, block_bytes), "hits")
    clean, hit = F.size("wins") == 0, F.size("wins") > 0
    facts = ["_row", "_id", "_key", "n_words", "n_hit"]
    named = (marked.where(hit).select(*facts, F.explode("wins").alias("win_id")).join(items, "win_id")
             .groupBy(*facts).agg(F.array_sort(F.collect_set("item")).alias("items")))
    whole = marked.where(clean).select(*facts, F.array().cast("array<string>").alias("items")).unionByName(named)
    return whole.select(F.col("_id").alias(id_col), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        "items", (F.size("items") > 0).alias("contaminated"), F.col("_key").alias("text_key"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text",
                      window: int = WINDOW, shingle: int = SHINGLE,
                      block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with the columns of ``docs``.

    Rows are matched by id (null equals null) and raw text.
    """
    windows, _ = benchmark_windows(benchmark, item_col, item_text_col, window)
    bad = (hits(docs, windows, id_col, text_col, shingle, block_rows, block_bytes).where(F.size("wins") > 0)
           .select(F.col("_id").alias("_bad_id"), F.col("_key").alias("_bad_key")).distinct())
    same = (col(id_col).eqNullSafe(F.col("_bad_id"))
            & (F.xxhash64(text_of(text_col)) == F.col("_bad_key")))
    return docs.join(bad.hint("shuffle_hash"), same, "left_anti")
