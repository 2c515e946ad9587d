"""Readers and writers of bar data.

All readers bind columns by name with an explicit schema (no inference
pass over the data) and read text numerics as strings, converting them
with ``try_cast`` later so a bad value nulls one field instead of failing
the job.  Writers are plain DataFrame writes executed by the executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.schema import CSV_COLUMNS, SCREENER_SCHEMA, SYMBOL_LIST_SCHEMA
from barlake.sources import csv_files, folder_files


# --- S1 / S9: bar CSV ---------------------------------------------------------
def csv_rejects(spark: SparkSession, path: str, wanted: list[str] = CSV_COLUMNS,
                skip_unreadable: bool = False) -> list[tuple[str, str]]:
    """(file, reason) of every file below ``path`` that gives no rows."""
    return csv_files.inspect(spark, path, wanted, skip_unreadable).rejects


def read_bar_csv(spark: SparkSession, path: str) -> DataFrame:
    """Bar CSV files as text, columns bound by header name, in any order.

    All files below ``path`` are read, compressed ones and those in
    sub-folders too.  A file that lacks or repeats a wanted column is left
    out (see :func:`csv_rejects`).  A file that can't be read to its end is an
    error, never a part of its rows.
    """
    return csv_files.rows_by_name(spark, csv_files.inspect(spark, path, CSV_COLUMNS), CSV_COLUMNS)


def write_bar_csv(df: DataFrame, path: str) -> None:
    """Header row, no index column, columns in landed order."""
    df.select(*CSV_COLUMNS).write.mode("overwrite").option("header", True).csv(path)


# --- S2: symbol list ----------------------------------------------------------
def read_symbol_list(spark: SparkSession, path: str) -> DataFrame:
    """One-column ``Symbol`` CSV; trimmed, blanks and nulls dropped, distinct."""
    raw = spark.read.schema(SYMBOL_LIST_SCHEMA).option("header", True).csv(path)
    sym = F.trim(F.col("Symbol"))
    return (raw.select(sym.alias("symbol"))
            .where(F.col("symbol").isNotNull() & (F.col("symbol") != "")
                   & (F.col("symbol") != "Symbol"))
            .distinct())


def write_symbol_list(symbols: DataFrame, path: str) -> None:
    symbols.select(F.col("symbol").alias("Symbol")).write.mode("overwrite") \
        .option("header", True).csv(path)


# --- S3: screener JSON -----------------------------------------------------------
def read_screener(spark: SparkSession, path: str) -> DataFrame:
    """S3: symbols from ``data.rows[*].symbol`` of landed screener documents."""
    doc = spark.read.schema(SCREENER_SCHEMA).json(path)
    return (doc.select(F.explode_outer("data.rows").alias("row"))
            .select(F.col("row.symbol").alias("symbol"))
            .where(F.col("symbol").isNotNull()))


def write_screener_pages(symbols: DataFrame, path: str, page_size: int = 25) -> None:
    """Land symbols as screener pages of about ``page_size`` rows each.

    Pages are hash buckets of the symbol, so no page (and no task) ever has
    to hold the whole universe.
    """
    n = symbols.count()
    pages = max(1, -(-n // page_size))
    page = F.pmod(F.xxhash64("symbol"), F.lit(pages))
    (symbols.groupBy(page.alias("page"))
     .agg(F.collect_list(F.struct("symbol")).alias("rows"))
     .select(F.struct("rows").alias("data"))
     .write.mode("overwrite").json(path))


# --- F8 / U1: per-symbol files -----------------------------------------------------
def by_symbol(rows: DataFrame) -> DataFrame:
    """The rows with each symbol's in one partition, whatever the size of the table.

    The number of partitions is given, so that they are not merged: writing is
    bound by the creation of the files, of which each task has its share.  Daily
    bars are at most one per symbol and day, so no symbol is too many for a task.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "Symbol")


def write_symbol_files(rows: DataFrame, path: str, columns: Sequence[str] = CSV_COLUMNS, packed: bool = False) -> None:
    """Land bar CSV rows as one directory per symbol (``Symbol=<s>/part-*.csv``, or ``.csv.gz`` if ``packed``).

    Rows are brought together by symbol first: the number of files grows with
    the symbols, not with the symbols times the tasks.
    """
    folder_files.write_folders(by_symbol(rows).select(*columns), path, "Symbol", packed)


FILE_COLUMNS = [c for c in CSV_COLUMNS if c != "Symbol"]


def scan_symbol_dirs(spark: SparkSession, path: str) -> tuple[DataFrame, list[tuple[str, str, str]]]:
    """F8 + U1: (rows of all per-symbol folders, quarantined files as (symbol, file, reason)).

    The symbol is that of the ``Symbol=`` folder a file lies in, at any depth.
    A file gives all its rows or none: one that can't be read to its end, or
    lacks a column, is quarantined and does not stop the others.
    """
    files = csv_files.inspect(spark, path, FILE_COLUMNS, skip_unreadable=True)
    rejects = []
    for file, reason in files.rejects:
        folders = [p.removeprefix("Symbol=") for p in file.split("/")[:-1] if p.startswith("Symbol=")]
        rejects.append((unquote(folders[-1]) if folders else "", file, reason))
    return csv_files.rows_by_name(spark, files, FILE_COLUMNS, ["Symbol"]), rejects


def read_symbol_dirs(spark: SparkSession, path: str) -> DataFrame:
    """The rows of :func:`scan_symbol_dirs`."""
    return scan_symbol_dirs(spark, path)[0]


# --- stored history -----------------------------------------------------------------
def write_history_table(bars: DataFrame, path: str, rows_per_file: int = 1_000_000,
                        order: str = "date") -> None:
    """Store bars range-partitioned and sorted by (symbol, time).

    Each file then covers a narrow symbol range, so Parquet min/max
    statistics let a symbol lookup skip files and row groups.  Range
    partitioning on the composite key samples the data and splits a hot
    symbol across several files by time instead of writing it from one task.
    """
    (bars.repartitionByRange("symbol", order)
     .sortWithinPartitions("symbol", order)
     .write.option("maxRecordsPerFile", rows_per_file).mode("overwrite").parquet(path))


# --- F9 / S8: symbol lookup ---------------------------------------------------------
def bars_for_symbol(bars: DataFrame, symbol: str | Column) -> DataFrame:
    """bars of one symbol, a bound equality (never formatted SQL text)."""
    value = symbol if isinstance(symbol, Column) else F.lit(symbol)
    return bars.where(F.col("symbol") == value).select(
        "symbol", "date", "open", "high", "low", "close", "volume")


def read_jdbc_bars(spark: SparkSession, url: str, table: str, symbol: str | None = None,
                   properties: dict | None = None, predicates: list[str] | None = None) -> DataFrame:
    """Relational scan; the symbol equality and column list are pushed to the database.

    A whole table is read in parallel, one task per predicate: pass clauses
    that do not overlap and cover the table, such as one per date range.
    """
    if predicates:
        df = spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})
    else:
        df = spark.read.jdbc(url, table, properties=properties or {})
    if symbol is not None:
        df = df.where(F.col("symbol") == F.lit(symbol))
    return df.select("symbol", "date", "open", "high", "low", "close", "volume")


def write_jdbc_bars(df: DataFrame, url: str, table: str, properties: dict | None = None,
                    batch_size: int = 10000) -> None:
    """Append bars to a relational table from the executors (batched inserts)."""
    (df.select("symbol", "date", "open", "high", "low", "close", "volume")
     .write.mode("append").option("batchsize", batch_size)
     .jdbc(url, table, properties=properties or {}))
