"""Symbol catalog and coverage.

Distinct symbols are a partial+final hash aggregate; ordered pages use
``orderBy(...).offset(o).limit(n)`` which Spark plans as a top-k
(``TakeOrderedAndProject``) per task, so no task sorts the whole catalog.
Symbol order is binary (ASCII) order.  For deep pages of large catalogs,
:func:`write_directory` stores the symbols in sorted ranges with a directory
of their sizes, and :func:`directory_page` reads only the ranges a page lies in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.expressions import hours_between

DEFAULT_PAGE = 100  # fixed value: symbols per page


def distinct_symbols(bars: DataFrame, key: str = "symbol") -> DataFrame:
    return bars.select(key).where(F.col(key).isNotNull()).distinct()


def symbols_sorted(bars: DataFrame, key: str = "symbol") -> DataFrame:
    """Every distinct symbol in ascending order."""
    return distinct_symbols(bars, key).orderBy(key)


def symbols_first_n(bars: DataFrame, n: int = DEFAULT_PAGE, key: str = "symbol") -> DataFrame:
    """U4: the first ``n`` symbols in order (a top-k, the page is the feature)."""
    return distinct_symbols(bars, key).orderBy(key).limit(n)


def symbol_count(bars: DataFrame, key: str = "symbol") -> DataFrame:
    """Number of distinct non-null symbols (one row)."""
    return bars.agg(F.count_distinct(key).alias("total_count"))


def symbols_page(bars: DataFrame, offset: int = 0, limit: int = DEFAULT_PAGE,
                 key: str = "symbol") -> DataFrame:
    """One page of ordered symbols plus the catalog size.

    The total is a scalar subquery evaluated once and inlined, not a join.
    """
    total = symbol_count(bars, key).scalar()
    page = distinct_symbols(bars, key).orderBy(key).offset(offset).limit(limit)
    return page.select(key, total.alias("total_count"),
                       F.lit(offset).alias("page_offset"), F.lit(limit).alias("page_limit"))


SYMBOLS_PER_RANGE = 100_000
SYMBOLS_PER_TASK = 400_000
ROW_BITS = 33  # monotonically_increasing_id counts a partition's rows in its low bits


def write_directory(bars: DataFrame, path: str, key: str = "symbol", per_range: int = SYMBOLS_PER_RANGE) -> None:
    """Store the distinct symbols in sorted ranges of at most ``per_range``, and a directory with each range's size.

    One distinct aggregation and one range partitioning.  A task sorts about
    ``SYMBOLS_PER_TASK`` symbols and cuts them into ranges, which then share
    the usual number of tasks for their files, so the number of tasks does not
    depend on how small the ranges are.  The directory has one row per range:
    ``range``, ``n``, ``low``, ``high``.
    """
    spark = bars.sparkSession
    symbols = distinct_symbols(bars, key).select(F.col(key).alias("symbol"))
    count = symbols.count()
    tasks = max(1, -(-count // max(per_range, SYMBOLS_PER_TASK)))
    number = F.monotonically_increasing_id()
    row = number.bitwiseAND((1 << ROW_BITS) - 1)
    # ranges are numbered in symbol order: by task, then by place in it
    ranges = F.shiftright(number, ROW_BITS) * (1 << ROW_BITS) + F.floor(row / per_range)
    # stored once: another run of the range partitioning may cut elsewhere
    (symbols.repartitionByRange(tasks, "symbol").sortWithinPartitions("symbol").withColumn("range", ranges)
     .write.parquet(f"{path}/sorted"))
    stored = spark.read.schema("symbol string, range bigint").parquet(f"{path}/sorted")
    writers = min(int(spark.conf.get("spark.sql.shuffle.partitions")), tasks + count // per_range)
    stored.repartition(writers, "range").write.partitionBy("range").parquet(f"{path}/symbols")
    (stored.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.min("symbol").alias("low"), F.max("symbol").alias("high"))
     .coalesce(1).write.parquet(f"{path}/directory"))


def directory_page(spark: SparkSession, path: str, offset: int = 0, limit: int = DEFAULT_PAGE) -> DataFrame:
    """U5 + U6 from the directory: as :func:`symbols_page`, reading the page's ranges only.

    The driver holds two numbers per range.
    """
    entries = spark.read.schema("range bigint, n bigint").parquet(f"{path}/directory")
    total, needed, first = 0, [], None
    for r in sorted(entries.collect(), key=lambda r: r["range"]):  # ranges are numbered in symbol order
        if total < offset + limit and total + r["n"] > offset:
            needed.append(r["range"])
            first = total if first is None else first
        total += r["n"]
    if not needed or limit <= 0:
        page = spark.createDataFrame([], "symbol string")
    else:
        some = spark.read.schema("symbol string").parquet(*[f"{path}/symbols/range={k}" for k in needed])
        page = some.orderBy("symbol").offset(offset - first if offset > first else 0).limit(limit)
    return page.select("symbol", F.lit(total).cast("bigint").alias("total_count"),
                       F.lit(offset).alias("page_offset"), F.lit(limit).alias("page_limit"))


def symbol_search(bars: DataFrame, query: str, key: str = "symbol") -> DataFrame:
    """case-insensitive substring match; an empty query keeps all."""
    q = (query or "").strip().lower()
    syms = distinct_symbols(bars, key)
    if not q:
        return syms
    return syms.where(F.lower(F.col(key)).contains(F.lit(q)))


def coverage(bars: DataFrame, ts: str = "ts", key: str = "symbol") -> DataFrame:
    """A1 + A2: per-symbol row count, distinct times and dates, first/last time, span in hours.

    Distinct times, then days, then symbols are aggregated in turn: each
    level is pre-aggregated before its shuffle and no row is copied for a
    second distinct count.
    """
    times = bars.groupBy(key, F.to_date(ts).alias("_day"), F.col(ts).alias("_ts")).agg(F.count(F.lit(1)).alias("_n"))
    days = times.groupBy(key, "_day").agg(
        F.sum("_n").alias("_n"), F.count("_ts").alias("_times"), F.min("_ts").alias("_first"), F.max("_ts").alias("_last"))
    return days.groupBy(key).agg(
        F.sum("_n").alias("count"),
        F.sum("_times").alias("unique_times"),
        F.count("_day").alias("unique_dates"),
        F.min("_first").alias("earliest"),
        F.max("_last").alias("latest"),
    ).withColumn("time_range_hours", hours_between("earliest", "latest"))
