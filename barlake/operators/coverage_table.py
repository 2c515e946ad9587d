"""Coverage kept as bars land: mergeable per-symbol summaries with exact bitmaps.

Every append writes a summary of its own bars: per symbol and block of time
steps a bitmap of the times that occur, and per symbol a bitmap of the days,
with counts and first and last time.  Bitmaps merge by OR, so a time or day
that several appends hold counts once, exactly.  Coverage merges the
summaries; the bars are not read again.  When ``FANOUT`` summaries of one tier
have come together they are merged into one of the next tier, so an append
costs in proportion to itself and a reader finds few parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.expressions import hours_between
from barlake.operators.moments import step
from barlake.streaming.commits import CommitLog

TABLE = "coverage"
FANOUT = 8
BITS = 15  # a Spark bitmap has 2^15 bits
SCHEMA = "symbol STRING, kind STRING, block BIGINT, bits BINARY, n BIGINT, first TIMESTAMP_NTZ, last TIMESTAMP_NTZ"
DAY_SECONDS = 86400


def summary(bars: DataFrame, ts: str = "ts", grain_seconds: int = 60) -> DataFrame:
    """Summary rows of some bars, of kind ``time`` and ``day``.

    A time that is no whole number of steps would share its bit with another
    one: that is an error.  Bars without a time count, but have none.
    """
    uneven = F.raise_error(F.lit(f"a bar's time is no multiple of {grain_seconds} seconds"))
    exact = F.col(ts).isNull() | (F.date_trunc("second", ts).cast("timestamp_ntz") == F.col(ts)) & (
        F.pmod(step(ts, 1), F.lit(grain_seconds)) == 0)
    rows = bars.select("symbol", F.when(exact, F.col(ts)).otherwise(uneven.cast("timestamp_ntz")).alias("t"))

    def by(kind: str, seconds: int) -> DataFrame:
        x = step("t", seconds)
        bit = x.bitwiseAND((1 << BITS) - 1)
        return (rows.groupBy("symbol", F.lit(kind).alias("kind"), F.shiftright(x, BITS).alias("block"))
                .agg(F.bitmap_construct_agg(bit).alias("bits"), F.count(F.lit(1)).alias("n"), F.min("t").alias("first"),
                     F.max("t").alias("last")))

    return by("time", grain_seconds).unionByName(by("day", DAY_SECONDS))


def merged(summaries: DataFrame) -> DataFrame:
    """One row per symbol, kind and block."""
    return summaries.groupBy("symbol", "kind", "block").agg(
        F.bitmap_or_agg("bits").alias("bits"), F.sum("n").alias("n"), F.min("first").alias("first"),
        F.max("last").alias("last"))


def coverage_of(summaries: DataFrame) -> DataFrame:
    """A1 + A2 per symbol, as :func:`barlake.operators.catalog.coverage` gives it from the bars."""
    blocks = merged(summaries).withColumn("_bits", F.bitmap_count("bits"))
    time, day = F.col("kind") == "time", F.col("kind") == "day"
    return blocks.groupBy("symbol").agg(
        F.sum(F.when(time, F.col("n"))).alias("count"),
        F.sum(F.when(time, F.col("_bits"))).alias("unique_times"),
        F.sum(F.when(day, F.col("_bits"))).alias("unique_dates"),
        F.min("first").alias("earliest"), F.max("last").alias("latest"),
    ).withColumn("time_range_hours", hours_between("earliest", "latest"))


class CoverageTable:
    """The summaries below a folder; several writers may append."""

    def __init__(self, spark: SparkSession, folder: str, ts: str = "ts", grain_seconds: int = 60):
        self.log, self.ts, self.grain_seconds = CommitLog(spark, folder), ts, grain_seconds

    def append(self, bars: DataFrame) -> None:
        """Take in the bars that have just landed: one pass over them."""
        part = self.log.write(summary(bars, self.ts, self.grain_seconds), TABLE, tier=0)
        while not self.log.add({"add": [part]}):
            pass
        self.log.merge_tiers(TABLE, FANOUT, lambda parts: merged(self.log.read(parts, SCHEMA)))

    def summaries(self) -> DataFrame:
        self.log.refresh()
        return self.log.read(self.log.of_table(TABLE), SCHEMA)

    def coverage(self) -> DataFrame:
        return coverage_of(self.summaries())

    def symbol_count(self) -> DataFrame:
        """U6 from the summaries: number of distinct symbols (one row)."""
        return self.summaries().agg(F.count_distinct("symbol").alias("total_count"))
