"""Keyed live state: keep-last per (symbol, date), newest ``cap`` dates per symbol (ST3).

The live table is log-structured.  Each micro-batch is reduced by the batch
operators (:func:`barlake.operators.dedup.live_state`: the last arrival per
date, then the newest ``cap`` dates of each symbol, salted, so a hot symbol is
pre-reduced by many tasks) and written as one delta; an entry of the sink's
commit log (:mod:`barlake.streaming.commits`) makes it part of the table.  The
current table is the same reduction over all parts.

Trimming early changes nothing: a date that is evicted has ``cap`` dates with
newer arrivals, and a later arrival for it enters with its newer ``seq``.  So
the table equals the batch twin on the same arrivals, whatever the batches,
their order, or how often one is sent.  A consumer with a new checkpoint
therefore continues the table, and a replay of what is there changes nothing.

A batch writes in proportion to itself.  When ``FANOUT`` parts of one tier
have come together they are merged into one part of the next tier, so a row is
written once per tier (the logarithm of the number of batches to that base),
and a reader merges fewer than ``FANOUT`` parts per tier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from barlake.operators.dedup import LIVE_CAP, live_state
from barlake.streaming.commits import CommitLog, run_of
from barlake.streaming.ingest import triggered

TABLE = "state"
FANOUT = 8
KEPT_ENTRIES = 4  # replaced parts keep their files for so many entries
COLUMNS = ["symbol", "date", "seq", "open", "high", "low", "close", "volume"]
STATE_SCHEMA = ("symbol STRING, date DATE, seq BIGINT, open DOUBLE, high DOUBLE, low DOUBLE, "
                "close DOUBLE, volume DOUBLE")


def merge_batch(batch: DataFrame, batch_id: int, log: CommitLog, run: str, cap: int = LIVE_CAP) -> None:
    """Add one micro-batch (symbol, date, seq, OHLCV) of a run to the live table."""
    log.refresh()
    if log.done(run, batch_id):
        return
    part = log.write(live_state(batch.select(*COLUMNS), cap=cap), TABLE, tier=0)
    while not log.add({"run": run, "batch": batch_id, "add": [part]}):
        pass  # parts of other writers do not conflict with a delta
    log.merge_tiers(TABLE, FANOUT, lambda parts: live_state(log.read(parts, STATE_SCHEMA), cap=cap), KEPT_ENTRIES)


def start_live_state(arrivals: DataFrame, sink: str, checkpoint: str,
                     cap: int = LIVE_CAP, processing_time: str | None = None) -> StreamingQuery:
    """ST3: keep the live table of a stream of arrivals; read it with :func:`live_view`.

    Any number of runs, one after another or at a time, may feed one sink.
    """
    log = CommitLog(arrivals.sparkSession, sink)

    def write(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, log, run_of(log.spark, checkpoint), cap)

    return triggered(arrivals.writeStream.foreachBatch(write)
                     .option("checkpointLocation", checkpoint), processing_time).start()


def live_view(spark: SparkSession, sink: str, cap: int = LIVE_CAP) -> DataFrame:
    """Current live table: all parts, reduced as one."""
    log = CommitLog(spark, sink)
    return live_state(log.read(log.of_table(TABLE), STATE_SCHEMA), cap=cap).select(*COLUMNS)
