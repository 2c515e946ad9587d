"""Snapshot, then deltas per producer cycle (ST4), with closed cycles kept merged.

The first cycle (0, a negative number, or none) is kept in full; of a later
one each symbol's last bar counts.  A cycle may be spread over any number of
micro-batches, and a batch may hold any number of cycles.  Tables of the sink:

* ``snapshot``: the bars of the first cycle.
* ``open``: each batch's last bar per symbol and cycle, of cycles not yet closed.
* ``deltas``: closed cycles, one row per symbol and cycle; each part's entry in
  the commit log names its first and last cycle.
* ``latest``: one row per symbol, its last bar of the closed cycles.
* ``marks``: the highest cycle that each source partition has come to.

A partition's messages keep their order, so a message of a later cycle says
that the partition has ended all earlier ones, valid or rejected alike.  A
cycle that all partitions have left is closed: its rows leave ``open``, are
merged once into ``deltas``, and renew ``latest``.  Rows of cycles still open
are written again with each closing.  A row that comes late, after its cycle
was closed, is not lost: it waits in ``open`` and goes with the next closing
into a part whose cycles overlap older ones; readers merge such parts.

What is read to serve the current view is the snapshot, one row per symbol and
the open cycles, however many cycles have passed.  The whole history of deltas
is read as stored, without a shuffle of closed cycles.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barlake.functions.expressions import trading_day, ts_tie_order_key
from barlake.operators import cleanse
from barlake.streaming.commits import CommitLog
from barlake.streaming.ingest import committed_writer, triggered

FANOUT = 8
BAR_SCHEMA = ("symbol STRING, ts TIMESTAMP_NTZ, seq BIGINT, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, "
              "volume DOUBLE, partition INT, cycle INT")
MARKS_SCHEMA = "partition INT, cycle INT"


def classify_realtime(batch: DataFrame, batch_id: int) -> DataFrame:
    """Real-time path: a missing Date is allowed (it defaults to the message time)."""
    return cleanse.classify(cleanse.parse_payload(cleanse.decode_envelope(batch)),
                            date_required=False)


def cycle_number() -> Column:
    return F.greatest(F.coalesce(F.col("cycle"), F.lit(0)), F.lit(0))


def cycle_outputs(classified: DataFrame, batch_id: int) -> dict[str, DataFrame]:
    """What one micro-batch adds to the tables."""
    bars = cleanse.to_bars(classified, default_time=True, keep=("partition", "cycle"))
    bars = bars.withColumn("cycle", cycle_number())
    return {"snapshot": bars.where(F.col("cycle") == 0), "open": last_of_cycle(bars.where(F.col("cycle") > 0)),
            "marks": highest(classified.select("partition", cycle_number().alias("cycle")))}


def highest(marks: DataFrame) -> DataFrame:
    return marks.where("partition is not null").groupBy("partition").agg(F.max("cycle").alias("cycle"))


def last_of_cycle(bars: DataFrame) -> DataFrame:
    """Each symbol's latest bar per cycle (ties: the later arrival)."""
    order = ts_tie_order_key("ts", "seq", nulls_first=True)
    rest = [c for c in bars.columns if c not in ("symbol", "cycle")]
    return bars.groupBy("symbol", "cycle").agg(*[F.max_by(c, order).alias(c) for c in rest])


def last_of_symbol(deltas: DataFrame) -> DataFrame:
    """Each symbol's row of its latest cycle, in one shuffle: a symbol has few rows per cycle, so none is hot."""
    rows = last_of_cycle(deltas.repartition("symbol"))
    rest = [c for c in rows.columns if c != "symbol"]
    return rows.groupBy("symbol").agg(*[F.max_by(c, "cycle").alias(c) for c in rest])


def closed_through(log: CommitLog) -> int:
    """The last closed cycle; 0 before any (the first cycle needs no closing)."""
    return max((p["hi"] for p in log.of_table("deltas")), default=0)


def ended_through(log: CommitLog, partitions: int | None) -> int:
    """The last cycle that all source partitions have left, by their marks (one row to the driver)."""
    marks = highest(log.read(log.of_table("marks"), MARKS_SCHEMA))
    row = marks.agg(F.min("cycle").alias("low"), F.count(F.lit(1)).alias("seen")).first()
    return row["low"] - 1 if row["seen"] >= max(partitions or 0, 1) else 0


def close_cycles(log: CommitLog, partitions: int | None = None) -> None:
    """Close the cycles that have ended since, in one commit, and merge small parts.

    ``partitions`` is the number of source partitions: none is closed before
    all of them have left it, so one that never sends a message keeps every
    cycle open (views stay right, but read them all).  Without it those seen
    so far count, and what a new one sends for a closed cycle is late.  A
    closing that fails before its commit changes nothing and is done by a
    later batch.
    """
    log.refresh()
    done, ended = closed_through(log), ended_through(log, partitions)
    if ended > done:
        parts, old = log.of_table("open"), log.of_table("latest")
        rows = log.read(parts, BAR_SCHEMA)
        with ThreadPoolExecutor(3) as pool:
            closed = pool.submit(log.write, last_of_cycle(rows.where(F.col("cycle") <= ended)).sort("cycle", "symbol"),
                                 "deltas", tier=0, hi=ended)
            rest = pool.submit(log.write, last_of_cycle(rows.where(F.col("cycle") > ended)), "open", tier=0)
            first = rows.agg(F.min("cycle")).first()[0]
        closed = {**closed.result(), "lo": min(done + 1, first or done + 1)}
        latest = log.write(last_of_symbol(log.read([closed, *old], BAR_SCHEMA)), "latest", tier=0)
        log.replace([*parts, *old], [closed, latest, rest.result()])
    log.merge_tiers("open", FANOUT, lambda p: last_of_cycle(log.read(p, BAR_SCHEMA)))
    log.merge_tiers("marks", FANOUT, lambda p: highest(log.read(p, MARKS_SCHEMA)))
    log.merge_tiers("snapshot", FANOUT, lambda p: log.read(p, BAR_SCHEMA))
    log.merge_tiers("deltas", FANOUT, lambda p: last_of_cycle(log.read(p, BAR_SCHEMA)).sort("cycle", "symbol"),
                    facts=lambda p: {"lo": min(x["lo"] for x in p), "hi": max(x["hi"] for x in p)})


def start_snapshot_delta(source: DataFrame, sink: str, checkpoint: str, processing_time: str | None = None,
                         partitions: int | None = None) -> StreamingQuery:
    """ST4 stream; read it with :func:`history_view` or :func:`current_view`.

    Several runs may feed one sink; of two that close the same cycles one
    commits, the other's files are never read.
    """
    writer = committed_writer(CommitLog(source.sparkSession, sink), checkpoint, classify_realtime, cycle_outputs,
                              lambda log: close_cycles(log, partitions))
    return triggered(source.writeStream.foreachBatch(writer)
                     .option("checkpointLocation", checkpoint), processing_time).start()


def snapshot_view(log: CommitLog, day: Column | None = None) -> DataFrame:
    """The session day's bars of the first cycle.

    ``day`` is the session day of the snapshot; by default the trading day of
    the first cycle's latest bar (one row, joined, no driver action).
    """
    first = log.read(log.of_table("snapshot"), BAR_SCHEMA)
    if day is not None:
        return first.where(F.to_date("ts") == day)
    clock = first.agg(trading_day(F.max("ts")).alias("_day"))
    return first.join(F.broadcast(clock), F.to_date("ts") == F.col("_day")).drop("_day")


def overlapping(parts: list[dict]) -> tuple[list[dict], list[dict]]:
    """Parts that share no cycle with another one, and the others."""
    alone, shared, group, hi = [], [], [], None
    for p in [*sorted(parts, key=lambda p: (p["lo"], p["hi"])), None]:
        if p is None or hi is None or p["lo"] > hi:
            (alone if len(group) == 1 else shared).extend(group)
            group = []
        if p is not None:
            group.append(p)
            hi = max(p["hi"], hi if hi is not None else p["hi"])
    return alone, shared


def delta_view(log: CommitLog) -> DataFrame:
    """Each symbol's last bar of every later cycle: closed cycles as stored, open and late rows merged."""
    parts, waiting = log.of_table("deltas"), log.of_table("open")
    done = closed_through(log)
    late = log.read(waiting, BAR_SCHEMA).agg(F.min("cycle")).first()[0] if waiting and done else None
    bounds = [{"lo": late, "hi": done}] if late is not None and late <= done else []  # late rows touch what they overlap
    alone, shared = overlapping(parts + bounds)
    alone, shared = ([p for p in ps if "folder" in p] for ps in (alone, shared))
    merged = last_of_cycle(log.read(shared + waiting, BAR_SCHEMA))
    return log.read(alone, BAR_SCHEMA).unionByName(merged)


def history_view(spark: SparkSession, sink: str, day: Column | None = None) -> DataFrame:
    """ST4: the snapshot of the session day, then each symbol's last bar per cycle."""
    log = CommitLog(spark, sink)
    return snapshot_view(log, day).unionByName(delta_view(log))


def current_view(spark: SparkSession, sink: str, day: Column | None = None) -> DataFrame:
    """ST4 as a page shows it now: the snapshot of the session day and each symbol's last delta."""
    log = CommitLog(spark, sink)
    deltas = last_of_symbol(log.read(log.of_table("latest") + log.of_table("open"), BAR_SCHEMA))
    return snapshot_view(log, day).unionByName(deltas)
