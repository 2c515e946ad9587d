"""Structured Streaming ingest (S4, S5, S10, ST1, ST2).

* Sources: a message bus (``format("kafka")``: key, value, partition,
  offset, timestamp) or, offline, Parquet files with the same columns.
  ``startingOffsets="earliest"`` replays all history (S4);
  ``"latest"`` tails new messages only (S5).
* The stream runs the very same decode/parse/validate functions as the
  batch tables (:mod:`barlake.operators.cleanse`), so batch = stream.
* Sink: ``foreachBatch`` writes each micro-batch into folders of its own and
  adds one entry to the sink's commit log, which makes all its outputs visible
  at once.  A batch run again after its entry does nothing; a replay from
  another checkpoint writes only source positions that the sink lacks, known
  from bitmaps of landed offsets.  The tables are unique on (partition, offset)
  however the batches are cut; executors do all writing.
* The counters (A7) are stored with each entry's positions and summed over the
  sink, so they cover a stream's whole life, restarts and replays included.
* Snapshot and delta (:mod:`barlake.streaming.cycles`) follow the producer's
  cycle number in the envelope, never the micro-batch number.
* Checkpoints live below the shared checkpoint root (S10); restarting with
  the same checkpoint resumes after the last committed batch.  If it is lost,
  a new one may start from the beginning, or from :func:`next_offsets`.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barlake.operators import cleanse
from barlake.schema import CYCLE_ENVELOPE_SCHEMA
from barlake.streaming.commits import CommitLog, Files, run_of

POLL_S = 5  # how often a running query is looked at
KAFKA_COLUMNS = ["key", "value", "partition", "offset", "timestamp"]


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "earliest",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Message-bus source (needs the Kafka connector on the classpath).

    Messages are keyed by symbol, so each symbol's messages keep their order
    in one partition and ``offset`` is a valid per-symbol arrival sequence.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets)
         .option("includeHeaders", True))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    df = r.load()
    return df.select("key", "value", "partition", "offset",
                     F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                     F.get(F.filter("headers", lambda h: h["key"] == "cycle"), 0)["value"]
                     .cast("string").try_cast("int").alias("cycle"))


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1, skip_missing: bool = False) -> DataFrame:
    """Offline stand-in for the bus: Parquet files with the envelope columns.

    A file that is gone when its batch runs is an error unless ``skip_missing``.
    """
    return (spark.readStream.schema(CYCLE_ENVELOPE_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger).option("ignoreMissingFiles", skip_missing)
            .parquet(path))


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """S6 sink: keyed JSON messages to a topic (batch write from executors)."""
    (messages.select("key", "value").write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def land_envelopes(envelopes: DataFrame, path: str, rows_per_file: int) -> None:
    """Write envelopes as stream input files of at most ``rows_per_file`` rows.

    One parallel pass (``maxRecordsPerFile`` splits each task's output); the
    ingest pipeline does not depend on file order.
    """
    (envelopes.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
     .parquet(path))


def cycle_size(df: DataFrame, order: str, cycles: int) -> int:
    """Rows of ``order`` range per cycle so ``cycles`` cycles cover the table."""
    hi = df.agg(F.max(order)).first()[0]
    return max(1, -(-(int(hi) + 1) // cycles)) if hi is not None else 1


def land_cycle(df: DataFrame, path: str, order: str, size: int, cycle: int, cycles: int,
               files: int | None = None) -> None:
    """Append the rows of one producer cycle, stamped with their ``cycle``.

    A row belongs to cycle ``order // size``; rows without an order or below
    0 belong to the first cycle and those beyond the last to the last one, so
    every row lands.  One parallel write, in at least ``files`` files if given.
    """
    at = F.coalesce(F.floor(F.col(order) / size), F.lit(0))
    rows = df.where(F.greatest(F.least(at, F.lit(cycles - 1)), F.lit(0)) == cycle)
    rows = rows.repartition(files) if files else rows
    rows.withColumn("cycle", F.lit(cycle)).write.mode("append").parquet(path)


def replay_in_cycles(df: DataFrame, path: str, order: str, cycles: int,
                     start: Callable[[], StreamingQuery], first: int = 0,
                     last: int | None = None, size: int | None = None,
                     files: int | None = None) -> int:
    """Ordered replay: land cycle c, let the stream consume it, then land c+1.

    Each ``start()`` resumes the same checkpointed query with
    ``availableNow``, so per-symbol arrival order is preserved across
    batches, whatever the file modification times; a cycle may take any
    number of micro-batches.  The number of cycles is fixed, not
    data-dependent.  Returns the cycle size.
    """
    size = size or cycle_size(df, order, cycles)
    last = cycles - 1 if last is None else last
    for c in range(first, last + 1):
        land_cycle(df, path, order, size, c, cycles, files)
        run_to_end(start())
    return size


POSITION_KEY = ["partition", "seq"]
# Landed source positions: one bitmap per partition and run of 2^15 offsets, with counters.
POSITIONS = "positions"
POSITION_BITS = 15
POSITIONS_SCHEMA = ("partition INT, block BIGINT, landed BINARY, messages BIGINT, valid BIGINT, rejected BIGINT")
COUNTERS = ["messages", "valid", "rejected"]


def position_block(seq: Column) -> Column:
    return F.shiftright(seq, POSITION_BITS)


def position_bit(seq: Column) -> Column:
    return seq.bitwiseAND((1 << POSITION_BITS) - 1)


def positions(rows: DataFrame, valid: Column) -> DataFrame:
    """The source positions of ``rows`` as bitmaps, with how many rows are ``valid``.

    Rows without a position count, but can't be found again.
    """
    return (rows.groupBy(F.col("partition").cast("int").alias("partition"), position_block(F.col("seq")).alias("block"))
            .agg(F.bitmap_construct_agg(position_bit(F.col("seq"))).alias("landed"), F.count(F.lit(1)).alias("messages"),
                 F.count_if(valid).alias("valid"), F.count_if(~valid).alias("rejected")))


def not_landed(rows: DataFrame, landed: DataFrame) -> DataFrame:
    """Rows whose source position is in none of the bitmaps.

    The bitmaps of a block are merged and joined by (partition, block): what
    is read of a sink is one bit per message, never its rows.
    """
    blocks = (landed.where("block is not null")
              .groupBy(F.col("partition").alias("_partition"), F.col("block").alias("_block"))
              .agg(F.bitmap_or_agg("landed").alias("_landed")))
    bit = position_bit(F.col("seq"))
    byte = F.conv(F.hex(F.substring("_landed", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = F.getbit(byte, bit.bitwiseAND(7).cast("int")) == 1
    joined = rows.join(blocks, (F.col("partition") == F.col("_partition"))
                       & (position_block(F.col("seq")) == F.col("_block")), "left")
    return joined.where(~F.coalesce(found, F.lit(False))).select(*rows.columns)


def commit_batch(log: CommitLog, run: str, batch_id: int, base: DataFrame,
                 outputs: Callable[[DataFrame, int], dict[str, DataFrame]]) -> None:
    """Write the outputs of one micro-batch's rows and make them part of the sink, once.

    Within a run the checkpoint hands out each position once; against other
    runs the landed positions are looked up.  If another writer's entry comes
    first, the batch is looked at again with what that one landed.
    """
    while True:
        log.refresh()
        if log.done(run, batch_id):
            return
        others = [p for p in log.of_table(POSITIONS) if p["run"] != run]
        rows = not_landed(base, log.read(others, POSITIONS_SCHEMA)) if others else base
        tables = {**outputs(rows, batch_id), POSITIONS: positions(rows, F.col("reason").isNull())}
        with ThreadPoolExecutor(len(tables)) as pool:  # small jobs over the same persisted rows
            parts = list(pool.map(lambda name: log.write(tables[name], name, tier=0), tables))
        if log.add({"run": run, "batch": batch_id, "add": parts}):
            return


def committed_writer(log: CommitLog, checkpoint: str, prepare: Callable[[DataFrame, int], DataFrame],
                     outputs: Callable[[DataFrame, int], dict[str, DataFrame]],
                     upkeep: Callable[[CommitLog], None] = lambda log: None):
    """foreachBatch function of :func:`commit_batch`.

    ``prepare`` turns the raw micro-batch into the classified frame that all
    outputs derive from; it is persisted while they are written, so the batch
    is read and parsed once.  ``upkeep`` of the sink follows each batch.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        run = run_of(log.spark, checkpoint)
        if log.done(run, batch_id):
            return  # replayed after its entry was added: the batch is not even read
        base = prepare(batch, batch_id).persist()
        try:
            commit_batch(log, run, batch_id, base, outputs)
        finally:
            base.unpersist()
        upkeep(log)
    return write


# --- S10: what a lost or interrupted run left behind --------------------------------
def next_offsets(spark: SparkSession, sink: str) -> DataFrame:
    """The first source offset of each partition that the sink lacks: ``partition``, ``next``.

    A stream that lost its checkpoint may start there: nothing below is
    missing, and what lies beyond and has landed is left out when it comes
    again.  Found by partition in the landed bitmaps: the first block that is
    not full or not followed by the next one.
    """
    log = CommitLog(spark, sink)
    size = 1 << POSITION_BITS
    blocks = (log.read(log.of_table(POSITIONS), POSITIONS_SCHEMA).where("partition is not null and block is not null")
              .groupBy("partition", "block").agg(F.bitmap_or_agg("landed").alias("landed")))
    start = F.col("block") * size
    ones = F.length(F.regexp_extract(F.hex("landed"), "^((?:FF)*)", 1)) / 2  # bytes without a gap
    byte = F.conv(F.hex(F.substring("landed", ones.cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.coalesce(*[F.when(F.getbit(byte, F.lit(k)) == 0, F.lit(k)) for k in range(8)])
    follower = F.lead("block").over(Window.partitionBy("partition").orderBy("block"))
    gap = (F.when(F.bitmap_count("landed") < size, start + ones.cast("bigint") * 8 + bit)
           .when(~follower.eqNullSafe(F.col("block") + 1), start + size))
    return blocks.select("partition", gap.alias("gap")).groupBy("partition").agg(F.min("gap").alias("next"))


def starting_offsets(topic: str, offsets: DataFrame) -> str:
    """:func:`next_offsets` as the bus source's ``startingOffsets`` (one row per source partition)."""
    return json.dumps({topic: {str(r["partition"]): r["next"] for r in offsets.collect()}})


def unfinished_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """The batch that a run planned but did not commit to its checkpoint, if there is one.

    It is run again after a restart; whether its rows landed says the sink's log.
    """
    planned, committed = ([int(n) for n in Files(spark, checkpoint).names(folder) if n.isdigit()]
                          for folder in ("offsets", "commits"))
    last = max(planned, default=None)
    return last if last is not None and last > max(committed, default=-1) else None


def ingest_outputs(classified: DataFrame, batch_id: int) -> dict[str, DataFrame]:
    """ST1 + ST5: valid bars and rejected messages of one micro-batch."""
    return {"bars": cleanse.to_bars(classified, keep=("partition",)),
            "rejects": classified.where(F.col("reason").isNotNull())
            .select("partition", "seq", "symbol_key", "reason", "json_data")}


def start_ingest(source: DataFrame, sink: str, checkpoint: str,
                 available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """ST1: append pipeline source -> decode -> parse -> validate -> sink.

    Classification runs on the streaming DataFrame, by the same functions as
    the batch tables.
    """
    classified = cleanse.classify(cleanse.parse_payload(cleanse.decode_envelope(source)))
    log = CommitLog(source.sparkSession, sink)
    w = (classified.writeStream.foreachBatch(committed_writer(log, checkpoint, lambda b, _: b, ingest_outputs))
         .option("checkpointLocation", checkpoint))
    return triggered(w, None if available_now else processing_time).start()


def triggered(writer, processing_time: str | None):
    """``processing_time`` keeps the query running at that pace (the reference
    cycles every 60 s); without it the query ends once all input is consumed."""
    return (writer.trigger(processingTime=processing_time) if processing_time
            else writer.trigger(availableNow=True))


def ingest_counters(spark: SparkSession, sink: str) -> DataFrame:
    """Messages, valid and rejected ones of everything the sink holds (one row).

    The counters are those stored with the batches' commits, so no batch is
    missing, however many there were, and none is counted twice.
    """
    log = CommitLog(spark, sink)
    return log.read(log.of_table(POSITIONS), POSITIONS_SCHEMA).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS])


def read_sink(spark: SparkSession, sink: str, name: str) -> DataFrame:
    """One output of all committed batches, unique on its source position."""
    log = CommitLog(spark, sink)
    parts = log.of_table(name)
    if not parts:
        raise ValueError(f"no batch has been committed to {sink}")
    return spark.read.parquet(*[f"{sink}/{p['folder']}" for p in parts])


def run_to_end(query: StreamingQuery, timeout_s: int = 600) -> None:
    """Wait for an ``availableNow`` query; raise if it failed, or if ``timeout_s`` pass without a finished batch."""
    batch, since = None, time.monotonic()
    while not query.awaitTermination(min(timeout_s, POLL_S)):
        last = query.lastProgress
        if last is not None and last["batchId"] != batch:
            batch, since = last["batchId"], time.monotonic()
        elif time.monotonic() - since >= timeout_s:
            query.stop()
            raise TimeoutError(f"stream {query.id} did not finish a batch in {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def share_of_files(spark: SparkSession, path: str, batches: int, at_least: int = 1) -> int:
    """Files per trigger that take what is landed in ``path`` in at most ``batches`` micro-batches.

    The cost of a micro-batch itself (offsets, commit, small jobs) is then paid
    a fixed number of times, however much is landed; a larger batch has more tasks.
    """
    files = sum(n.endswith(".parquet") for n in Files(spark, path).names())
    return max(at_least, -(-files // batches))
