"""Stream = batch twin on the small fixture."""
from barlake.plans.queries import REGISTRY, finalize
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_ingest_equals_batch(spark):
    assert _rows(REGISTRY["stream_ingest"](spark, SF_SMALL)) == _rows(REGISTRY["valid_bars"](spark, SF_SMALL))


def test_resume_and_replay_equal_batch(spark):
    want = _rows(REGISTRY["valid_bars"](spark, SF_SMALL))
    assert _rows(REGISTRY["stream_resume"](spark, SF_SMALL)) == want
    assert _rows(REGISTRY["stream_idempotent"](spark, SF_SMALL)) == want


def test_live_state_equals_batch_twin(spark):
    got = _rows(REGISTRY["stream_latest_state"](spark, SF_SMALL))
    assert got == _rows(REGISTRY["retain_last_n_cap10"](spark, SF_SMALL))


def _envelopes_landed(spark, rows_per_file=10000, files=None):
    from barlake.session import scratch_path
    from barlake.sources import fixtures as fx
    from barlake.streaming import ingest
    src = scratch_path(spark, "t_src")
    env = fx.envelopes(spark, SF_SMALL)
    ingest.land_envelopes(env.repartition(files) if files else env, src, rows_per_file)
    return src


def _ingested(spark, src, sink, checkpoint=None, files_per_trigger=1000):
    from barlake.session import scratch_path
    from barlake.streaming import ingest
    checkpoint = checkpoint or scratch_path(spark, "t_ckpt")
    ingest.run_to_end(ingest.start_ingest(ingest.file_stream(spark, src, files_per_trigger), sink, checkpoint))
    return checkpoint


def test_counters_cover_the_whole_stream(spark):
    """More batches than a query keeps progress reports for, a restart, and a replay: each message counts once."""
    from barlake.session import scratch_path
    from barlake.streaming import ingest
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        src, sink = _envelopes_landed(spark, files=40), scratch_path(spark, "t_sink")
        assert ingest.ingest_counters(spark, sink).first().asDict() == {"messages": 0, "valid": 0, "rejected": 0}
        ckpt = _ingested(spark, src, sink, files_per_trigger=1)
        assert ingest.CommitLog(spark, sink).number == 40
        _ingested(spark, src, sink, ckpt)
        _ingested(spark, src, sink, files_per_trigger=30)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    c = ingest.ingest_counters(spark, sink).first()
    assert c["valid"] == ingest.read_sink(spark, sink, "bars").count()
    assert c["rejected"] == ingest.read_sink(spark, sink, "rejects").count()
    assert c["messages"] == spark.read.parquet(src).count()


def test_replay_reads_no_bar_file(spark):
    """The landed bar files may be gone: a replay looks positions up in the log's bitmaps alone."""
    from barlake.session import scratch_path
    from barlake.streaming import ingest
    from barlake.streaming.commits import Files
    src, sink = _envelopes_landed(spark, files=3), scratch_path(spark, "t_sink")
    _ingested(spark, src, sink)
    Files(spark, sink).delete("bars")
    _ingested(spark, src, sink, files_per_trigger=2)
    log = ingest.CommitLog(spark, sink)
    assert len(log.runs) == 2
    later = [p for p in log.of_table("bars") if p["at"] > 1]
    assert later and log.read(later, "symbol string").count() == 0


def test_lost_checkpoint_leaves_no_gap_and_no_duplicate(spark, tmp_path):
    """The checkpoint's folder is used again by a new query whose batches start at 0."""
    from barlake.session import scratch_path
    from barlake.sources import fixtures as fx
    from barlake.streaming import ingest
    src, sink, ckpt = (scratch_path(spark, n) for n in ("t_src", "t_sink", "t_ckpt"))
    env = fx.envelopes(spark, SF_SMALL)
    n = env.count()
    env.where(f"offset < {n // 2}").write.parquet(src)
    _ingested(spark, src, sink, ckpt)
    assert ingest.unfinished_batch(spark, ckpt) is None
    env.where(f"offset >= {n // 2}").write.mode("append").parquet(src)
    spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jsc.hadoopConfiguration()).delete(
        spark._jvm.org.apache.hadoop.fs.Path(ckpt), True)
    _ingested(spark, src, sink, ckpt)
    got = _rows(finalize(ingest.read_sink(spark, sink, "bars").drop("partition")))
    assert got == _rows(REGISTRY["valid_bars"](spark, SF_SMALL))


def test_batch_that_failed_after_its_files_or_after_its_entry(spark, monkeypatch):
    """Planned and not committed: run again, and its files count once, wherever it stopped."""
    import pytest

    from barlake.session import scratch_path
    from barlake.streaming import ingest
    from barlake.streaming.commits import CommitLog
    want = _rows(REGISTRY["valid_bars"](spark, SF_SMALL))
    for late in (False, True):
        src, sink, ckpt = _envelopes_landed(spark, files=2), *(scratch_path(spark, n) for n in ("t_sink", "t_ckpt"))
        add = CommitLog.add

        def fails(self, entry):
            if late:
                add(self, entry)
            raise OSError("lost the driver")
        with monkeypatch.context() as m:
            m.setattr(CommitLog, "add", fails)
            with pytest.raises(Exception, match="lost the driver"):
                _ingested(spark, src, sink, ckpt)
        assert ingest.unfinished_batch(spark, ckpt) == 0
        assert CommitLog(spark, sink).number == int(late)
        _ingested(spark, src, sink, ckpt)
        assert ingest.unfinished_batch(spark, ckpt) is None
        assert _rows(finalize(ingest.read_sink(spark, sink, "bars").drop("partition"))) == want, late


def test_two_writers_land_each_position_once(spark, monkeypatch):
    """Another run's entry comes between a batch's look at the log and its own entry."""
    from barlake.session import scratch_path
    from barlake.streaming import ingest
    from barlake.streaming.commits import CommitLog
    src, sink = _envelopes_landed(spark, files=2), scratch_path(spark, "t_sink")
    add, entered = CommitLog.add, []

    def slow(self, entry):
        if not entered:
            entered.append(1)
            _ingested(spark, src, sink)
        return add(self, entry)
    monkeypatch.setattr(CommitLog, "add", slow)
    _ingested(spark, src, sink)
    got = _rows(finalize(ingest.read_sink(spark, sink, "bars").drop("partition")))
    assert got == _rows(REGISTRY["valid_bars"](spark, SF_SMALL))


def test_next_offsets_and_landed_positions(spark):
    """Full blocks, gaps inside and between blocks, several parts per block, null and negative positions."""
    from pyspark.sql import functions as F

    from barlake.session import scratch_path
    from barlake.streaming import ingest
    from barlake.streaming.commits import CommitLog
    size = 1 << ingest.POSITION_BITS
    landed = {0: set(range(size + 100)), 1: set(range(2 * size)), 2: set(range(40)) | set(range(41, 90)),
              3: set(range(size)) | set(range(2 * size, 2 * size + 5)), 4: {size - 1, size, 7}}
    rows = [(p, s, None if s % 3 else "bad") for p, seqs in landed.items() for s in seqs]
    rows += [(None, 5, None), (6, None, None), (7, -3, None)]
    df = spark.createDataFrame(rows, "partition int, seq bigint, reason string")
    log = CommitLog(spark, scratch_path(spark, "t_sink"))
    for k in range(2):
        half = df.where(F.coalesce(F.pmod("seq", F.lit(2)), F.lit(0)) == k)
        part = log.write(ingest.positions(half, F.col("reason").isNull()), ingest.POSITIONS)
        assert log.add({"run": "r", "batch": k, "add": [part]})
    got = {r["partition"]: r["next"] for r in ingest.next_offsets(spark, log.sink).collect()}
    assert {k: got[k] for k in landed} == {0: size + 100, 1: 2 * size, 2: 40, 3: size, 4: 0}
    asked = [(p, s, None) for p in range(6) for s in (0, 7, 39, 40, 41, 90, size - 1, size, size + 99, size + 100, 2 * size,
                                                      2 * size + 4, 2 * size + 5)]
    asked += [(None, 5, None), (6, None, None), (7, -3, None), (7, -4, None)]
    left = ingest.not_landed(spark.createDataFrame(asked, df.schema),
                             log.read(log.of_table(ingest.POSITIONS), ingest.POSITIONS_SCHEMA))
    assert {(r[0], r[1]) for r in left.collect()} == {
        (p, s) for p, s, _ in asked if s not in landed.get(p, ()) and (p, s) != (7, -3)} | {(None, 5)}
    counts = ingest.ingest_counters(spark, log.sink).first()
    assert counts["messages"] == len(rows) and counts["rejected"] == sum(r[2] == "bad" for r in rows)
    assert ingest.starting_offsets("bars", ingest.next_offsets(spark, log.sink).where("partition = 2")) \
        == '{"bars": {"2": 40}}'


def test_replay_in_any_cut_adds_nothing(spark):
    """Three runs with other file limits over the same source: the table stays unique on its position."""
    from barlake.session import scratch_path
    from barlake.sources import fixtures as fx
    from barlake.streaming import ingest
    src, sink = scratch_path(spark, "r_src"), scratch_path(spark, "r_sink")
    ingest.land_envelopes(fx.envelopes(spark, SF_SMALL).repartition(5), src, 10000)
    for limit in (2, 5, 1):
        ingest.run_to_end(ingest.start_ingest(
            ingest.file_stream(spark, src, limit), sink, scratch_path(spark, "r_ckpt")))
    got = _rows(finalize(ingest.read_sink(spark, sink, "bars").drop("partition")))
    assert got == _rows(REGISTRY["valid_bars"](spark, SF_SMALL))


def test_snapshot_and_delta_do_not_depend_on_batches(spark):
    from barlake.session import scratch_path
    from barlake.sources import fixtures as fx
    from barlake.streaming import cycles, ingest
    out = []
    for files, limit in ((4, 1), (1, 50), (3, 2)):
        src, sink, ckpt = (scratch_path(spark, n) for n in ("s_src", "s_sink", "s_ckpt"))
        ingest.replay_in_cycles(
            fx.envelopes(spark, SF_SMALL), src, "offset", 2,
            lambda: cycles.start_snapshot_delta(ingest.file_stream(spark, src, limit), sink, ckpt), files=files)
        out.append(_rows(cycles.history_view(spark, sink).drop("partition")))
    assert out[0] and out[0] == out[1] == out[2]


CYCLE_ROWS = "symbol string, ts timestamp_ntz, seq bigint, close double, partition int, cycle int"


def _cycle_batches(rows, size):
    return [rows[k:k + size] for k in range(0, len(rows), size)]


def _add_cycle_batch(spark, sink, run, batch_id, rows, partitions=None):
    """One micro-batch of classified messages, committed and followed by its upkeep as the stream does it."""
    from pyspark.sql import functions as F

    from barlake.streaming import cycles, ingest
    df = spark.createDataFrame(rows, CYCLE_ROWS).select(
        F.lit(None).cast("string").alias("reason"), "symbol", "ts", "seq",
        *[F.col("close").alias(c) for c in ("open", "high", "low", "close", "volume")], "partition", "cycle")

    def outputs(bars, _):
        bars = bars.drop("reason").withColumn("cycle", cycles.cycle_number())
        return {"snapshot": bars.where("cycle = 0"), "open": cycles.last_of_cycle(bars.where("cycle > 0")),
                "marks": cycles.highest(bars.select("partition", "cycle"))}
    log = ingest.CommitLog(spark, sink)
    ingest.commit_batch(log, run, batch_id, df, outputs)
    cycles.close_cycles(log, partitions)
    return log


def _cycle_rows(last, partitions=2, symbols=3):
    """Cycles 0 to ``last``, each with two bars of every symbol, in the order of each partition."""
    import datetime as dt
    start, rows, seq = dt.datetime(2024, 1, 2, 10), [], [0] * partitions
    for c in range(last + 1):
        for s in range(symbols):
            for k in range(2):
                p = s % partitions
                rows.append((f"S{s}", start + dt.timedelta(minutes=c, seconds=k), seq[p], float(10 * c + k), p, c))
                seq[p] += 1
    return rows


def _history_twin(rows):
    """The snapshot and each symbol's last bar per cycle, by a plain loop."""
    last, first = {}, set()
    for r in rows:
        symbol, ts, seq, close, partition, cycle = r
        cycle = max(cycle or 0, 0)
        if cycle == 0:
            first.add((symbol, ts, seq, close, cycle))
        else:
            last[symbol, cycle] = max(last.get((symbol, cycle), (ts, -1, 0.0)), (ts, seq, close))
    return sorted(first | {(s, ts, seq, close, c) for (s, c), (ts, seq, close) in last.items()})


def _current_twin(rows):
    history = _history_twin(rows)
    newest = {}
    for r in history:
        if r[4] > 0 and r[4] >= newest.get(r[0], (0,) * 5)[4]:
            newest[r[0]] = r
    return sorted([r for r in history if r[4] == 0] + list(newest.values()))


def _shown(view):
    return sorted(tuple(r) for r in view.select("symbol", "ts", "seq", "close", "cycle").collect())


def test_closed_cycles_are_merged_and_what_is_read_does_not_grow(spark):
    """20 cycles in batches of other lengths: results as a plain loop's, and few parts and rows to read at any time."""
    from barlake.session import scratch_path
    from barlake.streaming import cycles
    sink, rows = scratch_path(spark, "y_sink"), _cycle_rows(20)
    sizes = []
    for k, batch in enumerate(_cycle_batches(rows, 14)):
        log = _add_cycle_batch(spark, sink, "a", k, batch, partitions=2)
        current = log.read(log.of_table("latest") + log.of_table("open"), cycles.BAR_SCHEMA)
        sizes.append((current.count(), sum(len(log.of_table(t)) for t in ("latest", "open", "marks"))))
    assert cycles.closed_through(log) == 19
    assert max(n for n, _ in sizes) <= 3 * 4 and max(n for _, n in sizes) <= 1 + 2 * cycles.FANOUT
    assert _shown(cycles.history_view(spark, sink)) == _history_twin(rows)
    assert _shown(cycles.current_view(spark, sink)) == _current_twin(rows)
    deltas = log.read(log.of_table("deltas"), cycles.BAR_SCHEMA)
    assert deltas.count() == deltas.select("symbol", "cycle").distinct().count() == 19 * 3
    assert not cycles.overlapping(log.of_table("deltas"))[1]


def test_a_cycle_waits_for_all_partitions_and_late_rows_are_merged(spark):
    """A lagging or unknown partition holds cycles open; rows for closed cycles, without a cycle or below 0 all count."""
    import datetime as dt

    from barlake.session import scratch_path
    from barlake.streaming import cycles
    sink, rows = scratch_path(spark, "y_sink"), _cycle_rows(6)
    ahead, behind = ([r for r in rows if r[4] == p] for p in (0, 1))
    log = _add_cycle_batch(spark, sink, "a", 0, ahead, partitions=2)
    assert cycles.closed_through(log) == 0 and _shown(cycles.history_view(spark, sink)) == _history_twin(ahead)
    log = _add_cycle_batch(spark, sink, "a", 1, [r for r in behind if r[5] <= 3], partitions=2)
    assert cycles.closed_through(log) == 2
    log = _add_cycle_batch(spark, sink, "a", 2, [r for r in behind if r[5] > 3], partitions=2)
    assert cycles.closed_through(log) == 5
    day = dt.datetime(2024, 1, 2, 11)
    late = [("S0", day, 900, 1.0, 0, 2), ("S9", day, 901, 2.0, 0, 4), ("S1", day - dt.timedelta(hours=3), 902, 3.0, 0, 1),
            ("S0", day, 903, 4.0, 0, None), ("S0", day, 904, 5.0, 0, -3), ("S7", day, 905, 6.0, None, 5)]
    log = _add_cycle_batch(spark, sink, "a", 3, late, partitions=2)
    want = rows + late
    assert cycles.closed_through(log) == 5
    assert _shown(cycles.history_view(spark, sink)) == _history_twin(want)
    assert _shown(cycles.current_view(spark, sink)) == _current_twin(want)
    more = [(s, day, 1000 + k, 7.0, p, 8) for k, (s, p) in enumerate([("S0", 0), ("S1", 1)])]
    log = _add_cycle_batch(spark, sink, "a", 4, more, partitions=2)
    assert cycles.closed_through(log) == 7 and cycles.overlapping(log.of_table("deltas"))[1]
    assert _shown(cycles.history_view(spark, sink)) == _history_twin(want + more)
    assert _shown(cycles.current_view(spark, sink)) == _current_twin(want + more)


def test_cycles_replayed_by_another_run_and_a_closing_that_fails(spark, monkeypatch):
    """A second run sends everything again in other batches, and a failed closing is done by the next batch."""
    import pytest

    from barlake.session import scratch_path
    from barlake.streaming import cycles
    sink, rows = scratch_path(spark, "y_sink"), _cycle_rows(8)
    first, second = rows[:25], rows[25:]
    replace = cycles.CommitLog.replace

    def failing(self, old, new):
        raise OSError("store not reached")
    monkeypatch.setattr(cycles.CommitLog, "replace", failing)
    with pytest.raises(OSError):
        _add_cycle_batch(spark, sink, "a", 0, first)
    assert _shown(cycles.history_view(spark, sink)) == _history_twin(first)
    monkeypatch.setattr(cycles.CommitLog, "replace", replace)
    for k, batch in enumerate(_cycle_batches(rows, 20)):
        log = _add_cycle_batch(spark, sink, "b", k, batch)
    assert cycles.closed_through(log) == 7 and second
    assert _shown(cycles.history_view(spark, sink)) == _history_twin(rows)
    assert _shown(cycles.current_view(spark, sink)) == _current_twin(rows)


def test_closed_cycles_are_read_without_a_shuffle(spark):
    from barlake.session import scratch_path
    from barlake.streaming import cycles
    sink = scratch_path(spark, "y_sink")
    log = _add_cycle_batch(spark, sink, "a", 0, _cycle_rows(5))
    alone, shared = cycles.overlapping(log.of_table("deltas"))
    assert len(alone) == 1 and not shared
    plan = cycles.last_of_symbol(log.read(log.of_table("latest"), cycles.BAR_SCHEMA))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Exchange hashpartitioning") == 1
    ranges = [{"lo": a, "hi": b} for a, b in ((1, 4), (5, 5), (6, 9), (8, 8), (9, 12), (13, 13))]
    alone, shared = cycles.overlapping(ranges[::-1])
    assert alone == [ranges[0], ranges[1], ranges[5]] and shared == ranges[2:5]
    assert cycles.overlapping([]) == ([], [])


STATE_ROWS = "symbol string, date date, seq bigint, open double, high double, low double, close double, volume double"


def _state_rows(arrivals):
    import datetime as dt
    return [(symbol, dt.date(2024, 1, 1) + dt.timedelta(days=d), seq, *([float(seq)] * 5))
            for symbol, d, seq in arrivals]


def test_live_state_is_repeatable_and_outlives_its_runs(spark):
    """A repeated batch changes nothing, late and re-sent dates enter by arrival, and a new run goes on with the table."""
    from barlake.operators.dedup import live_state
    from barlake.session import scratch_path
    from barlake.streaming import state
    sink = scratch_path(spark, "l_sink")
    log = state.CommitLog(spark, sink)
    assert state.live_view(spark, sink, cap=3).collect() == []
    rows = _state_rows([("A", d, seq) for seq, d in enumerate([0, 1, 2, 3, 0, 4, 5, 1, 1, 6])])
    for k in range(5):
        batch = spark.createDataFrame(rows[2 * k:2 * k + 2], STATE_ROWS)
        state.merge_batch(batch, k, log, "first", cap=3)
        state.merge_batch(batch, k, log, "first", cap=3)
    assert log.number == 5
    more = _state_rows([(s, d, 100 + k) for k, (s, d) in enumerate([("B", 1), ("A", 9), ("C", 1), ("B", 2)])])
    for k in range(6):  # a new checkpoint counts from 0 and sends some rows again
        batch = spark.createDataFrame(more[k:k + 1] + rows[k:k + 3], STATE_ROWS)
        state.merge_batch(batch, k, state.CommitLog(spark, sink), "second", cap=3)
    want = live_state(spark.createDataFrame(rows + more, STATE_ROWS), cap=3)
    assert _rows(state.live_view(spark, sink, cap=3)) == _rows(want.select(*state.COLUMNS))
    state.merge_batch(spark.createDataFrame([], STATE_ROWS), 6, state.CommitLog(spark, sink), "second", cap=3)
    assert state.live_view(spark, sink, cap=3).count() == 6


def test_live_state_writes_by_the_batch_and_merges_by_tiers(spark, monkeypatch):
    """70 batches with a fanout of 4: few parts are read, a row is written once per tier, old files go."""
    from pyspark.sql import functions as F

    from barlake.operators.dedup import live_state
    from barlake.session import scratch_path
    from barlake.streaming import state
    from barlake.streaming.commits import Files
    monkeypatch.setattr(state, "FANOUT", 4)
    sink = scratch_path(spark, "l_sink")
    log, written = state.CommitLog(spark, sink), []
    write = state.CommitLog.write

    def counted(self, df, table, **facts):
        part = write(self, df, table, **facts)
        written.append((facts["tier"], self.read([part], state.STATE_SCHEMA).count()))
        return part
    monkeypatch.setattr(state.CommitLog, "write", counted)
    rows = _state_rows([(f"S{k % 50}", k // 50, k) for k in range(210)])
    df = spark.createDataFrame(rows, STATE_ROWS).cache()
    for k in range(70):
        state.merge_batch(df.where(F.col("seq").between(3 * k, 3 * k + 2)).coalesce(1), k, log, "r", cap=1000)
    assert all(n == 3 for tier, n in written if tier == 0)
    assert sum(n for _, n in written) <= 210 * 4  # tiers 0 to 3
    parts = state.CommitLog(spark, sink).of_table(state.TABLE)
    assert parts == log.of_table(state.TABLE) and len(parts) == 70 // 64 + 6 // 4 + 70 % 4
    assert len(Files(spark, sink).names("state")) <= len(parts) + state.FANOUT * (state.KEPT_ENTRIES + 1)
    assert _rows(state.live_view(spark, sink)) == _rows(live_state(df).select(*state.COLUMNS))
    df.unpersist()


def test_commit_log_survives_summaries_and_rivals(spark):
    """A log opened anew equals the one that wrote it; of two writers of one number the second looks again."""
    from barlake.session import scratch_path
    from barlake.streaming.commits import SUMMARY_EVERY, CommitLog
    sink = scratch_path(spark, "c_sink")
    one, two = CommitLog(spark, sink), CommitLog(spark, sink)
    for k in range(SUMMARY_EVERY + 3):
        assert one.add({"run": "a", "batch": k, "add": [{"table": "t", "folder": f"t/{k}"}],
                        "remove": [f"t/{k - 1}"] if k % 2 else []})
    assert not two.add({"run": "b", "batch": 0, "add": [{"table": "t", "folder": "t/x"}]})
    assert two.number == one.number and not two.done("b", 0) and two.done("a", 5)
    assert two.add({"run": "b", "batch": 0, "add": [{"table": "t", "folder": "t/x"}]})
    one.refresh()
    for log in (two, CommitLog(spark, sink)):
        assert (log.number, log.runs, log.parts) == (one.number, one.runs, one.parts)
        assert sorted(map(tuple, log.removed)) == sorted(map(tuple, one.removed))


def test_poison_files_are_quarantined_and_the_rest_lands(spark, tmp_path):
    """Three damaged files among many, over several batches: named, moved whole, and all other messages counted."""
    import os
    import random

    from barlake.session import scratch_path
    from barlake.streaming import ingest
    from barlake.streaming.supervise import run_supervised
    src, sink, ckpt, aside = _envelopes_landed(spark, files=24), *(
        scratch_path(spark, n) for n in ("t_sink", "t_ckpt", "t_aside"))
    folder = src.removeprefix("file:")
    files = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))
    bad = random.Random(4).sample(files, 3)
    lost = spark.read.parquet(*[f"{src}/{f}" for f in bad]).count()
    total = spark.read.parquet(src).count()
    for k, f in enumerate(bad):
        path = os.path.join(folder, f)
        data = open(path, "rb").read()
        open(path, "wb").write([b"", data[:len(data) // 2], data[:200] + b"\0" * (len(data) - 210) + data[-10:]][k] or b"x")
        if os.path.exists(os.path.join(folder, f".{f}.crc")):
            os.remove(os.path.join(folder, f".{f}.crc"))

    def start(skip_missing):
        return ingest.start_ingest(ingest.file_stream(spark, src, 10, skip_missing), sink, ckpt)
    report = run_supervised(spark, start, ckpt, aside, pause_s=0)
    assert sorted(old.rsplit("/", 1)[-1] for old, _ in report.quarantined) == sorted(bad) and report.restarts == 0
    assert len([f for f in os.listdir(aside.removeprefix("file:")) if f.endswith(".parquet")]) == 3
    assert ingest.ingest_counters(spark, sink).first()["messages"] == total - lost
    assert ingest.unfinished_batch(spark, ckpt) is None


def test_restarts_are_bounded(spark, monkeypatch):
    import pytest

    from barlake.session import scratch_path
    from barlake.streaming import ingest
    from barlake.streaming.supervise import run_supervised
    src, sink, ckpt, aside = _envelopes_landed(spark, files=2), *(
        scratch_path(spark, n) for n in ("t_sink", "t_ckpt", "t_aside"))
    commit, failures = ingest.commit_batch, []

    def flaky(*args):
        failures.append(1)
        if len(failures) <= 2:
            raise OSError("store not reached")
        return commit(*args)
    monkeypatch.setattr(ingest, "commit_batch", flaky)

    def start(skip_missing):
        assert not skip_missing
        return ingest.start_ingest(ingest.file_stream(spark, src, 10), sink, ckpt)
    with pytest.raises(Exception, match="store not reached"):
        run_supervised(spark, start, ckpt, aside, retries=1, pause_s=0)
    assert run_supervised(spark, start, ckpt, aside, retries=1, pause_s=0).restarts == 0
    failures.clear()
    src2, sink2, ckpt2 = _envelopes_landed(spark, files=2), scratch_path(spark, "s"), scratch_path(spark, "c")
    report = run_supervised(spark, lambda skip: ingest.start_ingest(ingest.file_stream(spark, src2, 10), sink2, ckpt2),
                            ckpt2, aside, retries=2, pause_s=0)
    assert report.restarts == 2 and ingest.read_sink(spark, sink2, "bars").count() > 0


def test_number_of_batches_does_not_grow_with_the_files(spark):
    from barlake.session import scratch_path
    from barlake.streaming import ingest
    src, sink = _envelopes_landed(spark, files=40), scratch_path(spark, "t_sink")
    share = ingest.share_of_files(spark, src, 6)
    _ingested(spark, src, sink, files_per_trigger=share)
    assert (share, ingest.CommitLog(spark, sink).number) == (7, 6)
    assert ingest.share_of_files(spark, src, 100) == 1 and ingest.share_of_files(spark, src, 100, at_least=3) == 3


def test_a_long_stream_that_goes_on_is_not_stopped():
    """The time limit is for a batch, not for the whole stream."""
    import pytest
    from barlake.streaming import ingest

    class Query:
        id, lastProgress, stopped = "q", None, False

        def __init__(self, batches):
            self.batches, self.looks = batches, 0

        def awaitTermination(self, timeout):
            import time
            time.sleep(0.4)
            self.looks += 1
            self.lastProgress = {"batchId": min(self.looks, self.batches)}
            return self.looks > 5 and self.batches > 5

        def exception(self):
            return None

        def stop(self):
            self.stopped = True

    ingest.run_to_end(Query(9), timeout_s=1)
    stuck = Query(1)
    with pytest.raises(TimeoutError, match="did not finish"):
        ingest.run_to_end(stuck, timeout_s=1)
    assert stuck.stopped
