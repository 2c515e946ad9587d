"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (or data Spark derives from them and
writes to the shared scratch folder) in full.  Output doubles are rounded
to 6 places so results compare exactly with the DuckDB oracle in
:mod:`barlake.plans.oracles`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.functions.expressions import trading_day
from barlake.operators import catalog, cleanse, dedup, intraday, models, moments
from barlake.operators.coverage_table import CoverageTable
from barlake.operators.indicators import rolling_indicators, with_day_index
from barlake.plans import datasets
from barlake.sources import fixtures as fx
from barlake.session import scratch_path
from barlake.sources import readers as sources
from barlake.streaming import cycles, ingest, state

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = lambda spark, sf_dir: finalize(fn(spark, sf_dir))
        REGISTRY[name].__doc__ = fn.__doc__
        return fn
    return deco


def compare_round(c: Column) -> Column:
    """6 decimals below 1000, 9 significant digits from 1000 up.

    Two engines summing in different orders agree to ~1e-15 relative, so a
    fixed 6-decimal rounding of values like a 4e8 MSE would compare noise.
    The rounding boundary is shifted by a tiny fixed offset (far above float
    noise, far below the rounding step) so exact rational results such as
    60.8121875 never sit on a tie.  Powers of ten use exact positive
    exponents only, so both engines compute identical doubles.
    """
    a = F.abs(c)
    k = F.lit(8) - F.floor(F.log10(a))
    up = F.round(c * F.pow(F.lit(10.0), k) + F.lit(TIE_SHIFT_SCALED), 0) / F.pow(F.lit(10.0), k)
    down = F.round(c / F.pow(F.lit(10.0), -k) + F.lit(TIE_SHIFT_SCALED), 0) * F.pow(F.lit(10.0), -k)
    return (F.when(c.isNull() | F.isnan(c) | (a == float("inf")), c)
            .when(a < 1000, F.round(c + F.lit(TIE_SHIFT), 6))
            .when(k >= 0, up)
            .otherwise(down))


# Fixed values of the comparison rounding (must equal oracles.R).
TIE_SHIFT = 1.234567e-10
TIE_SHIFT_SCALED = 1.234567e-4


DATE_TEXT = "yyyy-MM-dd"
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def finalize(df: DataFrame) -> DataFrame:
    """Comparison contract with the oracle for registered outputs.

    Doubles (and double arrays) are rounded by :func:`compare_round`; DATE
    and TIMESTAMP columns are rendered as ISO text, because engines hand
    temporal values to Python differently (``date`` vs. midnight
    ``Timestamp``, micro- vs. nanosecond units) while text compares the
    same everywhere.  The library functions themselves keep typed columns.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(compare_round(F.col(f.name)).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(F.col(f.name), DATE_TEXT).alias(f.name))
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            cols.append(F.date_format(F.col(f.name), TIMESTAMP_TEXT).alias(f.name))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.DoubleType):
            cols.append(F.transform(F.col(f.name), compare_round).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# --- D1 / flagship -----------------------------------------------------------
@register("analysis_series")
def q_analysis_series(spark, sf_dir):
    """D1 over daily bars of every symbol."""
    return datasets.analysis_series(fx.bars_daily(spark, sf_dir))


@register("analysis_series_long")
def q_analysis_series_long(spark, sf_dir):
    """D1 over the long multi-year history."""
    return datasets.analysis_series(fx.bars_long(spark, sf_dir))


@register("latest_indicators")
def q_latest_indicators(spark, sf_dir):
    """Indicator card of every symbol."""
    return datasets.latest_indicators(fx.bars_daily(spark, sf_dir))


@register("history_series")
def q_history_series(spark, sf_dir):
    """OHLC history sorted by symbol and date."""
    return datasets.history_series(fx.bars_daily(spark, sf_dir))


# --- models ------------------------------------------------------------------
@register("linear_trend")
def q_linear_trend(spark, sf_dir):
    """M1: per-symbol slope, intercept, MSE and R^2."""
    return models.linear_fit(fx.bars_daily(spark, sf_dir)).select(
        "symbol", "n", "anchor", "slope", "intercept", "mse", "r2")


@register("quadratic_trend")
def q_quadratic_trend(spark, sf_dir):
    """M2: in-sample quadratic fit of every bar (long history, x up to ~2,500)."""
    bars = fx.bars_long(spark, sf_dir)
    return models.in_sample(bars, ["linear_fit", "poly_fit"]).select(
        "symbol", "date", F.col("day_index").cast("long").alias("day_index"),
        F.col("y").alias("close"), "linear_fit", "poly_fit")


@register("bagged_tree_trend")
def q_bagged_tree_trend(spark, sf_dir):
    """M3: expected bagged-tree fitted value of every bar."""
    bars = fx.bars_daily(spark, sf_dir)
    return models.in_sample(bars, ["rf_fit"]).select(
        "symbol", "date", F.col("y").alias("close"), "rf_fit")


@register("bagged_tree_trend_long")
def q_bagged_tree_trend_long(spark, sf_dir):
    """M3 on multi-year series: the +-50 row window crosses year blocks."""
    bars = fx.bars_long(spark, sf_dir)
    return models.in_sample(bars, ["rf_fit"]).select(
        "symbol", "date", F.col("y").alias("close"), "rf_fit")


@register("forecast_horizon")
def q_forecast_horizon(spark, sf_dir):
    """M4: the 30 calendar days after each symbol's last bar."""
    hz = models.forecast_horizon(models.fit_coefficients(fx.bars_daily(spark, sf_dir)))
    return hz.select("symbol", "h", "date", F.col("day_index").cast("long").alias("day_index"))


@register("forecasts")
def q_forecasts(spark, sf_dir):
    """M5: 30-day forecasts of all three models for every symbol."""
    return models.forecasts(fx.bars_daily(spark, sf_dir)).withColumn(
        "day_index", F.col("day_index").cast("long"))


@register("forecasts_long")
def q_forecasts_long(spark, sf_dir):
    """M5 on the long history (20,000 symbols at sf0.1)."""
    return models.forecasts(fx.bars_long(spark, sf_dir)).withColumn(
        "day_index", F.col("day_index").cast("long"))


@register("model_metrics")
def q_model_metrics(spark, sf_dir):
    """MSE and R^2 of the three models per symbol."""
    return models.model_metrics(fx.bars_daily(spark, sf_dir))


@register("prediction_series")
def q_prediction_series(spark, sf_dir):
    """History closes plus the three forecast lines."""
    return datasets.prediction_series(fx.bars_daily(spark, sf_dir))


# --- indicators --------------------------------------------------------------
def _indicators(spark, sf_dir):
    return rolling_indicators(fx.bars_daily(spark, sf_dir).select("symbol", "date", "close"))


@register("moving_average")
def q_moving_average(spark, sf_dir):
    """3-bar moving average of close."""
    return _indicators(spark, sf_dir).select("symbol", "date", "moving_average")


@register("daily_change")
def q_daily_change(spark, sf_dir):
    """Percent change of close against the previous bar."""
    return _indicators(spark, sf_dir).select("symbol", "date", "prev_close", "daily_change")


@register("volatility")
def q_volatility(spark, sf_dir):
    """3-bar sample standard deviation of close."""
    return _indicators(spark, sf_dir).select("symbol", "date", "volatility")


@register("intraday_indicators_hot")
def q_intraday_indicators_hot(spark, sf_dir):
    """W1-W3 on one-minute bars with a hot symbol holding a third of all rows.

    Windows run over (symbol, day) blocks with halo rows, so the hot symbol
    is spread over one task per day instead of one task overall.
    """
    bars = fx.bars_minute_hot(spark, sf_dir).select("symbol", "ts", "close")
    return rolling_indicators(bars, order="ts", block="day")


@register("minute_trends_hot")
def q_minute_trends_hot(spark, sf_dir):
    """M1 + M2 of minute series with a hot symbol, from merged moments; half of the days are appended later."""
    bars = fx.bars_minute_hot(spark, sf_dir)
    late = F.dayofmonth("ts") > 15
    path = scratch_path(spark, "moments")
    moments.merged(moments.block_moments(bars.where(~late), "ts", 60)).write.parquet(path)
    new = moments.block_moments(bars.where(late), "ts", 60)
    whole = moments.merged(spark.read.parquet(path).unionByName(new))
    return moments.fitted(whole).select(
        "symbol", F.col("n").cast("bigint").alias("n"), "slope", "r2", "linear_first", "linear_last",
        "quadratic_first", "quadratic_last")


@register("day_index")
def q_day_index(spark, sf_dir):
    """A3: whole days since each symbol's first bar."""
    return with_day_index(fx.bars_daily(spark, sf_dir).select("symbol", "date")).withColumn(
        "day_index", F.col("day_index").cast("long"))


# --- catalog -----------------------------------------------------------------
@register("symbols_sorted")
def q_symbols_sorted(spark, sf_dir):
    """Distinct symbols in order."""
    return catalog.symbols_sorted(fx.bars_daily(spark, sf_dir))


@register("symbols_first_n")
def q_symbols_first_n(spark, sf_dir):
    """U4: first page of 100 symbols."""
    return catalog.symbols_first_n(fx.bars_daily(spark, sf_dir), 100)


@register("symbols_page")
def q_symbols_page(spark, sf_dir):
    """U5 + U6: page (offset 20, limit 100) of the long-history catalog with its size."""
    return catalog.symbols_page(fx.bars_long(spark, sf_dir), offset=20, limit=100)


@register("symbols_deep_page")
def q_symbols_deep_page(spark, sf_dir):
    """U5 + U6: a page far into the long-history catalog, read through its directory of sorted ranges."""
    path = scratch_path(spark, "catalog")
    catalog.write_directory(fx.bars_long(spark, sf_dir), path, per_range=97)
    return catalog.directory_page(spark, path, offset=150, limit=40)


@register("symbol_search")
def q_symbol_search(spark, sf_dir):
    """case-insensitive substring search (query ' u1 ')."""
    return catalog.symbol_search(fx.bars_daily(spark, sf_dir), " u1 ")


@register("coverage")
def q_coverage(spark, sf_dir):
    """A1 + A2: per-symbol coverage of the one-minute bars."""
    return catalog.coverage(fx.bars_minute(spark, sf_dir), ts="ts")


@register("coverage_appended")
def q_coverage_appended(spark, sf_dir):
    """A1 + A2 from summaries kept while the bars land in four appends."""
    bars = fx.bars_minute(spark, sf_dir)
    kept = CoverageTable(spark, scratch_path(spark, "coverage"))
    part = F.pmod(F.xxhash64("symbol", "ts"), F.lit(4))
    for k in range(4):
        kept.append(bars.where(part == k))
    return kept.coverage()


@register("bars_for_symbol")
def q_bars_for_symbol(spark, sf_dir):
    """all bars of one symbol; the equality reaches the Parquet scan."""
    return sources.bars_for_symbol(fx.bars_daily(spark, sf_dir), "U7")


# --- dedup / retention -------------------------------------------------------
@register("dedup_keep_last")
def q_dedup_keep_last(spark, sf_dir):
    """Last arrival per (symbol, date) wins."""
    return dedup.keep_last(fx.arrivals(spark, sf_dir), ["symbol", "date"], "seq")


@register("retain_last_n")
def q_retain_last_n(spark, sf_dir):
    """U7 + U8 with the live cap of 5,000 bars per symbol."""
    return dedup.live_state(fx.arrivals(spark, sf_dir))


@register("retain_last_n_cap10")
def q_retain_last_n_cap10(spark, sf_dir):
    """U7 + U8 with a cap of 10 so eviction by arrival order is exercised."""
    return dedup.live_state(fx.arrivals(spark, sf_dir), cap=10)


# --- intraday ----------------------------------------------------------------
@register("trading_day")
def q_trading_day(spark, sf_dir):
    """trading day of every tick."""
    t = fx.ticks(spark, sf_dir)
    return t.select("symbol", "seq", "ts", trading_day(F.col("ts")).alias("trading_day"))


@register("trailing_month")
def q_trailing_month(spark, sf_dir):
    """the last month of each symbol's long daily history."""
    return intraday.trailing_period(fx.bars_long(spark, sf_dir), "date", months=1)


def _session_day(spark, sf_dir) -> Column:
    """Trading day of the latest tick: one column of the raw scan, not the bars built from it."""
    return intraday.latest_session_day(fx.ticks(spark, sf_dir))


def _quotes(spark, sf_dir) -> DataFrame:
    return intraday.quote_board(intraday.session_or_recent(
        fx.bars_minute(spark, sf_dir), _session_day(spark, sf_dir)))


@register("session_bars")
def q_session_bars(spark, sf_dir):
    """one-minute bars of the trading day of the latest bar."""
    bars = fx.bars_minute(spark, sf_dir)
    return intraday.session_bars(bars, _session_day(spark, sf_dir))


@register("session_or_recent")
def q_session_or_recent(spark, sf_dir):
    """Session bars, or the latest 100 bars for symbols without any."""
    bars = fx.bars_minute(spark, sf_dir)
    return intraday.session_or_recent(bars, _session_day(spark, sf_dir))


@register("candles")
def q_candles(spark, sf_dir):
    """Columnar candle trace per symbol over the live view."""
    bars = fx.bars_minute(spark, sf_dir)
    return intraday.candles(intraday.session_or_recent(bars, _session_day(spark, sf_dir)))


@register("quote_board")
def q_quote_board(spark, sf_dir):
    """Latest quote per symbol from its displayed view."""
    return _quotes(spark, sf_dir).drop(
        "price_text", "change_text", "range_text", "volume_text")


@register("quote_text")
def q_quote_text(spark, sf_dir):
    """Display strings of the quote."""
    return _quotes(spark, sf_dir).select(
        "symbol", "price_text", "change_text", "range_text", "volume_text")


# --- envelopes, cleansing, rejects --------------------------------------------
@register("envelope_decode")
def q_envelope_decode(spark, sf_dir):
    """F1 + F2: every message decoded and parsed with the fixed schema."""
    p = cleanse.parse_payload(cleanse.decode_envelope(fx.envelopes(spark, sf_dir)))
    return p.drop("json_data", "msg_ts", "partition")


@register("valid_bars")
def q_valid_bars(spark, sf_dir):
    """complete messages as typed bars (NULL and NaN fields rejected)."""
    return cleanse.valid_bars(fx.envelopes(spark, sf_dir))


@register("rejects")
def q_rejects(spark, sf_dir):
    """ST5: rejected messages with the first failed check."""
    return cleanse.rejects(fx.envelopes(spark, sf_dir)).drop("json_data")


@register("event_time_default")
def q_event_time_default(spark, sf_dir):
    """real-time path, a missing Date takes the message time."""
    return cleanse.event_time_default(fx.envelopes(spark, sf_dir))


@register("intraday_zero_fill")
def q_intraday_zero_fill(spark, sf_dir):
    """missing/NaN numerics of parsed messages become 0."""
    p = cleanse.parse_payload(cleanse.decode_envelope(fx.envelopes(spark, sf_dir)))
    return cleanse.zero_fill(p)


@register("ingest_metrics")
def q_ingest_metrics(spark, sf_dir):
    """Message counters."""
    return cleanse.ingest_metrics(fx.envelopes(spark, sf_dir))


@register("envelope_encode")
def q_envelope_encode(spark, sf_dir):
    """One-minute bars encoded as keyed JSON messages, then decoded again."""
    bars = fx.bars_minute(spark, sf_dir)
    env = cleanse.encode_envelope(bars).select(
        "key", "value", F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"),
        F.lit(None).cast("timestamp_ntz").alias("timestamp"))
    return cleanse.valid_bars(env).drop("seq")


@register("clean_csv_bars")
def q_clean_csv_bars(spark, sf_dir):
    """F4 + F3: text bar rows (bad symbol, text numbers, blanks) cleansed in place."""
    return cleanse.clean_csv_bars(fx.bar_csv_rows(spark, sf_dir))


# --- files ---------------------------------------------------------------------
@register("scan_bars_csv")
def q_scan_bars_csv(spark, sf_dir):
    """S1 + F4: landed bar CSV with bad rows, cleansed; plain and packed files, sub-folders, two column orders."""
    path = scratch_path(spark, "bar_csv")
    rows = fx.bar_csv_rows(spark, sf_dir)
    part = F.crc32(F.col("Date").cast("binary")) % 3
    sources.write_bar_csv(rows.where(part == 0), f"{path}/landed")
    rows.where(part == 1).write.option("header", True).option("compression", "gzip").csv(f"{path}/packed/2024")
    # the same columns in another order: bound by name
    (rows.where((part == 2) | part.isNull()).select("Volume", "Close", "Low", "High", "Open", "Symbol", "Date")
     .write.option("header", True).csv(f"{path}/reordered"))
    return cleanse.clean_csv_bars(sources.read_bar_csv(spark, path))


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    """S9 then S1: bars written as CSV with header and read back."""
    path = scratch_path(spark, "csv_roundtrip")
    b = fx.bars_daily(spark, sf_dir)
    rows = b.select(F.date_format("date", "yyyy-MM-dd").alias("Date"), F.col("symbol").alias("Symbol"),
                    *[F.col(c).cast("string").alias(c.capitalize())
                      for c in ("open", "high", "low", "close", "volume")])
    sources.write_bar_csv(rows, path)
    return cleanse.clean_csv_bars(sources.read_bar_csv(spark, path))


@register("union_symbol_files")
def q_union_symbol_files(spark, sf_dir):
    """F8 + U1: one directory per symbol, read in one scan, symbol from the path."""
    path = scratch_path(spark, "symbol_files")
    rows = fx.bar_csv_rows(spark, sf_dir).where(F.col("Symbol").isNotNull())
    odd = F.crc32(F.col("Date").cast("binary")) % 2 == 1
    sources.write_symbol_files(rows.where(~odd), path)
    # packed, deeper, and in another column order
    sources.write_symbol_files(rows.where(odd), f"{path}/more/packed",
                               ["Volume", "Close", "Symbol", "Low", "High", "Open", "Date"], packed=True)
    return cleanse.clean_csv_bars(sources.read_symbol_dirs(spark, path))


@register("symbol_universe")
def q_symbol_universe(spark, sf_dir):
    """Symbol list CSV with padding, blanks and repeats; distinct clean symbols."""
    path = scratch_path(spark, "symbol_list")
    b = fx.bars_daily(spark, sf_dir)
    day = F.dayofmonth("date")
    listed = (F.when(day % 5 == 0, F.concat(F.lit("  "), F.col("symbol"), F.lit(" ")))
              .when(day % 7 == 0, F.lit(" "))
              .otherwise(F.col("symbol")))
    sources.write_symbol_list(b.select(listed.alias("symbol")), path)
    return sources.read_symbol_list(spark, path)


@register("screener_symbols")
def q_screener_symbols(spark, sf_dir):
    """S3: symbols landed as screener pages of ~25 rows, extracted again."""
    path = scratch_path(spark, "screener")
    sources.write_screener_pages(catalog.distinct_symbols(fx.bars_daily(spark, sf_dir)), path)
    return sources.read_screener(spark, path)


# --- streaming -----------------------------------------------------------------
STREAM_CYCLES = 5  # producer cycles of the ordered replays (one micro-batch each)
INGEST_ROWS_PER_FILE = 10000  # unordered ingest input files
# Rate limit of the ingest stream: at most this many new files per micro-batch
# (with 128 MB files about 32 GB per batch -- bounded batches and recovery).
INGEST_FILES_PER_TRIGGER = 256


# Micro-batches of the first run and of the replay of what it was sent.
REPLAYED_BATCHES, REPLAY_BATCHES = 12, 4


def _ingest_run(spark, sf_dir, batches: int | None = None, files: int | None = None):
    src, sink, ckpt = (scratch_path(spark, n) for n in ("stream_src", "stream_sink", "stream_ckpt"))
    env = fx.envelopes(spark, sf_dir)
    ingest.land_envelopes(env.repartition(files) if files else env, src, INGEST_ROWS_PER_FILE)
    per_trigger = ingest.share_of_files(spark, src, batches) if batches else INGEST_FILES_PER_TRIGGER
    q = ingest.start_ingest(ingest.file_stream(spark, src, per_trigger), sink, ckpt)
    ingest.run_to_end(q)
    return src, sink


@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """ST1: envelopes streamed through decode/parse/validate into the bar table."""
    _, sink = _ingest_run(spark, sf_dir)
    return ingest.read_sink(spark, sink, "bars").drop("partition")


@register("stream_rejects")
def q_stream_rejects(spark, sf_dir):
    """ST5 on the stream: the reject table written next to the bars."""
    _, sink = _ingest_run(spark, sf_dir)
    return ingest.read_sink(spark, sink, "rejects").drop("partition", "json_data")


@register("stream_idempotent")
def q_stream_idempotent(spark, sf_dir):
    """ST2: the stream replayed from scratch into the same sink, in other batches -- no duplicates."""
    src, sink = _ingest_run(spark, sf_dir, batches=REPLAYED_BATCHES, files=4)
    per_trigger = ingest.share_of_files(spark, src, REPLAY_BATCHES, at_least=3)
    replay = ingest.start_ingest(ingest.file_stream(spark, src, per_trigger), sink,
                                 scratch_path(spark, "stream_ckpt_replay"))
    ingest.run_to_end(replay)
    return ingest.read_sink(spark, sink, "bars").drop("partition")


@register("stream_resume")
def q_stream_resume(spark, sf_dir):
    """Stop after half the cycles, then restart from the checkpoint for the rest."""
    src, sink, ckpt = (scratch_path(spark, n) for n in ("resume_src", "resume_sink", "resume_ckpt"))
    env = fx.envelopes(spark, sf_dir)

    def start():
        return ingest.start_ingest(ingest.file_stream(spark, src, 1000), sink, ckpt)

    half = STREAM_CYCLES // 2
    size = ingest.replay_in_cycles(env, src, "offset", STREAM_CYCLES, start, 0, half - 1)
    ingest.replay_in_cycles(env, src, "offset", STREAM_CYCLES, start, half, None, size)
    return ingest.read_sink(spark, sink, "bars").drop("partition")


def _cycles_run(spark, sf_dir):
    """Every cycle lands four files and the stream takes three at a time, so cycles and micro-batches never coincide."""
    src, sink, ckpt = (scratch_path(spark, n) for n in ("snap_src", "snap_sink", "snap_ckpt"))
    ingest.replay_in_cycles(
        fx.envelopes(spark, sf_dir), src, "offset", STREAM_CYCLES,
        lambda: cycles.start_snapshot_delta(ingest.file_stream(spark, src, 3), sink, ckpt), files=4)
    return sink


@register("snapshot_then_delta")
def q_snapshot_then_delta(spark, sf_dir):
    """ST4: first cycle publishes the session day's bars, later cycles each symbol's last bar."""
    return cycles.history_view(spark, _cycles_run(spark, sf_dir)).drop("partition")


@register("snapshot_current")
def q_snapshot_current(spark, sf_dir):
    """ST4 as shown after the last cycle: the snapshot and one delta per symbol, past cycles not read."""
    return cycles.current_view(spark, _cycles_run(spark, sf_dir)).drop("partition")


@register("stream_latest_state")
def q_stream_latest_state(spark, sf_dir):
    """ST3: keyed live state (keep-last, cap 10 dates per symbol) vs. its batch twin.

    Halfway the consumer loses its checkpoint and goes on with a new one,
    which sends it everything landed so far once more.
    """
    src, sink, first, second = (scratch_path(spark, n) for n in ("state_src", "state_sink", "state_ckpt", "state_ckpt2"))
    arr = fx.arrivals(spark, sf_dir)

    def start(checkpoint):
        return state.start_live_state(spark.readStream.schema(arr.schema).parquet(src), sink, checkpoint, cap=10)

    half = STREAM_CYCLES // 2
    size = ingest.replay_in_cycles(arr, src, "seq", STREAM_CYCLES, lambda: start(first), 0, half - 1)
    ingest.replay_in_cycles(arr, src, "seq", STREAM_CYCLES, lambda: start(second), half, None, size)
    return state.live_view(spark, sink, cap=10)


@register("indicator_card_text")
def q_indicator_card_text(spark, sf_dir):
    """Indicator card strings (Python-style rounding of the binary value)."""
    return datasets.indicator_card_text(fx.bars_daily(spark, sf_dir))


@register("metrics_text")
def q_metrics_text(spark, sf_dir):
    """Model metric strings rounded to 4 places."""
    return datasets.metrics_text(fx.bars_daily(spark, sf_dir))


@register("symbol_count")
def q_symbol_count(spark, sf_dir):
    """Number of distinct symbols in the long-history catalog."""
    return catalog.symbol_count(fx.bars_long(spark, sf_dir))
