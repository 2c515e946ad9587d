"""Plan-shape checks: pushdown, no Python in batch analytics, one exchange family."""
from barlake.plans import datasets
from barlake.plans.queries import REGISTRY
from barlake.session import scratch_path
from barlake.sources import fixtures as fx
from barlake.sources.readers import bars_for_symbol
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_symbol_filter_reaches_parquet_scan(spark):
    from barlake.sources.readers import write_history_table
    path = scratch_path(spark, "bars_table")
    write_history_table(fx.bars_daily(spark, SF_SMALL), path, rows_per_file=200)
    bars = spark.read.parquet(path)
    assert len(bars.inputFiles()) > 1
    assert bars_for_symbol(bars, "U7").count() == fx.bars_daily(spark, SF_SMALL).where("symbol = 'U7'").count()
    plan = _plan(bars_for_symbol(bars, "U7"))
    assert "PushedFilters: [IsNotNull(symbol), EqualTo(symbol,U7)]" in plan
    plan = _plan(datasets.analysis_series(bars).where("symbol = 'U7'"))
    assert "EqualTo(symbol,U7)" in plan


def test_batch_analytics_stay_in_the_jvm(spark):
    for name in ("analysis_series", "forecasts", "model_metrics", "dedup_keep_last", "quote_board"):
        plan = _plan(REGISTRY[name](spark, SF_SMALL))
        assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan, name
        assert "FlatMapGroupsInPandas" not in plan, name


def test_column_pruning_on_scan(spark):
    plan = _plan(REGISTRY["analysis_series"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_hot_symbol_windows_are_split_by_block(spark):
    import re
    plan = _plan(REGISTRY["intraday_indicators_hot"](spark, SF_SMALL))
    specs = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", plan)
    assert specs, plan
    # every window over the bar rows is partitioned by (symbol, block); the
    # only symbol-wide windows run over the small per-block edge tables
    assert any("_blk" in s for s in specs)
    hot = fx.bars_minute_hot(spark, SF_SMALL)
    per_day = hot.where("symbol = 'HOT'").groupBy("symbol", hot.ts.cast("date")).count()
    biggest = per_day.agg({"count": "max"}).first()[0]
    total = hot.where("symbol = 'HOT'").count()
    assert biggest < total / 10  # one day block holds a small share of the hot symbol


def test_event_bars_use_hash_aggregation(spark):
    for adapter in (fx.bars_daily, fx.bars_minute, fx.bars_minute_hot):
        plan = _plan(adapter(spark, SF_SMALL))
        assert "SortAggregate" not in plan, adapter.__name__
        assert "HashAggregate" in plan, adapter.__name__


def test_ts_tie_order_key_sorts_like_ts_then_tie(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from barlake.functions.expressions import ts_tie_order_key
    ts = [dt.datetime(1900, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999),
          dt.datetime(1970, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 7, 179575), dt.datetime(9999, 12, 31), None]
    ids = [-(2 ** 63), -1, 0, 1, 2 ** 63 - 1, None]
    rows = [(t, i) for t in ts for i in ids]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, id bigint")
    for nulls_first in (False, True):
        got = [(r.ts, r.id) for r in df.orderBy(ts_tie_order_key("ts", "id", nulls_first)).collect()]
        want = sorted(rows, key=lambda r: ((r[0] is None) != nulls_first, r[0] or dt.datetime.min,
                                           (r[1] is None) != nulls_first, r[1] or 0))
        assert got == want, nulls_first
    # nulls-first matches Spark's own struct ordering
    by_struct = [(r.ts, r.id) for r in df.orderBy(F.struct("ts", "id")).collect()]
    assert by_struct == [(r.ts, r.id) for r in df.orderBy(ts_tie_order_key("ts", "id", True)).collect()]


def test_keep_last_and_quote_aggregates_are_hash_based(spark):
    for name in ("quote_board", "dedup_keep_last"):
        plan = _plan(REGISTRY[name](spark, SF_SMALL))
        assert "SortAggregate" not in plan, name


def test_daily_series_take_one_shuffle(spark):
    """One exchange of the bar adapter and one on the symbol; one scan; no join."""
    import re
    for name in ("analysis_series", "latest_indicators", "linear_trend", "model_metrics", "bagged_tree_trend",
                 "forecasts"):
        plan = _plan(REGISTRY[name](spark, SF_SMALL))
        assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 2, name
        assert plan.count("FileScan") == 1 and "Join" not in plan, name


def test_coverage_copies_no_rows(spark):
    assert "Expand" not in _plan(REGISTRY["coverage"](spark, SF_SMALL))


def test_retention_is_ranked_in_parts_first(spark):
    from barlake.operators.dedup import retain_last_n
    df = spark.range(20000).selectExpr("'HOT' AS symbol", "id AS seq")
    plan = _plan(retain_last_n(df, cap=5000))
    assert "_salt" in plan and retain_last_n(df, cap=5000).selectExpr("min(seq)", "count(*)").first() == (15000, 5000)


def test_session_views_take_one_scan_and_one_ranking(spark):
    import re
    for name in ("session_or_recent", "candles", "quote_board"):
        df = REGISTRY[name](spark, SF_SMALL)
        plan = _plan(df).split("+- == Initial Plan ==")[-1]
        assert len(re.findall(r"FileScan|Scan parquet", plan)) <= 1, name
        assert len(re.findall(r"Exchange ", plan)) <= 4, name
        assert "WindowGroupLimit" in plan and "Join" not in plan, name
