"""Per-symbol pages equal the all-symbol datasets filtered to the symbol."""
from pyspark.sql import functions as F

from barlake.operators import intraday, models
from barlake.plans import datasets, pages
from barlake.sources import fixtures as fx
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stock_and_prediction_pages(spark):
    bars = fx.bars_daily(spark, SF_SMALL)
    sym = bars.select("symbol").orderBy("symbol").first()[0]
    page = pages.stock_page(bars, sym)
    assert _rows(page["series"]) == _rows(datasets.analysis_series(bars).where(f"symbol = '{sym}'"))
    assert page["card"].count() == 1
    pred = pages.predictions_page(bars, sym)
    assert pred["lines"].where("series <> 'history'").count() == 3 * models.HORIZON_DAYS
    assert pred["metrics"].count() == 1


def test_unknown_symbol_pages_are_empty(spark):
    bars = fx.bars_daily(spark, SF_SMALL)
    assert pages.historical_page(bars, "NOPE").count() == 0
    assert pages.stock_page(bars, "NOPE")["card"].count() == 0
    live = pages.live_page(fx.bars_minute(spark, SF_SMALL), "NOPE", F.to_date(F.lit("2024-01-30")))
    assert live["candles"].count() == 0 and live["quote"].count() == 0


def test_live_page_is_the_dataset_of_the_symbol(spark):
    """For a symbol with bars on the session day, and for one without."""
    minute = fx.bars_minute(spark, SF_SMALL)
    day = intraday.latest_session_day(minute)
    view = intraday.session_or_recent(minute, day)
    candles, quotes = intraday.candles(view), intraday.quote_board(view)
    flags = {r["symbol"]: r["f"] for r in view.groupBy("symbol").agg(F.max("in_session").alias("f")).collect()}
    fresh = sorted(s for s, f in flags.items() if f)[:2]
    stale = sorted(s for s, f in flags.items() if not f)[:2]
    assert fresh and stale
    for sym in fresh + stale:
        page = pages.live_page(minute, sym, day)
        assert _rows(page["candles"]) == _rows(candles.where(F.col("symbol") == sym))
        assert _rows(page["quote"]) == _rows(quotes.where(F.col("symbol") == sym))


def test_quote_does_not_leave_the_view(spark):
    """One bar in the session: its previous close is its own, whatever came the day before."""
    rows = [("A", "2024-01-29 10:00:00", 5.0), ("A", "2024-01-30 10:00:00", 9.0)]
    bars = spark.createDataFrame([(s, t, *([c] * 4), 1.0) for s, t, c in rows],
                                 "symbol string, ts string, open double, high double, low double, close double, volume double")
    bars = bars.withColumn("ts", F.to_timestamp_ntz("ts"))
    view = intraday.session_or_recent(bars, F.to_date(F.lit("2024-01-30")))
    q = intraday.quote_board(view).first()
    assert (q["price"], q["prev_close"], q["change"], q["is_up"]) == (9.0, 9.0, 0.0, True)
