"""Per-symbol views, as the reference serves them one request at a time.

Each view is the all-symbol dataset with a bound symbol predicate; Catalyst
pushes the predicate through the windows and aggregates down to the scan,
so on a stored bar table only that symbol's data is read.  An unknown
symbol yields empty results, not an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.operators import intraday, models
from barlake.plans import datasets


def _only(df: DataFrame, symbol: str) -> DataFrame:
    return df.where(F.col("symbol") == F.lit(symbol))


def stock_page(bars: DataFrame, symbol: str) -> dict[str, DataFrame]:
    """Analysis page: the series (D1) and the indicator card."""
    return {"series": _only(datasets.analysis_series(bars), symbol).orderBy("date"),
            "card": _only(datasets.latest_indicators(bars), symbol)}


def predictions_page(bars: DataFrame, symbol: str) -> dict[str, DataFrame]:
    """Forecast page: history plus three forecast lines (D4) and the metric table (M6)."""
    return {"lines": _only(datasets.prediction_series(bars), symbol).orderBy("series", "date"),
            "metrics": models.model_metrics(_only(bars, symbol))}


def historical_page(bars: DataFrame, symbol: str) -> DataFrame:
    """History page: open/high/low/close by date (D3)."""
    return datasets.history_series(bars, symbol)


def live_page(minute_bars: DataFrame, symbol: str, day: Column) -> dict[str, DataFrame]:
    """Live page (D5): candle trace and quote of one symbol for a session day.

    ``day`` is the session day of the whole table, not of the symbol, so the
    page shows the rows that the all-symbol datasets hold for it.
    """
    view = intraday.session_or_recent(_only(minute_bars, symbol), day)
    return {"candles": intraday.candles(view), "quote": intraday.quote_board(view)}
