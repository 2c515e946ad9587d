"""Published datasets composed from operators.

Each dataset answers one of the reference's per-symbol pages, but for every
symbol in one distributed job.  Inputs are bar relations that are already
unique on (symbol, date) -- run :func:`barlake.operators.dedup.keep_last`
first on raw arrivals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.operators import models
from barlake.operators.dedup import latest_row
from barlake.operators.indicators import with_indicators


def analysis_series(bars: DataFrame) -> DataFrame:
    """Date, close, linear trend value, 3-bar MA, daily change %, 3-bar volatility, MSE.

    Daily bars, unique on (symbol, date), at most one row per calendar day:
    fit and indicators share one shuffle on the symbol and need no join.
    """
    fitted = models.with_linear_fit(bars.select("symbol", "date", "close"))
    ind = with_indicators(fitted, Window.partitionBy("symbol").orderBy("date"))
    x = F.datediff("date", "anchor")
    return ind.select(
        "symbol", "date", "close",
        x.cast("long").alias("day_index"),
        (F.col("intercept") + F.col("slope") * x).alias("predicted_close"),
        "moving_average", "daily_change", "volatility", "mse")


def latest_indicators(bars: DataFrame) -> DataFrame:
    """The indicator card -- last MA, change and volatility plus MSE.

    ``is_positive`` uses ``daily_change > 0`` (zero shows as negative), as
    the card does.
    """
    last = latest_row(analysis_series(bars).drop("day_index"), "date")
    return last.select(
        "symbol", "date", "close", "moving_average", "daily_change", "volatility", "mse",
        (F.col("daily_change") > 0).alias("is_positive"))


def history_series(bars: DataFrame, symbol: str | None = None) -> DataFrame:
    """D3: open/high/low/close by date, optionally for one symbol (pushed to the scan)."""
    b = bars if symbol is None else bars.where(F.col("symbol") == F.lit(symbol))
    return b.select("symbol", "date", "open", "high", "low", "close").orderBy("symbol", "date")


def prediction_series(bars: DataFrame, days: int = models.HORIZON_DAYS) -> DataFrame:
    """History closes and the three forecast lines in one long table."""
    hist = bars.select("symbol", F.lit("history").alias("series"), "date",
                       F.col("close").alias("price"))
    fc = models.forecasts(bars, days).select(
        "symbol", F.col("model").alias("series"), "date", F.col("prediction").alias("price"))
    return hist.unionByName(fc)


def indicator_card_text(bars: DataFrame) -> DataFrame:
    """The indicator card as displayed -- MSE, $MA, signed change %, volatility."""
    from barlake.functions.expressions import card_change_text, rounded_text
    card = latest_indicators(bars)
    return card.select(
        "symbol",
        rounded_text("mse", 2).alias("mse_text"),
        F.concat(F.lit("$"), rounded_text("moving_average", 2)).alias("moving_average_text"),
        card_change_text("daily_change").alias("daily_change_text"),
        rounded_text("volatility", 2).alias("volatility_text"))


def metrics_text(bars: DataFrame) -> DataFrame:
    """The model comparison table as displayed (4 decimals)."""
    from barlake.functions.expressions import rounded_text
    m = models.model_metrics(bars)
    cols = ["linear_mse", "poly_mse", "rf_mse", "linear_r2", "poly_r2", "rf_r2"]
    return m.select("symbol", *[rounded_text(c, 4).alias(f"{c}_text") for c in cols])
