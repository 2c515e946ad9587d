"""Rolling indicators over a symbol's bar series.

Windows are row frames (the "3-day" average is 3 bars, not 3 calendar
days) evaluated with :func:`barlake.operators.windows.blocked_window`, so a
symbol's series is split into time blocks and no task ever holds a whole
symbol.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.expressions import day_index, full_window, pct_change
from barlake.operators.windows import blocked_window, time_block

ROLLING_ROWS = 3  # fixed value: 3-bar moving average / volatility


def with_indicators(df: DataFrame, w: Window) -> DataFrame:
    """The indicator columns over an ordered window of a symbol's bars."""
    w3 = w.rowsBetween(-(ROLLING_ROWS - 1), 0)
    prev = F.lag("close", 1).over(w)
    return df.select(
        "*",
        prev.alias("prev_close"),
        full_window(F.avg("close").over(w3), "close", w3, ROLLING_ROWS).alias("moving_average"),
        pct_change("close", prev).alias("daily_change"),
        full_window(F.stddev_samp("close").over(w3), "close", w3, ROLLING_ROWS).alias("volatility"),
    )


def rolling_indicators(bars: DataFrame, order: str = "date", block: str = "year",
                       key: str = "symbol") -> DataFrame:
    """Adds ``prev_close``, ``moving_average``, ``daily_change`` and ``volatility``.

    * moving_average: mean of the last 3 closes, NULL until 3 bars exist (W1)
    * daily_change: percent change of close vs the previous bar, NULL on
      the first bar and when the previous close is 0 (W2)
    * volatility: sample standard deviation of the last 3 closes (W3)
    """
    return blocked_window(bars, key, order, time_block(order, block),
                          before=ROLLING_ROWS - 1, after=0, compute=with_indicators)


def series_anchor(bars: DataFrame, order: str = "date", key: str = "symbol") -> DataFrame:
    """First date of each symbol (one row per symbol; partial aggregation)."""
    return bars.groupBy(key).agg(F.min(order).alias("anchor"))


def with_day_index(bars: DataFrame, order: str = "date", key: str = "symbol") -> DataFrame:
    """A3: whole days since the symbol's first bar.

    The anchor table has one row per symbol; AQE broadcasts it when its
    measured size is under the broadcast threshold and falls back to a
    (skew-split) sort-merge join otherwise.
    """
    anchors = series_anchor(bars, order, key)
    return (bars.join(anchors, key)
            .withColumn("day_index", day_index(order, "anchor").cast("int"))
            .drop("anchor"))
