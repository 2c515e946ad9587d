"""Intraday views: trailing slices, trading session, candles, quotes.

(F10, F12, U10, A4, W4-W7.)  The clock is an explicit session day -- from an
``as_of`` value via :func:`session_day` or from the data via
:func:`latest_session_day` (one global ``max``, evaluated once) --
instead of the machine's wall clock, so replays and tests agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.expressions import (dollar_text, magnitude_text, pct_change,
                                           signed_change_text, trading_day)

RECENT_FALLBACK = 100  # fixed value: bars shown when the session day is empty
MINUTES_PER_DAY = 1440  # grain of one-minute bars: most bars of a symbol on one day
SESSION_SALTS = 32


def latest_session_day(bars: DataFrame, ts: str = "ts") -> Column:
    """Trading day of the latest bar time in the table, as a DATE literal.

    Evaluated once up front: one global ``max`` (map-side partial
    aggregation, one value per task to the final step).  As a scalar
    subquery it would be re-executed in every plan branch that uses the
    session flag; as a literal it folds into the plan and can prune
    partitions.  An empty table gives a NULL day (and empty views).
    """
    day = bars.agg(trading_day(F.max(ts)).alias("day")).first()["day"]
    return F.lit(day).cast("date")


def session_day(as_of: Column) -> Column:
    """Trading day of an explicit clock value (a literal folds to a constant)."""
    return trading_day(as_of)


def trailing_period(bars: DataFrame, order: str = "date", months: int = 1,
                    key: str = "symbol") -> DataFrame:
    """bars in the last ``months`` months of each symbol's own history."""
    last = bars.groupBy(key).agg(F.max(order).alias("_last"))
    cutoff = F.add_months(F.to_date("_last"), -months)
    return bars.join(last, key).where(F.to_date(F.col(order)) > cutoff).drop("_last")


def session_bars(bars: DataFrame, day: Column, ts: str = "ts") -> DataFrame:
    """bars whose calendar date is the session ``day``, ascending."""
    return bars.where(F.to_date(F.col(ts)) == day).orderBy("symbol", ts)


def session_or_recent(bars: DataFrame, day: Column, ts: str = "ts",
                      n: int = RECENT_FALLBACK, key: str = "symbol", per_day: int = MINUTES_PER_DAY,
                      salts: int = SESSION_SALTS) -> DataFrame:
    """The session day's bars ascending, else the latest ``n`` bars descending.

    ``pos`` is the display position (0-based); ``in_session`` tells which of
    the two applied.  One ranking serves both: a symbol's bars with the
    session's first, the latest first.  It is taken in two steps, by (symbol,
    salt) and then by symbol.  The salt is dealt by time slot, so a salt holds
    at most ``per_day / salts`` bars of one day and needs no more than that or
    ``n`` bars: a short top-k that Spark also takes before the shuffle, however
    long or hot the symbol.  ``per_day`` is the bars' grain; a symbol with more
    bars on the session day is an error, never a part of them.
    """
    dealt = -(-per_day // salts)
    limit = max(n, dealt) + 1
    clock = F.col(ts)
    second = (F.hour(clock) * 3600 + F.minute(clock) * 60 + F.second(clock)).cast("bigint")
    slot = F.floor(second * F.lit(per_day) / 86400)
    newest = [F.col("_in").desc(), clock.desc()]
    by_salt = Window.partitionBy(key, "_salt").orderBy(*newest)
    by_key = Window.partitionBy(key).orderBy(*newest)
    too_many = F.raise_error(F.lit(f"more than {per_day} bars of a symbol on one day"))
    top = (bars.withColumn("_in", F.coalesce(F.to_date(clock) == day, F.lit(False)))
           .withColumn("_salt", F.coalesce(F.pmod(slot, F.lit(salts)), F.lit(0)))
           .withColumn("_rs", F.row_number().over(by_salt)).where(F.col("_rs") <= limit)
           .where(F.when(F.col("_in") & (F.col("_rs") > dealt), too_many.cast("boolean")).otherwise(True)))
    ranked = (top.withColumn("_rn", F.row_number().over(by_key))
              .withColumn("_n", F.sum(F.col("_in").cast("int")).over(Window.partitionBy(key))))
    in_session = F.col("_n") > 0
    return (ranked.where(F.when(in_session, F.col("_in")).otherwise(F.col("_rn") <= n))
            .select(*bars.columns,
                    F.when(in_session, F.col("_n") - F.col("_rn")).otherwise(F.col("_rn") - 1).cast("int").alias("pos"),
                    in_session.alias("in_session")))


def candles(view: DataFrame, ts: str = "ts", key: str = "symbol") -> DataFrame:
    """A4: one columnar trace per symbol: parallel arrays in display order.

    The view holds at most a session day or ``RECENT_FALLBACK`` bars per
    symbol, so the arrays are bounded.  ``x`` is ``yyyy-MM-dd HH:mm:ss``.
    """
    pts = F.array_sort(F.collect_list(F.struct(
        F.col("pos"), F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("x"),
        "open", "high", "low", "close", "volume")))
    t = view.groupBy(key).agg(pts.alias("_p"))
    return t.select(
        key,
        F.transform("_p", lambda p: p["x"]).alias("x"),
        F.transform("_p", lambda p: p["open"]).alias("open"),
        F.transform("_p", lambda p: p["high"]).alias("high"),
        F.transform("_p", lambda p: p["low"]).alias("low"),
        F.transform("_p", lambda p: p["close"]).alias("close"),
        F.transform("_p", lambda p: p["volume"]).alias("volume"),
        F.lit("candlestick").alias("type"),
        F.col(key).alias("name"))


def quote_board(view: DataFrame, ts: str = "ts", key: str = "symbol") -> DataFrame:
    """Latest price, previous close, change, range, volume and text.

    ``view`` is the displayed view (:func:`session_or_recent`): the previous
    close never comes from outside it.  Computed from its latest bar and the
    one before it (the two newest rows per symbol via a ``row_number() <= 2``
    group limit).  A one-bar view uses its own close as previous close.
    ``is_up`` uses ``change >= 0`` as the quote does.
    """
    w = Window.partitionBy(key).orderBy(F.col(ts).desc())
    two = view.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= 2)
    # ``_r`` is unique per key, so per-column ``min_by`` picks one row and
    # keeps every buffer fixed-width (hash aggregation)
    q = two.groupBy(key).agg(
        *[F.min_by(c, F.col("_r")).alias(f"last_{c}") for c in (ts, "open", "high", "low", "close", "volume")],
        F.max(F.when(F.col("_r") == 2, F.col("close"))).alias("_prev"))
    last_close = F.col("last_close")
    prev = F.coalesce(F.col("_prev"), last_close)
    out = q.select(
        key,
        F.col(f"last_{ts}").alias("as_of"),
        last_close.alias("price"),
        prev.alias("prev_close"),
        (last_close - prev).alias("change"),
        pct_change(last_close, prev).alias("change_pct"),
        F.col("last_open").alias("open"),
        F.col("last_low").alias("day_low"),
        F.col("last_high").alias("day_high"),
        F.col("last_volume").alias("volume"),
    )
    return out.select(
        "*",
        (F.col("change") >= 0).alias("is_up"),
        dollar_text("price").alias("price_text"),
        signed_change_text("change", "change_pct").alias("change_text"),
        F.concat(dollar_text("day_low"), F.lit(" - "), dollar_text("day_high")).alias("range_text"),
        magnitude_text("volume").alias("volume_text"),
    )
