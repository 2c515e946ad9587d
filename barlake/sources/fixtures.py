"""Adapters that reshape the driver's tables into bar relations.

All adapters are aggregations or projections over the whole input table,
so the work grows with the data.  Arrival order is explicit (``seq``); the
first/last bar prices use ``min_by``/``max_by`` over a full tie-break
(a flat decimal key for events, a struct for the five-column lineitem
order), which Spark evaluates with partial (map-side) aggregation, so a
hot symbol never lands whole in one task.

Fault injection for envelopes and CSV rows (fixed values, chosen by the
remainder of a row id modulo 50):

    0 -> value is not JSON
    1 -> Open missing
    2 -> Symbol missing
    3 -> Volume sent as text
    4 -> Close is NaN
    5 -> Date missing
    6 -> Date is unparseable text
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.expressions import trunc_minute_ntz, ts_tie_order_key

FAULT_MODULUS = 50
FAULT_NOT_JSON, FAULT_NO_OPEN, FAULT_NO_SYMBOL, FAULT_TEXT_VOLUME, FAULT_NAN_CLOSE, \
    FAULT_NO_DATE, FAULT_BAD_DATE = range(7)
BAD_DATE_TEXT = "not-a-date"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _user_symbol(col: str = "user_id") -> Column:
    return F.concat(F.lit("U"), F.col(col).cast("string"))


def _first_last_bar(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """OHLC of ``price`` per key; open/close by ``order``; volume summed."""
    return df.groupBy(*keys).agg(
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum("vol").cast("double").alias("volume"),
    )


def bars_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars from ``events``: symbol U<user_id>, one bar per calendar day."""
    ev = table(spark, sf_dir, "events").select(
        _user_symbol().alias("symbol"), F.to_date("ts").alias("date"),
        "ts", "event_id", F.col("value").alias("price"), F.lit(1).alias("vol"))
    return _first_last_bar(ev, ["symbol", "date"], ts_tie_order_key("ts", "event_id"))


def bars_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-minute bars from ``events`` with the bar time in ``ts``."""
    ev = table(spark, sf_dir, "events").select(
        _user_symbol().alias("symbol"), trunc_minute_ntz("ts").alias("bar_ts"),
        "ts", "event_id", F.col("value").alias("price"), F.lit(1).alias("vol"))
    return (_first_last_bar(ev, ["symbol", "bar_ts"], ts_tie_order_key("ts", "event_id"))
            .withColumnRenamed("bar_ts", "ts"))


HOT_SYMBOL = "HOT"


def bars_minute_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-minute bars where a third of all users trade as one symbol ``HOT``.

    The skew workload: ``HOT`` holds about a third of all rows, so any
    operator that puts a whole symbol into one task shows up here.
    """
    sym = F.when(F.pmod(F.col("user_id"), F.lit(3)) == 0, F.lit(HOT_SYMBOL)).otherwise(_user_symbol())
    ev = table(spark, sf_dir, "events").select(
        sym.alias("symbol"), trunc_minute_ntz("ts").alias("bar_ts"),
        "ts", "event_id", F.col("value").alias("price"), F.lit(1).alias("vol"))
    return (_first_last_bar(ev, ["symbol", "bar_ts"], ts_tie_order_key("ts", "event_id"))
            .withColumnRenamed("bar_ts", "ts"))


def bars_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long daily history from ``lineitem``: symbol P<partkey>, unit price."""
    li = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("symbol"),
        F.to_date("l_shipdate").alias("date"),
        F.try_divide("l_extendedprice", "l_quantity").alias("price"),
        F.col("l_quantity").alias("vol"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity")
    order = F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity")
    return _first_last_bar(li, ["symbol", "date"], order)


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one price tick: symbol, ts, seq (arrival order), price, size."""
    return table(spark, sf_dir, "events").select(
        _user_symbol().alias("symbol"), "ts", F.col("event_id").alias("seq"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("size"))


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks re-sent as whole daily bars keyed by (symbol, date): many per key."""
    t = ticks(spark, sf_dir)
    return t.select(
        "symbol", F.to_date("ts").alias("date"), "seq",
        F.col("price").alias("open"), F.col("price").alias("high"),
        F.col("price").alias("low"), F.col("price").alias("close"),
        F.col("size").alias("volume"))


def fault_code(id_col: Column) -> Column:
    return F.pmod(id_col, F.lit(FAULT_MODULUS))


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message envelopes (key, value, partition, offset, timestamp) with faults.

    The payload is the tick as an intraday bar (Date as ``yyyy-MM-dd
    HH:mm:ss``); ``offset`` is the arrival order and ``timestamp`` the
    message time.
    """
    t = ticks(spark, sf_dir)
    f = fault_code(F.col("seq"))
    date_txt = (F.when(f == FAULT_NO_DATE, F.lit(None).cast("string"))
                .when(f == FAULT_BAD_DATE, F.lit(BAD_DATE_TEXT))
                .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    fields = [
        F.when(f != FAULT_NO_SYMBOL, F.col("symbol")).alias("Symbol"),
        date_txt.alias("Date"),
        F.when(f != FAULT_NO_OPEN, F.col("price")).alias("Open"),
        F.col("price").alias("High"),
        F.col("price").alias("Low"),
        F.when(f == FAULT_NAN_CLOSE, F.lit(float("nan"))).otherwise(F.col("price")).alias("Close"),
    ]
    normal = F.to_json(F.struct(*fields, F.col("size").alias("Volume")))
    text_volume = F.to_json(F.struct(*fields, F.col("size").cast("string").alias("Volume")))
    value = (F.when(f == FAULT_NOT_JSON, F.concat(F.lit("garbage-"), F.col("seq").cast("string")))
             .when(f == FAULT_TEXT_VOLUME, text_volume)
             .otherwise(normal))
    return t.select(
        F.col("symbol").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(0).alias("partition"),
        F.col("seq").alias("offset"),
        F.col("ts").alias("timestamp"))


def bar_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bars_daily`` as text columns in CSV order with injected faults.

    The fault selector is ``(user id + day of month) mod 50``: 0 symbol
    missing, 1 Open missing, 2 Close is text, 3 Volume missing.
    """
    b = bars_daily(spark, sf_dir)
    f = fault_code(F.substring("symbol", 2, 20).cast("bigint") + F.dayofmonth("date"))

    def txt(c: str) -> Column:
        return F.col(c).cast("string")

    return b.select(
        F.date_format("date", "yyyy-MM-dd").alias("Date"),
        F.when(f != 0, F.col("symbol")).alias("Symbol"),
        F.when(f != 1, txt("open")).alias("Open"),
        txt("high").alias("High"),
        txt("low").alias("Low"),
        F.when(f == 2, F.lit("n/a")).otherwise(txt("close")).alias("Close"),
        F.when(f != 3, txt("volume")).alias("Volume"),
    )
