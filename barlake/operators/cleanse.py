"""Decode, parse, validate and cleanse bars (F1-F6, F3, ST5, A7).

The same functions serve batch tables and streaming DataFrames, so a
stream and its batch twin share one plan.  Conversions never raise under
ANSI mode: JSON parsing is PERMISSIVE (a bad field becomes NULL, a bad
message becomes all-NULL), numbers use ``try_cast``.

Documented differences from the reference pipeline:

* a text value in a numeric field nulls that field (and the row is then
  rejected) instead of aborting the whole file (F4);
* NaN prices/volumes are rejected as well as NULLs (F3);
* a message without ``Date`` takes the message timestamp, not the wall
  clock, so replays agree (F6); an unparseable ``Date`` is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.schema import (CORRUPT_COLUMN, NUMERIC_FIELDS, PAYLOAD_SCHEMA,
                            PAYLOAD_SCHEMA_CHECKED)

# Fixed reject reasons, checked in this order.
REASONS = ["not_json", "missing_symbol", "missing_date", "bad_date",
           "missing_open", "missing_high", "missing_low", "missing_close", "missing_volume",
           "nan_open", "nan_high", "nan_low", "nan_close", "nan_volume"]


# Source position and producer cycle, carried along where the envelope has them.
POSITION = ["partition", "cycle"]


def decode_envelope(env: DataFrame) -> DataFrame:
    """message key/value bytes to text, keeping the source position."""
    return env.select(
        F.col("key").cast("string").alias("symbol_key"),
        F.col("value").cast("string").alias("json_data"),
        F.col("offset").alias("seq"),
        F.col("timestamp").alias("msg_ts"),
        *[F.col(c) for c in POSITION if c in env.columns])


def parse_payload(decoded: DataFrame) -> DataFrame:
    """parse the JSON payload with the fixed schema and flatten it.

    Adds ``is_json``: false when the text did not parse as a JSON object at
    all (the parser flags it as corrupt and no field could be read).  Keeps
    the raw text for the reject table; column pruning drops it where unused.

    The parsed struct is emitted through ``inline(array(...))``: generator
    output is never substituted into later predicates, so the validity
    filter cannot be pushed below the parse and every message is parsed
    exactly once (a plain projection would be inlined into each branch of
    the reject-reason ``CASE``, parsing the text a dozen times).
    """
    data = F.from_json("json_data", PAYLOAD_SCHEMA_CHECKED,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})
    fields = [f.name for f in PAYLOAD_SCHEMA.fields]
    no_field = F.lit(True)
    for f in fields:
        no_field = no_field & F.col(f).isNull()
    kept = ["symbol_key", "seq", "msg_ts", "json_data", *[c for c in POSITION if c in decoded.columns]]
    return (decoded.select(*kept, F.inline(F.array(F.struct(data.alias("d")))))
            .select(*kept, "d.*")
            .withColumn("is_json", ~(F.col(CORRUPT_COLUMN).isNotNull() & no_field))
            .drop(CORRUPT_COLUMN))


def parse_bar_time(text: str | Column) -> Column:
    """Wall-clock TIMESTAMP_NTZ from ``yyyy-MM-dd[ HH:mm:ss][offset]`` text.

    A trailing UTC offset is ignored (local wall-clock time is kept).
    """
    t = F.col(text) if isinstance(text, str) else text
    return t.try_cast("timestamp_ntz")


def reject_reason(parsed: DataFrame, date_required: bool = True) -> Column:
    """ST5: the first failed check of a parsed row, NULL for a valid row."""
    c = F.when(~F.col("is_json"), F.lit("not_json")).when(F.col("Symbol").isNull(), F.lit("missing_symbol"))
    if date_required:
        c = c.when(F.col("Date").isNull(), F.lit("missing_date"))
    c = c.when(F.col("Date").isNotNull() & parse_bar_time("Date").isNull(), F.lit("bad_date"))
    for f in NUMERIC_FIELDS:
        c = c.when(F.col(f.capitalize()).isNull(), F.lit(f"missing_{f}"))
    for f in NUMERIC_FIELDS:
        c = c.when(F.isnan(F.col(f.capitalize())), F.lit(f"nan_{f}"))
    return c


def classify(parsed: DataFrame, date_required: bool = True) -> DataFrame:
    """Parsed rows with a ``reason`` column (NULL = valid)."""
    return parsed.withColumn("reason", reject_reason(parsed, date_required))


def to_bars(classified: DataFrame, default_time: bool = False,
            keep: tuple[str, ...] = ()) -> DataFrame:
    """F3 + F6: valid rows as typed intraday bars (symbol, ts, seq, OHLCV).

    With ``default_time`` a missing Date takes the message timestamp.
    ``keep`` names position columns to carry along.
    """
    ts = parse_bar_time("Date")
    if default_time:
        ts = F.when(F.col("Date").isNull(), F.col("msg_ts")).otherwise(ts)
    return classified.where(F.col("reason").isNull()).select(
        F.col("Symbol").alias("symbol"), ts.alias("ts"), "seq",
        *[F.col(f.capitalize()).alias(f) for f in NUMERIC_FIELDS], *keep)


def valid_bars(envelopes: DataFrame) -> DataFrame:
    """F1 -> F2 -> F3: envelopes to valid bars (historical path: Date required)."""
    return to_bars(classify(parse_payload(decode_envelope(envelopes))))


def rejects(envelopes: DataFrame) -> DataFrame:
    """ST5: every rejected message with its reason and raw payload."""
    c = classify(parse_payload(decode_envelope(envelopes)))
    return c.where(F.col("reason").isNotNull()).select("seq", "symbol_key", "reason", "json_data")


def event_time_default(envelopes: DataFrame) -> DataFrame:
    """real-time path -- missing Date defaults to the message time."""
    c = classify(parse_payload(decode_envelope(envelopes)), date_required=False)
    return to_bars(c, default_time=True)


def zero_fill(parsed: DataFrame) -> DataFrame:
    """real-time producer rule -- missing or NaN numerics become 0."""
    fills = [F.coalesce(F.nanvl(F.col(f.capitalize()), F.lit(0.0)), F.lit(0.0)).alias(f)
             for f in NUMERIC_FIELDS]
    return parsed.where(F.col("Symbol").isNotNull()).select(
        F.col("Symbol").alias("symbol"), "seq", F.col("Date").alias("date_text"), *fills)


def ingest_metrics(envelopes: DataFrame) -> DataFrame:
    """Message counters -- total, valid and rejected per reason (one row)."""
    c = classify(parse_payload(decode_envelope(envelopes)))
    return c.agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("reason").isNull()).alias("valid"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected"),
        *[F.count_if(F.col("reason") == r).alias(r) for r in REASONS])


def clean_csv_bars(raw: DataFrame) -> DataFrame:
    """F4 + F3: landed CSV text rows to valid daily bars.

    Rows without a symbol are skipped, numerics are ``try_cast`` (bad text
    becomes NULL), and rows with any missing or NaN field are dropped.
    """
    sym = F.trim(F.col("Symbol"))
    typed = raw.select(
        sym.alias("symbol"),
        parse_bar_time("Date").cast("date").alias("date"),
        *[F.col(f.capitalize()).try_cast("double").alias(f) for f in NUMERIC_FIELDS])
    ok = F.col("symbol").isNotNull() & (F.col("symbol") != "") & F.col("date").isNotNull()
    for f in NUMERIC_FIELDS:
        ok = ok & F.col(f).isNotNull() & ~F.isnan(F.col(f))
    return typed.where(ok)


def encode_envelope(bars: DataFrame, time_col: str = "ts",
                    time_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Bars to keyed messages (key = symbol bytes, value = JSON payload)."""
    payload = F.to_json(F.struct(
        F.col("symbol").alias("Symbol"),
        F.date_format(time_col, time_format).alias("Date"),
        *[F.col(f).alias(f.capitalize()) for f in NUMERIC_FIELDS]))
    return bars.select(F.col("symbol").cast("binary").alias("key"), payload.cast("binary").alias("value"))
