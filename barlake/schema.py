"""Schemas of the bar relation and its wire formats."""

from pyspark.sql import types as T

# Column names of the stored bar relation (daily bars: ``date`` is DATE;
# intraday bars use ``ts`` TIMESTAMP_NTZ instead).
BAR_FIELDS = ["symbol", "date", "open", "high", "low", "close", "volume"]
PRICE_FIELDS = ["open", "high", "low", "close"]
NUMERIC_FIELDS = ["open", "high", "low", "close", "volume"]

# Wire payload of one message: Symbol first, every field nullable, Date as
# text (daily or ``yyyy-MM-dd HH:mm:ss``), numbers as doubles.
PAYLOAD_SCHEMA = T.StructType([
    T.StructField("Symbol", T.StringType(), True),
    T.StructField("Date", T.StringType(), True),
    T.StructField("Open", T.DoubleType(), True),
    T.StructField("High", T.DoubleType(), True),
    T.StructField("Low", T.DoubleType(), True),
    T.StructField("Close", T.DoubleType(), True),
    T.StructField("Volume", T.DoubleType(), True),
])

# The same with the parser's corrupt-record column (raw text of a message
# that did not parse cleanly).
CORRUPT_COLUMN = "_corrupt"
PAYLOAD_SCHEMA_CHECKED = T.StructType(PAYLOAD_SCHEMA.fields + [
    T.StructField(CORRUPT_COLUMN, T.StringType(), True)])

# Bar CSV as landed: Date first, everything read as text and cast later.
CSV_COLUMNS = ["Date", "Symbol", "Open", "High", "Low", "Close", "Volume"]
BAR_CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in CSV_COLUMNS])

# Symbol list CSV: one header column.
SYMBOL_LIST_SCHEMA = T.StructType([T.StructField("Symbol", T.StringType(), True)])

# Screener document: {"data": {"rows": [{"symbol": ...}, ...]}}
SCREENER_SCHEMA = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("rows", T.ArrayType(T.StructType([
            T.StructField("symbol", T.StringType(), True),
        ])), True),
    ]), True),
])

# Message envelope as a message bus hands it over (key/value bytes plus the
# source position, which is the arrival order used by keep-last).
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampNTZType(), True),
])

# The same with the producer's cycle number (a message header on the bus).
CYCLE_ENVELOPE_SCHEMA = T.StructType(ENVELOPE_SCHEMA.fields + [T.StructField("cycle", T.IntegerType(), True)])
