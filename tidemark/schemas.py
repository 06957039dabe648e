"""Schemas and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values (must equal the reference for identical results) ---------
# Trailing window depth for the moving average and the volume mean.
WINDOW_ROWS = 7
# A bar is a price anomaly when abs(rounded pct_change) > 3 (strict).
ANOMALY_PCT = 3
# A bar is a volume spike when volume > 2 * trailing mean volume (strict).
SPIKE_FACTOR = 2
# Decimal places: pct_change 2, moving average 2, latency rollups 1.
PCT_DECIMALS = 2
MA_DECIMALS = 2
LATENCY_DECIMALS = 1
# Numeric-row pattern applied to the Close column of raw bar files.
NUMERIC_ROW_PATTERN = r"^-?\d+(\.\d+)?$"
# Raw bar file column order.
RAW_BAR_COLUMNS = ["Date", "Close", "High", "Low", "Open", "Volume", "symbol"]
# Numeric columns of a raw bar file.
RAW_NUMERIC_COLUMNS = ["Open", "High", "Low", "Close", "Volume"]
# Prefix that marks synthetic benchmark keys in the keyed table, and the key
# rule for integer i: BENCH-<year>-MM-DD, MM = i div 30 + 1, DD = i mod 28 + 1.
BENCH_PREFIX = "BENCH-"
BENCH_KEY_YEAR = 2019
BENCH_KEY_PER_MONTH = 30
BENCH_KEY_DAYS = 28
# Chunk size of the batched writer.
WRITE_BATCH_SIZE = 25
# Message field names: (lower-case name, capitalised name). Presence of the
# lower-case key decides which one is read.
MESSAGE_FIELDS = [
    ("symbol", "Symbol"),
    ("date", "Date"),
    ("open", "Open"),
    ("high", "High"),
    ("low", "Low"),
    ("close", "Close"),
    ("volume", "Volume"),
]
# --------------------------------------------------------------------------

RAW_BAR = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_BAR_COLUMNS])

BAR = T.StructType([
    T.StructField("symbol", T.StringType(), True),
    T.StructField("date", T.StringType(), True),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("volume", T.LongType(), True),
])

ENRICHED_BAR = T.StructType(BAR.fields + [
    T.StructField("pct_change", T.DoubleType(), True),
    T.StructField("moving_avg_7", T.DoubleType(), True),
    T.StructField("is_anomaly", T.BooleanType(), True),
    T.StructField("volume_spike", T.BooleanType(), True),
])

BAR_COLUMNS = [f.name for f in BAR.fields]
ENRICHED_COLUMNS = [f.name for f in ENRICHED_BAR.fields]

REJECT = T.StructType([
    T.StructField("raw", T.StringType(), True),
    T.StructField("reason", T.StringType(), True),
])

# Sink types of the keyed table (exact decimal repr of the doubles).
PRICE_DECIMAL = T.DecimalType(38, 18)
COMPUTED_DECIMAL = T.DecimalType(18, 2)
