"""Canonical schemas and the fixed values every strategy shares."""

from pyspark.sql import types as T

# Canonical bar row: unique on (symbol, ts); ts is a wall-clock (NTZ) timestamp.
BAR_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])

BAR_COLUMNS = [f.name for f in BAR_SCHEMA.fields]

# Wire message of one bar: epoch-millisecond timestamp plus OHLCV. Volume is read
# as a double (upstream may send 5.4E7) and cast to bigint after decoding.
WIRE_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
])

# Short upstream field names and the long names they map to.
# Fixed values (must equal the upstream format):
#   t -> timestamp, o -> open, h -> high, l -> low, c -> close, v -> volume
UPSTREAM_FIELDS = {"t": "timestamp", "o": "open", "h": "high", "l": "low", "c": "close", "v": "volume"}

# Fixed values of the strategies (must equal the reference behaviour):
#   RSI oversold bound 30, overbought bound 70
#   defaults: starting cash 1000, short period 5, long period 30, RSI period 7,
#   strategy "sma", range 2023-06-01 .. 2023-08-17, at most 50000 bars per scan
RSI_LOW = 30.0
RSI_HIGH = 70.0
DEFAULT_CASH = 1000.0
DEFAULT_SHORT = 5
DEFAULT_LONG = 30
DEFAULT_RSI_PERIOD = 7
DEFAULT_STRATEGY = "sma"
DEFAULT_START = "2023-06-01"
DEFAULT_END = "2023-08-17"
SCAN_LIMIT = 50000

# Digits kept when results are compared across engines.
INDICATOR_DIGITS = 6
MONEY_DIGITS = 2
