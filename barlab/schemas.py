"""Fixed schemas of the bar lake (bronze, silver, gold) and of derived tables."""

from pyspark.sql import types as T

D = T.DoubleType()

# Vendor page: one JSON document per page of bars.
BAR_JSON_ITEM = T.StructType([
    T.StructField("t", T.StringType()),
    T.StructField("o", D), T.StructField("h", D), T.StructField("l", D),
    T.StructField("c", D), T.StructField("v", D),
    T.StructField("n", T.LongType()), T.StructField("vw", D),
])
BARS_JSON_PAGE = T.StructType([
    T.StructField("bars", T.ArrayType(BAR_JSON_ITEM)),
    T.StructField("next_page_token", T.StringType()),
])

SILVER = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("open", D), T.StructField("high", D), T.StructField("low", D),
    T.StructField("close", D), T.StructField("volume", D),
    T.StructField("num_trades", T.LongType()), T.StructField("vwap", D),
    T.StructField("symbol", T.StringType()), T.StructField("resolution", T.StringType()),
    T.StructField("dt", T.DateType()),
])

GOLD_COLUMNS = ["utc_timestamp", "et", "session", "open", "high", "low", "close",
                "volume", "num_trades", "vwap", "return_1m"]

# Canonical names and the vendor short names they come from (fixed values).
FIELD_MAP = {"t": "ts", "o": "open", "h": "high", "l": "low", "c": "close", "v": "volume"}
SILVER_RENAMES = {"o": "open", "h": "high", "l": "low", "c": "close", "v": "volume",
                  "n": "num_trades", "vw": "vwap"}
# Probe order for the time column of a drifting schema (fixed values).
TS_ALIASES = ["ts", "utc_timestamp", "timestamp", "datetime"]

TRADE = T.StructType([
    T.StructField("idx_in", T.IntegerType()),
    T.StructField("ts_in", T.TimestampType()),
    T.StructField("side", T.StringType()),
    T.StructField("entry", D),
    T.StructField("R", D),
    T.StructField("exit_idx", T.IntegerType()),
    T.StructField("exit_ts", T.TimestampType()),
    T.StructField("exit_reason", T.StringType()),
    T.StructField("exit_price", D),
    T.StructField("pnl_R", D),
])

OPTION_CONTRACT = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("strike", D),
    T.StructField("type", T.StringType()),
    T.StructField("expiration", T.StringType()),
])
