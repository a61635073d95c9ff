"""Table contracts and the fixed values the pipeline must share with the
system it reproduces."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the original pipeline's for equal results)
# ---------------------------------------------------------------------------
# Source labels written by the live job and the daily / hourly backfills.
SOURCE_LIVE = "yahoo_finance"
SOURCE_DAILY = "yahoo_finance_daily"
SOURCE_HOURLY = "yahoo_finance_hourly"
DEFAULT_SOURCE = "yahoo_finance"
# Values accepted by the bronze `source` data test.
ACCEPTED_SOURCES = ["yahoo_finance", "coingecko", "binance"]
# Dashboard timeframe presets, in days; the default is 30.
TIMEFRAME_DAYS = {"7D": 7, "1M": 30, "3M": 90, "6M": 180, "1Y": 365, "2Y": 730, "ALL": 3000}
DEFAULT_TIMEFRAME_DAYS = 30
DEFAULT_COMPARE_DAYS = 90
# Thresholds.
FRESHNESS_HORIZON = "2 hours"        # live freshness query window
STALE_AFTER_MINUTES = 90             # live job: stale when older
FRESHNESS_WARN_MINUTES = 30          # bronze source freshness test
FRESHNESS_ERROR_MINUTES = 60
MIN_SYMBOLS = 5                      # backfill validation: raise below
MIN_ROWS_DAILY = 1000                # backfill validation: warn below
MIN_ROWS_HOURLY = 10000
OUTLIER_RETURN_PCT = 100.0           # silver drops |simple return| >= this
SYMBOL_MAX_LEN = 20
SOURCE_MAX_LEN = 50
PRICE_DECIMAL = T.DecimalType(20, 8)
VOLUME_DECIMAL = T.DecimalType(20, 2)
# Upstream frame column names and their bronze names.
UPSTREAM_RENAMES = {"Date": "timestamp", "Datetime": "timestamp", "Open": "open",
                    "High": "high", "Low": "low", "Close": "close", "Volume": "volume"}
BRONZE_COLUMNS = ["timestamp", "symbol", "open", "high", "low", "close", "volume",
                  "source", "ingestion_timestamp"]
BRONZE_KEY = ["timestamp", "symbol", "source"]

SILVER_COLUMNS = ["timestamp", "symbol", "open", "high", "low", "close", "volume", "source",
                  "ingestion_timestamp", "intraperiod_change", "intraperiod_change_pct",
                  "log_return", "simple_return_pct", "spread", "spread_pct", "prev_volume",
                  "flag_missing_open", "flag_missing_high", "flag_missing_low",
                  "flag_missing_close", "flag_zero_volume", "updated_at"]

GOLD_COLUMNS = ["date", "symbol", "open", "high", "low", "close", "volume", "price_change",
                "price_change_pct", "daily_spread", "spread_pct", "daily_return_pct",
                "log_return", "data_points", "first_timestamp", "last_timestamp", "updated_at"]
# ---------------------------------------------------------------------------

# A landed line that does not parse, kept as text.
CORRUPT = "corrupt_record"

# Upstream bars as they land (one file set per fetch), before renaming: daily
# frames name the bar time Date, intraday ones Datetime.
UPSTREAM_SCHEMA = T.StructType([
    T.StructField("Date", T.TimestampType(), True),
    T.StructField("Datetime", T.TimestampType(), True),
    T.StructField("Open", T.DoubleType(), True),
    T.StructField("High", T.DoubleType(), True),
    T.StructField("Low", T.DoubleType(), True),
    T.StructField("Close", T.DoubleType(), True),
    T.StructField("Volume", T.DoubleType(), True),
    T.StructField("symbol", T.StringType(), True),
])

# Bronze as stored.  Prices stay DOUBLE through the pipeline; `cast_bars`
# gives the decimal contract (20,8)/(20,2) when a typed table is wanted.
BRONZE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("symbol", T.StringType(), False),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("volume", T.DoubleType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("ingestion_timestamp", T.TimestampType(), True),
])
