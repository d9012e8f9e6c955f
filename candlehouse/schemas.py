"""Column types, seed rows and fixed lists of the warehouse."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Stored prices and volumes. Operators accept any numeric type; up to 18 digits stay long-backed.
PRICE = T.DecimalType(28, 10)

# Fixed value: the length that raw tables allow for a symbol or currency; parsers take another as a parameter.
MAX_SYMBOL_LENGTH = 10

# Asset types (id, code, name, description).
ASSET_TYPES = [
    (1, "STOCK", "Stock", "Equity securities"),
    (2, "FOREX", "Forex", "Foreign exchange currency pairs"),
    (3, "CRYPTO", "Cryptocurrency", "Digital cryptocurrencies"),
]
ASSET_TYPE_ID = {code: type_id for type_id, code, _, _ in ASSET_TYPES}

# Bar intervals (id, code, name, minutes, description).
TIME_INTERVALS = [
    (1, "1min", "1 Minute", 1, "One minute interval"),
    (2, "5min", "5 Minutes", 5, "Five minutes interval"),
    (3, "15min", "15 Minutes", 15, "Fifteen minutes interval"),
    (4, "1h", "1 Hour", 60, "One hour interval"),
    (5, "4h", "4 Hours", 240, "Four hours interval"),
    (6, "1day", "1 Day", 1440, "Daily interval"),
]
INTERVAL_ID = {code: interval_id for interval_id, code, _, _, _ in TIME_INTERVALS}
INTERVAL_CODES = [code for _, code, _, _, _ in TIME_INTERVALS]
INTERVAL_MINUTES = {code: minutes for _, code, _, minutes, _ in TIME_INTERVALS}
DAILY = "1day"

# Default symbol universe.
TOP_STOCKS = ["AAPL", "MSFT", "GOOGL", "AMZN", "TSLA", "META", "NVDA", "JPM", "JNJ", "V"]
TOP_FOREX_PAIRS = ["EUR/USD", "GBP/USD", "USD/JPY", "USD/CHF", "AUD/USD",
                   "USD/CAD", "NZD/USD", "EUR/GBP", "EUR/JPY", "GBP/JPY"]
INDEX_ETF = "SPY"

# Natural keys of the stored tables.
STOCK_KEY = ["symbol", "interval_code", "ts"]
FOREX_KEY = ["currency_pair", "interval_code", "ts"]
CRYPTO_KEY = ["symbol", "currency", "ts"]
FACT_KEY = ["symbol_id", "interval_id", "ts"]

REJECT_KEY = ["source", "page", "pos", "symbol", "currency", "interval_code"]


_TYPES = {"bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
          "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
          PRICE.simpleString(): PRICE}


def _fields(text: str) -> T.StructType:
    """Like ``StructType.fromDDL``, which needs a session."""
    found = re.findall(r"(\w+) (\w+\([\d,]+\)|\w+)", text)
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in found])


_OHLC = ", ".join(f"{name} {PRICE.simpleString()}" for name in ("open", "high", "low", "close"))

# Stored tables. Every write casts to these and every read is bound to them, so files of all loads agree.
FACT_COLUMNS = [
    "symbol_id", "asset_type_id", "interval_id", "ts", "open", "high", "low", "close",
    "volume", "volume_from", "volume_to", "price_change", "avg_price", "source_table",
]
FACT_SCHEMA = _fields(
    f"symbol_id bigint, asset_type_id int, interval_id int, ts timestamp, {_OHLC}, volume bigint,"
    f"volume_from {PRICE.simpleString()}, volume_to {PRICE.simpleString()}, price_change double, avg_price double,"
    "source_table string, fact_id bigint, loaded_at timestamp")
DIM_SYMBOL_SCHEMA = _fields(
    "symbol_id bigint, symbol_code string, asset_type_id int, symbol_name string, exchange string, currency string,"
    "is_active boolean")
_BAR_TIMES = "start_date_time timestamp, end_date_time timestamp, sys_timestamp timestamp"
RAW_SCHEMA = {
    "STOCK": _fields(f"symbol string, interval_code string, ts timestamp, {_OHLC}, volume bigint, {_BAR_TIMES}"),
    "FOREX": _fields(f"currency_pair string, interval_code string, ts timestamp, {_OHLC}, {_BAR_TIMES}"),
    "CRYPTO": _fields(f"symbol string, currency string, ts timestamp, {_OHLC}, volume_from {PRICE.simpleString()},"
                      f"volume_to {PRICE.simpleString()}, sys_timestamp timestamp"),
}
RAW_KEY = {"STOCK": STOCK_KEY, "FOREX": FOREX_KEY, "CRYPTO": CRYPTO_KEY}
TRANSFORMED_SCHEMA = {
    "STOCK": _fields(f"symbol string, interval_code string, ts timestamp, {_OHLC}, volume bigint, price_change double"),
    "FOREX": _fields(f"currency_pair string, interval_code string, ts timestamp, {_OHLC}, price_change double"),
    "CRYPTO": _fields(f"symbol string, currency string, ts timestamp, {_OHLC}, volume_from {PRICE.simpleString()},"
                      f"volume_to {PRICE.simpleString()}, avg_price double, price_change double"),
}
REJECT_SCHEMA = _fields(
    "source string, page string, pos int, symbol string, currency string, interval_code string, source_time string,"
    "reason string")
NEWS_RAW_SCHEMA = _fields(
    "link string, title string, published_date date, description string, content string, top_image string,"
    "authors string, section string")
NEWS_SCHEMA = _fields("link string, title string, published_date date, description string, content string")
LINK_SCHEMA = _fields("link string, published_date date")
