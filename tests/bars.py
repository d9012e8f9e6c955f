"""Small hand-made bar tables."""

from datetime import datetime
from decimal import Decimal

from candlehouse.operators import dims, facts
from candlehouse.operators.marts import Star

STOCK = ("symbol string, interval_code string, ts timestamp, open decimal(12,2), high decimal(12,2),"
         "low decimal(12,2), close decimal(12,2), volume bigint, price_change double")
FOREX = STOCK.replace("symbol string", "currency_pair string").replace(" volume bigint,", "")
CRYPTO_RAW = ("symbol string, currency string, ts timestamp, open decimal(12,2), high decimal(12,2),"
              "low decimal(12,2), close decimal(12,2), volume_from decimal(12,2), volume_to decimal(12,2)")
CRYPTO = CRYPTO_RAW + ", avg_price double, price_change double"


def at(text):
    return datetime.fromisoformat(text)


def d(value):
    return Decimal(str(value))


def stock_row(symbol="AAPL", interval="1min", ts="2024-01-15 09:30:00", open_=10, high=12, low=9, close=11, volume=100):
    return (symbol, interval, at(ts), d(open_), d(high), d(low), d(close), volume, 0.0)


def stock(spark, *rows):
    return spark.createDataFrame(list(rows), STOCK)


def forex(spark, *pairs_and_times):
    rows = [(pair, "1day", at(ts), d(1), d(2), d(1), d(2), 0.0) for pair, ts in pairs_and_times]
    return spark.createDataFrame(rows, FOREX)


def crypto(spark, *keys):
    rows = [(s, c, at(ts), d(close), d(close), d(close), d(close), d(1), d(2), 0.0, 0.0) for s, c, ts, close in keys]
    return spark.createDataFrame(rows, CRYPTO)


def star(transformed):
    return Star(facts.fact_union(transformed), dims.all_symbols(transformed))
