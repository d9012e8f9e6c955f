import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from candlehouse.functions import columns as C
from candlehouse.schemas import INTERVAL_MINUTES


def one(spark, *columns, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return tuple(row.select(*columns).first())


BOUNDS = [
    ("1min", "09:37:00", 1), ("5min", "09:35:00", 5), ("15min", "09:30:00", 15), ("1h", "09:00:00", 60),
    ("4h", "08:00:00", 240), ("1day", "00:00:00", 1440), ("1week", "00:00:00", 1440),
]


@pytest.mark.parametrize("interval,start,minutes", BOUNDS)
def test_bar_bounds(spark, interval, start, minutes):
    ts = datetime(2024, 1, 15, 9, 37, 11)
    low, high = one(spark, C.bar_start(F.col("t"), F.col("i")), C.bar_end(F.col("t"), F.col("i")), t=ts, i=interval)
    expected = datetime.fromisoformat(f"2024-01-15 {start}")
    assert low == expected
    assert high == expected + timedelta(minutes=minutes) - timedelta(microseconds=1)


def test_bar_start_of_random_times_before_and_after_1970(spark):
    rng = random.Random(7)
    epoch = datetime(1970, 1, 1)
    times = [epoch + timedelta(microseconds=rng.randrange(-10**15, 2 * 10**15)) for _ in range(300)]
    rows = [(t, code) for t in times for code in INTERVAL_MINUTES]
    got = spark.createDataFrame(rows, "t timestamp, i string").select(
        "t", "i", C.bar_start(F.col("t"), F.col("i")).alias("s")).collect()
    for t, code, start in got:
        size = timedelta(minutes=INTERVAL_MINUTES[code])
        assert start == epoch + (t - epoch) // size * size


@pytest.mark.parametrize("text,interval,expected", [
    ("2024-01-15 09:30:00", "5min", datetime(2024, 1, 15, 9, 30)),
    ("2024-01-15 09:30:00", "4h", datetime(2024, 1, 15, 9, 30)),
    ("2024-01-15", "1day", datetime(2024, 1, 15)),
    ("2024-01-15", "1h", None),
    ("2024-01-15 09:30:00", "1day", None),
    ("yesterday", "1day", None),
])
def test_bar_time(spark, text, interval, expected):
    assert one(spark, C.parse_bar_time(F.col("x"), F.col("i")), x=text, i=interval) == (expected,)


@pytest.mark.parametrize("text,price,whole", [
    ("150.0", Decimal("150.0000000000"), 150), ("1e3", Decimal("1000.0000000000"), 1000),
    ("n/a", None, None), ("", None, None), ("NaN", None, None), ("1e30", None, None),
    ("-2.75", Decimal("-2.7500000000"), -2),
])
def test_numbers(spark, text, price, whole):
    assert one(spark, C.parse_price(F.col("x")), C.parse_whole(F.col("x")), x=text) == (price, whole)


@pytest.mark.parametrize("open_,close,expected", [("0", "5", 0.0), ("-1", "5", 0.0), ("4", "5", 25.0)])
def test_price_change(spark, open_, close, expected):
    assert one(spark, C.price_change(F.col("o"), F.col("c")), o=Decimal(open_), c=Decimal(close)) == (expected,)


@pytest.mark.parametrize("high,low,expected", [("5", "4", 25.0), ("5", "0", 0.0), ("5", "-1", 0.0)])
def test_volatility(spark, high, low, expected):
    assert one(spark, C.volatility(F.col("h"), F.col("l")), h=Decimal(high), l=Decimal(low)) == (expected,)


@pytest.mark.parametrize("text,expected", [
    ("", False), ("   ", False), ("\t\n", False), (" ", False), (" 　", False), ("\x0b\x1c", False),
    (None, False), ("a", True), ("  x", True),
])
def test_not_blank(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "x string")
    assert frame.select(C.not_blank(F.col("x"))).first() == (expected,)


def test_symbol_id_tells_currency_and_type_apart(spark):
    frame = spark.createDataFrame(
        [("CRYPTO", "BTC", "USD"), ("CRYPTO", "BTC", "EUR"), ("STOCK", "BTC", None), ("FOREX", "BTC", None)],
        "a string, s string, c string")
    ids = [r[0] for r in frame.select(C.symbol_id(F.col("a"), F.col("s"), F.col("c"))).collect()]
    assert len(set(ids)) == 4 and all(0 <= i < 2**60 for i in ids)


def test_whole_sums_do_not_overflow(spark):
    big = spark.createDataFrame([(2**62,), (2**62,), (2**62,)], "v bigint")
    assert big.agg(C.exact_sum(F.col("v"))).first()[0] == 3 * 2**62
