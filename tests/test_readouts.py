import random
from datetime import date, datetime, timedelta

import bars as B
from candlehouse.operators import readouts
from candlehouse.sources import universe


def test_last_n_across_months(spark):
    rows = [B.stock_row(interval="1day", ts=f"2024-{m:02d}-{d:02d} 00:00:00") for m in (1, 2, 3) for d in (1, 2, 3)]
    got = readouts.last_n(B.stock(spark, *rows, B.stock_row("B", "1day")), ["symbol"], 4).collect()
    assert sorted(r.ts for r in got if r.symbol == "AAPL") == [datetime(2024, 2, 3), *[datetime(2024, 3, d) for d in (1, 2, 3)]]
    assert sum(r.symbol == "B" for r in got) == 1


def test_price_history_counts_and_takes_any_number_of_days(spark):
    frame = B.stock(spark, *[B.stock_row(interval="1day", ts=f"2024-01-{d:02d} 00:00:00") for d in range(1, 6)], B.stock_row())
    rows = readouts.price_history(frame, "symbol", 3).orderBy("rn").collect()
    assert [(r.days, r["count"], r.date[:10]) for r in rows] == [(3, 3, f"2024-01-0{d}") for d in (5, 4, 3)]
    assert readouts.price_history(frame, "symbol", 9999).count() == 5


def test_price_history_of_crypto_by_currency(spark):
    frame = B.crypto(spark, *[("BTC", c, f"2024-01-{d:02d}", d) for c in ("USD", "EUR") for d in range(1, 5)])
    rows = readouts.price_history(frame, "symbol", 3).collect()
    assert sorted((r.currency, r.rn, r["count"], r.date[8:10], r.volume) for r in rows) == [
        (c, n, 3, f"0{5 - n}", None) for c in ("EUR", "USD") for n in (1, 2, 3)]
    assert {float(r.volume_to) for r in rows} == {2.0}


def test_index_is_newest_first(spark):
    frame = B.stock(spark, *[B.stock_row("SPY", "1day", f"2024-01-{d:02d} 00:00:00") for d in range(1, 4)])
    assert [r.date[8:10] for r in readouts.index_daily(frame, 2).collect()] == ["03", "02"]
    assert readouts.index_daily(frame, 100_000).count() == 3


def test_price_by_date_takes_the_newest_bar_up_to_the_day(spark):
    prices = B.crypto(spark, ("BTC", "USD", "2024-01-10 01:00:00", 1), ("BTC", "USD", "2024-01-10 23:59:59", 2),
                      ("BTC", "USD", "2024-01-12", 3), ("BTC", "EUR", "2024-01-11", 9))
    asked = [("BTC", "USD", date(2024, 1, d)) for d in (9, 10, 11, 12, 30)] + [("ETH", "USD", date(2024, 1, 10)),
                                                                               ("BTC", "USD", None)]
    requests = spark.createDataFrame(asked * 2, "symbol string, currency string, date date")
    got = {(r.symbol, r.date.day): r.close for r in readouts.price_by_date(prices, requests).collect()}
    assert got == {("BTC", 9): None, ("BTC", 10): 2, ("BTC", 11): 2, ("BTC", 12): 3, ("BTC", 30): 3, ("ETH", 10): None}


def test_request_with_a_malformed_date_is_dropped(spark):
    prices = B.crypto(spark, ("BTC", "USD", "2024-01-10", 1))
    requests = spark.createDataFrame([("BTC", "USD", "2024-01-10"), ("BTC", "USD", "10.01.2024")],
                                     "symbol string, currency string, date string")
    assert [r.close for r in readouts.price_by_date(prices, requests).collect()] == [1]


def test_one_symbol_with_most_of_the_rows(spark):
    """Brute force over a table in which one symbol holds a third of the bars and a third of the requests."""
    rng = random.Random(11)
    first = date(2020, 1, 1)
    pick = lambda: ("HOT" if rng.random() < 1 / 3 else f"S{rng.randrange(20)}", first + timedelta(days=rng.randrange(700)))
    closes = {pick(): i for i in range(1500)}
    asked = {pick() for _ in range(800)}
    prices = B.crypto(spark, *[(s, "USD", str(day), close) for (s, day), close in closes.items()])
    requests = spark.createDataFrame([(s, "USD", day) for s, day in asked], "symbol string, currency string, date date")
    got = {(r.symbol, r.date): r.close for r in readouts.price_by_date(prices, requests).collect()}
    for s, day in asked:
        before = [(d, c) for (other, d), c in closes.items() if other == s and d <= day]
        assert got[s, day] == (max(before)[1] if before else None)
    newest = readouts.last_n(prices, ["symbol"], 7).collect()
    for s in {s for s, _ in closes}:
        days = sorted((d for other, d in closes if other == s), reverse=True)[:7]
        assert sorted((r.ts.date() for r in newest if r.symbol == s), reverse=True) == days


def test_top_by_volume_breaks_ties_by_symbol(spark):
    prices = B.crypto(spark, ("B", "USD", "2024-01-10", 1), ("A", "USD", "2024-01-10", 1), ("C", "USD", "2024-01-10", 1),
                      ("C", "EUR", "2024-01-10", 1))
    assert [r.symbol for r in universe.top_by_volume(prices, 2).collect()] == ["C", "A"]


def test_date_range_of_nothing(spark):
    assert tuple(readouts.date_range(B.stock(spark).select("ts")).first()) == (None, None)


def test_link_counts(spark):
    links = spark.createDataFrame([("a",), ("a",), ("b",)], "link string")
    assert {tuple(r) for r in readouts.link_counts(links).collect()} == {("a", 2), ("b", 1)}
