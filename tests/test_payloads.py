import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from candlehouse.plans.backfill import backfill
from candlehouse.plans.ingest import arrival, ingest_bars
from candlehouse.schemas import CRYPTO_KEY
from candlehouse.sources import payloads as P

CRYPTO_PAGE = json.dumps({"Data": {"Data": [
    {"time": 1683633600, "open": 3, "high": 4, "low": 2, "close": 3, "volumefrom": 1, "volumeto": 3}]}})


def bar(datetime_="2023-05-09", **changes):
    point = {"datetime": datetime_, "open": "31.5", "high": "33.25", "low": "30.75", "close": "32.0",
             "volume": "4200", **changes}
    return {k: v for k, v in point.items() if v != "DROP"}


def stock(spark, *pages, symbol="ACME", interval="1day"):
    rows = [(symbol, interval, f"p{i}", p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(pages)]
    return spark.createDataFrame(rows, "symbol string, interval_code string, page string, payload string")


def test_stock_bar(spark):
    row = P.valid(P.parse_stock(stock(spark, {"values": [bar()]}))).first()
    assert (row.ts, row.open, row.close, row.volume) == (
        datetime(2023, 5, 9), Decimal("31.5000000000"), Decimal("32.0000000000"), 4200)
    assert row.start_date_time == datetime(2023, 5, 9)
    assert row.end_date_time == datetime(2023, 5, 9, 23, 59, 59, 999999)


def test_numbers_may_be_json_numbers(spark):
    point = bar(open=31.5, high=33.25, low=30, close=32.125, volume=4200)
    row = P.valid(P.parse_stock(stock(spark, {"values": [point]}))).first()
    assert (row.low, row.close, row.volume) == (Decimal(30), Decimal("32.125"), 4200)


@pytest.mark.parametrize("page", [{"status": "ok"}, {"values": []}, {}, {"values": None}])
def test_payload_without_values_is_empty(spark, page):
    assert P.parse_stock(stock(spark, page)).count() == 0
    assert P.price_points(stock(spark, page)).count() == 0


@pytest.mark.parametrize("change,reason", [
    ({"close": "DROP"}, "missing close"), ({"close": None}, "missing close"), ({"close": "n/a"}, "bad close"),
    ({"volume": "DROP"}, "missing volume"), ({"datetime": "2024-13-01"}, "bad datetime"),
    ({"datetime": "DROP"}, "missing datetime"), ({"open": {"x": 1}}, "bad open"),
])
def test_bad_row_is_rejected_and_others_kept(spark, change, reason):
    point = {k: v for k, v in {**bar("2024-01-16"), **change}.items() if v != "DROP"}
    parsed = P.parse_stock(stock(spark, {"values": [bar(), point]}))
    assert P.valid(parsed).count() == 1
    assert [r.reason for r in P.rejects(parsed, "stock").collect()] == [reason]


@pytest.mark.parametrize("text", ["{bad", '{"values": "x"}', "[1]"])
def test_malformed_payload_is_one_reject(spark, text):
    parsed = P.parse_stock(stock(spark, text))
    assert [r.reason for r in P.rejects(parsed, "stock").collect()] == [P.MALFORMED]


def test_unsupported_interval_and_long_symbol(spark):
    week = P.parse_stock(stock(spark, {"values": [bar()]}, interval="1week"))
    long = P.parse_stock(stock(spark, {"values": [bar()]}, symbol="ELEVENCHARS"))
    assert [r.reason for r in P.rejects(week, "s").collect()] == ["unsupported interval"]
    assert [r.reason for r in P.rejects(long, "s").collect()] == ["symbol too long"]


def test_interval_defaults_to_daily(spark):
    assert P.valid(P.parse_stock(stock(spark, {"values": [bar()]}, interval=None))).first().interval_code == "1day"


def test_whole_pages_refuse_a_page_with_one_bad_bar_and_say_so(spark):
    pages = stock(spark, {"values": [bar(), bar("2024-01-16", close="n/a")]}, {"values": [bar("2024-01-17")]}, "{broken")
    parsed = P.parse_stock(pages, whole_pages=True)
    assert [r.ts.day for r in P.valid(parsed).collect()] == [17]
    assert sorted((r.page, r.pos, r.reason) for r in P.rejects(parsed, "stock").collect()) == [
        ("p0", 0, P.REFUSED), ("p2", 0, P.MALFORMED)]


def test_missing_keys_are_rejected(spark):
    page = {"values": [bar()]}
    assert [r.reason for r in P.rejects(P.parse_stock(stock(spark, page, symbol=None)), "s").collect()] == ["missing symbol"]
    pages = spark.createDataFrame([(None, "USD", 1, CRYPTO_PAGE), ("BTC", None, 2, CRYPTO_PAGE)],
                                  "symbol string, currency string, page int, payload string")
    assert sorted(r.reason for r in P.rejects(P.parse_crypto(pages), "c").collect()) == ["missing currency", "missing symbol"]


def test_the_length_of_a_symbol_is_a_parameter(spark):
    assert P.valid(P.parse_stock(stock(spark, {"values": [bar()]}, symbol="ELEVENCHARS"), longest=20)).count() == 1


def test_date_range_includes_both_ends(spark):
    page = {"values": [bar(f"2024-01-{d} {t}") for d, t in
                       [("09", "23:59:59"), ("10", "00:00:00"), ("12", "23:59:59"), ("13", "00:00:00")]]}
    bars = P.valid(P.parse_stock(stock(spark, page, interval="1h")))
    assert sorted(r.ts.day for r in P.in_date_range(bars, "2024-01-10", "2024-01-12").collect()) == [10, 12]


def test_forex_needs_no_volume(spark):
    pages = spark.createDataFrame(
        [("EUR/USD", "1day", json.dumps({"values": [bar(volume="DROP", open="0.7315")]}))],
        "currency_pair string, interval_code string, payload string")
    row = P.valid(P.parse_forex(pages)).first()
    assert (row.currency_pair, row.open) == ("EUR/USD", Decimal("0.7315000000"))


def test_crypto_bar_and_reject(spark):
    good = {"time": 1683633600, "open": 3.0, "high": 4.0, "low": 2.5, "close": 3.5, "volumefrom": 12.0, "volumeto": 39.0}
    bad = {k: v for k, v in good.items() if k != "volumeto"}
    pages = spark.createDataFrame(
        [("BTC", "USD", json.dumps({"Data": {"Data": [good, bad]}})), ("BTC", "USD", json.dumps({"Data": {"Data": []}}))],
        "symbol string, currency string, payload string")
    parsed = P.parse_crypto(pages)
    row = P.valid(parsed).first()
    assert (row.ts, row.volume_from, row.volume_to) == (datetime(2023, 5, 9, 12), 12, 39)
    assert [r.reason for r in P.rejects(parsed, "crypto").collect()] == ["missing volumeto"]
    assert [r.date for r in P.crypto_price_points(pages).collect()] == ["2023-05-09"]


def test_price_points_keep_order_and_make_volume_optional(spark):
    page = {"values": [bar("2023-05-09", volume="DROP"), bar("2024-01-14"), bar("2024-01-13", low=None)]}
    points = P.price_points(stock(spark, page), include_volume=True).orderBy("pos").collect()
    assert [(p.date, p.volume) for p in points] == [("2023-05-09", None), ("2024-01-14", 4200)]
    assert [p.volume for p in P.price_points(stock(spark, page)).collect()] == [None, None]


def test_news_page(spark):
    row = {"title": "T", "published_date": "2017-01-02", "description": None, "content": "C", "link": "l1",
           "top_image": "i", "authors": None}
    page = {"num_rows_total": 3, "rows": [{"row": row}, {"row": {**row, "published_date": "soon"}},
                                          {"row": {k: v for k, v in row.items() if k != "link"}}]}
    parsed = P.parse_news(spark.createDataFrame([(json.dumps(page),)], "payload string"))
    good = P.valid(parsed).first()
    assert (good.published_date, good.description, good.transformed) == (date(2017, 1, 2), None, False)
    assert sorted(r.reason for r in parsed.filter("reason is not null").collect()) == ["bad published_date", "missing link"]


def test_ranking_payload(spark):
    text = json.dumps({"Data": [{"CoinInfo": {"Name": n}} for n in ("BTC", "ETH")]})
    names = P.ranked_names(spark.createDataFrame([(text,)], "payload string"))
    assert [r.symbol for r in names.orderBy("pos").collect()] == ["BTC", "ETH"]


def test_one_payload_per_file(spark, tmp_path):
    folder = tmp_path / "symbol=EUR%2FUSD" / "interval_code=1day"
    folder.mkdir(parents=True)
    for i in range(2):
        (folder / f"{i}.json").write_text(json.dumps({"values": [bar(f"2024-01-1{i}")]}, indent=1))
    rows = P.valid(P.parse_stock(P.read_landed(spark, str(tmp_path), ["symbol", "interval_code"]))).collect()
    assert {(r.symbol, r.ts.day) for r in rows} == {("EUR/USD", 10), ("EUR/USD", 11)}
    assert len({r.page for r in rows}) == 2


def test_numbered_lines_keep_their_order(spark, tmp_path):
    folder = tmp_path / "in" / "symbol=ACME" / "interval_code=1day"
    folder.mkdir(parents=True)
    lines = [f"{n}\t{json.dumps({'values': [bar(open=o)]})}" for n, o in ((12, "9.5"), (2, "9.9"))]
    (folder / "all.txt").write_text("\n".join(lines))
    landed = P.read_landed(spark, str(tmp_path / "in"), ["symbol", "interval_code"], numbered_lines=True)
    ingest_bars(P.parse_stock(landed), "STOCK", f"{tmp_path}/raw", f"{tmp_path}/rejects")
    assert [float(r.open) for r in spark.read.parquet(f"{tmp_path}/raw").collect()] == [9.9]


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_ingest_stores_good_rows_once_and_first_copy_wins(spark, tmp_path, kind):
    raw, bad = f"{tmp_path}/raw", f"{tmp_path}/rejects"
    pages = stock(spark, {"values": [bar(close="1"), bar(close="2"), bar("2024-02-01"), bar("x")]},
                  {"values": [bar(close="3")]})
    pages = pages.withColumn("page", F.expr("substring(page, 2)").cast(kind))
    first = ingest_bars(P.parse_stock(pages), "STOCK", raw, bad)
    again = ingest_bars(P.parse_stock(pages), "STOCK", raw, bad)
    assert (first, again) == ({"stored": 2, "rejected": 1}, {"stored": 0, "rejected": 0})
    stored = spark.read.parquet(raw)
    assert stored.filter(F.col("ts") == "2023-05-09").first().close == 1
    assert [(r.page, r.pos, r.reason) for r in spark.read.parquet(bad).collect()] == [("0", 3, "bad datetime")]
    assert not any((tmp_path / "raw_staging").iterdir())


def test_numbered_pages_are_deduplicated_by_hash(spark):
    parsed = P.valid(P.parse_crypto(spark.createDataFrame([("BTC", "USD", 1, CRYPTO_PAGE)], "symbol string, currency string, page bigint, payload string")))
    plan = arrival(parsed, CRYPTO_KEY)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_backfill_of_a_universe(spark, tmp_path):
    pages = stock(spark, {"values": [bar("2024-01-10"), bar("2024-01-20")]}).unionByName(
        stock(spark, {"values": [bar("2024-01-10")]}, {"values": [bar("2024-01-11"), bar("2024-01-12", low="?")]}, symbol="AAPL"))
    run = lambda universe: backfill(pages, "STOCK", f"{tmp_path}/raw", f"{tmp_path}/bad", universe, "2024-01-01", "2024-01-15")
    assert run(None) == {"stored": 1, "rejected": 1}  # AAPL is in the default universe
    assert run(["ACME"]) == {"stored": 1, "rejected": 0}
    assert run(spark.createDataFrame([("ACME",), ("AAPL",)], "symbol string")) == {"stored": 0, "rejected": 0}
