import json
from datetime import date, datetime

import bars as B
from bars import CRYPTO_RAW, at, d
from candlehouse.operators import transform
from candlehouse.plans import news
from candlehouse.plans import transform as transforms
from candlehouse.schemas import STOCK_KEY


def raw(spark, *rows):
    return spark.createDataFrame(
        [(s, c, at(ts), d(o), d(h), d(lo), d(cl), d(1), d(2)) for s, c, ts, o, h, lo, cl in rows], CRYPTO_RAW)


def test_crypto_day(spark):
    bars = raw(spark, ("BTC", "USD", "2024-01-15 01:00:00", 4, 10, 2, 6), ("BTC", "USD", "2024-01-15 23:00:00", 8, 12, 6, 5),
               ("BTC", "EUR", "2024-01-15 01:00:00", 1, 1, 1, 1))
    row = transform.transform_crypto(bars).filter("currency = 'USD'").first()
    assert (row.ts, row.open, row.high, row.low, row.close) == (datetime(2024, 1, 15), 4, 12, 2, 6)
    assert (row.volume_from, row.volume_to, row.avg_price, row.price_change) == (2, 4, 7.5, 50.0)


def test_crypto_day_of_zero_opens_is_kept_without_a_change(spark):
    row = transform.transform_crypto(raw(spark, ("X", "USD", "2024-01-15", 0, 1, 0, 1))).first()
    assert row.price_change is None and row.close == 1


def test_finished_days_are_left_alone_unless_replaced(spark):
    bars = raw(spark, ("BTC", "USD", "2024-01-14", 1, 1, 1, 1), ("BTC", "USD", "2024-01-15", 2, 2, 2, 2),
               ("BTC", "USD", "2024-01-16", 3, 3, 3, 3))
    done = transform.transform_crypto(bars.filter("ts < '2024-01-16'"))
    assert [r.ts.day for r in transform.transform_crypto(bars, done).collect()] == [16]
    again = transform.transform_crypto(bars, done, replace_from=date(2024, 1, 15))
    assert sorted(r.ts.day for r in again.collect()) == [15, 16]


def test_pending(spark):
    rows = [("A", "1h", at("2024-01-15 01:00:00")), ("A", "1day", at("2024-01-15")), ("B", "1h", at("2024-01-15"))]
    bars = spark.createDataFrame(rows, "symbol string, interval_code string, ts timestamp")
    done = bars.filter("symbol = 'A' and interval_code = '1day'")
    assert transform.pending(bars, done, STOCK_KEY).count() == 2
    assert [tuple(r) for r in transform.pending_keys(bars, done, STOCK_KEY).collect()] == [("A", "1h"), ("B", "1h")]


def test_stored_crypto_days(spark, tmp_path):
    path = f"{tmp_path}/t"
    partial = raw(spark, ("BTC", "USD", "2024-01-30 01:00:00", 1, 1, 1, 1), ("BTC", "USD", "2024-01-31 01:00:00", 1, 1, 1, 1))
    whole = partial.union(raw(spark, ("BTC", "USD", "2024-01-30 05:00:00", 9, 9, 9, 9),
                              ("BTC", "USD", "2024-01-31 05:00:00", 9, 9, 9, 9), ("BTC", "USD", "2024-02-01", 2, 2, 2, 2)))
    assert transforms.store_crypto_days(partial, path) == 2
    assert transforms.store_crypto_days(whole, path) == 1  # finished days stay
    transforms.store_crypto_days(whole, path, datetime(2024, 1, 31))
    stored = {r.ts.day: int(r.close) for r in transforms.crypto_days(whole, path).read().collect()}
    assert stored == {30: 1, 31: 9, 1: 2}


def test_stored_bars_are_added_once(spark, tmp_path):
    bars = B.stock(spark, B.stock_row(), B.stock_row(ts="2024-02-15 09:30:00")).drop("price_change")
    add = lambda rows: transforms.store_bars(rows, f"{tmp_path}/t", "STOCK")
    assert [add(bars.limit(1)), add(bars), add(bars)] == [1, 1, 0]


NEWS = "link string, title string, published_date date, description string, content string"


def test_news_rounds(spark, tmp_path):
    store = news.NewsStore(spark, str(tmp_path))
    day = date(2017, 1, 2)
    first = [("l1", "t", day, "d", "c"), ("l2", " \t", day, "d", "c"), ("l3", "t", day, None, "c"),
             ("l4", "t", day, " ", "c")]
    assert news.save_articles(store, spark.createDataFrame(first, NEWS)) == 4
    news.transform_pending(store)
    assert [r.link for r in store.published().collect()] == ["l1"]
    assert news.pending_articles(store).count() == 0  # blank ones are done too

    second = spark.createDataFrame([first[0], ("l5", "t", day, "d", "c")], NEWS)
    assert news.save_articles(store, second) == 1
    news.transform_pending(store)
    news.transform_pending(store)
    assert sorted(r.link for r in store.published().collect()) == ["l1", "l5"]


def test_a_news_run_that_died_before_its_ledger_publishes_nothing_twice(spark, tmp_path):
    store = news.NewsStore(spark, str(tmp_path))
    articles = spark.createDataFrame([("l1", "t", date(2017, 1, 2), "d", "c")], NEWS)
    news.save_articles(store, articles)
    news._append_by_link(articles, store.published(), store.published_path)
    news.transform_pending(store)
    assert store.published().count() == 1


def test_news_from_landed_pages(spark, tmp_path):
    def page(n, *rows):
        keys = ("title", "published_date", "description", "content", "link")
        return (n, json.dumps({"rows": [{"row": dict(zip(keys, r))} for r in rows]}))

    store = news.NewsStore(spark, str(tmp_path))
    pages = [page(2, ("late copy", "2019-05-01", "d", "c", "l1"), ("t", "soon", "d", "c", "l3")),
             page(1, ("first", "2019-05-01", "d", "c", "l1"), ("t", "2019-06-01", "d", "c", None), ("t2", "2019-06-01", "d", "c", "l2"))]
    frame = spark.createDataFrame([*pages, (3, "{broken")], "page bigint, payload string")
    assert news.news_round(store, frame) == {"stored": 2, "rejected": 3}
    assert news.news_round(store, frame) == {"stored": 0, "rejected": 0}
    assert sorted((r.link, r.title) for r in store.published().collect()) == [("l1", "first"), ("l2", "t2")]
    rejects = spark.read.parquet(store.reject_path)
    assert sorted((r.page, r.pos, r.reason) for r in rejects.collect()) == [
        ("1", 1, "missing link"), ("2", 1, "bad published_date"), ("3", 0, "malformed payload")]


def test_pending_articles_are_found_without_their_texts(spark, tmp_path):
    store = news.NewsStore(spark, str(tmp_path))
    news.save_articles(store, spark.createDataFrame([("l1", "t", date(2017, 1, 2), "d", "c")], NEWS))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = news.pending_links(store)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "content" not in plan and "title" not in plan
