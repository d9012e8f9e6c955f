import json
import os
from datetime import datetime

import bars as B
import pytest
from candlehouse.operators import facts
from candlehouse.operators.rollup import bucket_rollup, stale_buckets
from candlehouse.operators.transform import transform_crypto
from candlehouse.plans import ingest, news
from candlehouse.plans.continuous import refresh_late, rollup_table
from candlehouse.plans.transform import crypto_days, store_crypto_days
from candlehouse.plans.warehouse import Warehouse
from candlehouse.schemas import RAW_SCHEMA, REJECT_SCHEMA, STOCK_KEY
from candlehouse.sources import payloads as P
from candlehouse.sources.tables import conform, read_table
from candlehouse.streaming import jobs

LANDED = B.STOCK.replace(", price_change double", "") + ", src_id bigint"


def land(spark, folder, batch, *rows):
    """One file per batch, in order of modification time."""
    frame = spark.createDataFrame([(*B.stock_row(ts=t, close=c)[:-1], i) for t, c, i in rows], LANDED)
    frame.coalesce(1).write.mode("append").parquet(f"{folder}/b{batch}")
    for name in os.listdir(f"{folder}/b{batch}"):
        os.utime(f"{folder}/b{batch}/{name}", (1_700_000_000 + batch, 1_700_000_000 + batch))


def stream(spark, folder):
    return spark.readStream.schema(LANDED).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def test_duplicates_within_and_across_batches(spark, tmp_path):
    src, raw = f"{tmp_path}/src", f"{tmp_path}/raw"
    land(spark, src, 1, ("2024-01-15 10:00:00", 2, 7), ("2024-01-15 10:00:00", 1, 3), ("2024-01-16 10:00:00", 5, 4))
    land(spark, src, 2, ("2024-01-15 10:00:00", 9, 1), ("2024-03-16 10:00:00", 6, 9))
    jobs.stream_insert_ignore(stream(spark, src), raw, f"{tmp_path}/c1", STOCK_KEY, "src_id").awaitTermination()
    jobs.stream_insert_ignore(stream(spark, src), raw, f"{tmp_path}/c2", STOCK_KEY, "src_id").awaitTermination()
    assert sorted(int(r.close) for r in spark.read.parquet(raw).collect()) == [1, 5, 6]


def test_stream_continues_from_its_checkpoint(spark, tmp_path):
    src, raw = f"{tmp_path}/src", f"{tmp_path}/raw"
    for batch, day in ((1, 15), (2, 16)):
        land(spark, src, batch, (f"2024-01-{day} 10:00:00", day, day))
        jobs.stream_insert_ignore(stream(spark, src), raw, f"{tmp_path}/c", STOCK_KEY, "src_id").awaitTermination()
    assert spark.read.parquet(raw).count() == 2


def test_streamed_load_and_rollup_equal_the_batch_for_closed_windows(spark, tmp_path):
    src, house = f"{tmp_path}/src", Warehouse(spark, f"{tmp_path}/w")
    land(spark, src, 1, *[(f"2024-01-{d:02d} {h:02d}:00:00", d + h, d * 100 + h) for d in range(10, 20) for h in (9, 15)])
    jobs.stream_load_stock(stream(spark, src), house, f"{tmp_path}/c1", STOCK_KEY, "src_id").awaitTermination()
    facts_in = jobs.read_fact_stream(spark, house.fact_path, house.fact.schema)
    jobs.stream_rollup(facts_in, "day", f"{tmp_path}/windows", f"{tmp_path}/c2").awaitTermination()
    closed = spark.read.parquet(f"{tmp_path}/windows")
    batch = bucket_rollup(house.fact, "day").filter("bucket < '2024-01-16'").select(closed.columns)
    assert closed.count() == 6 and closed.exceptAll(batch).count() == 0 and batch.exceptAll(closed).count() == 0


def test_rows_behind_the_watermark_stay_out_of_the_stream(spark, tmp_path):
    src = f"{tmp_path}/src"
    # The watermark of the second file counts for late rows from the fourth file on.
    times = ["2024-01-10 10:00:00", "2024-01-20 10:00:00", "2024-01-20 12:00:00", "2024-01-10 11:00:00",
             "2024-01-30 10:00:00"]
    for batch, time in enumerate(times):
        frame = facts.fact_union({"STOCK": B.stock(spark, B.stock_row(ts=time))})
        frame.coalesce(1).write.parquet(f"{src}/b{batch}")
        for name in os.listdir(f"{src}/b{batch}"):
            os.utime(f"{src}/b{batch}/{name}", (1_700_000_000 + batch, 1_700_000_000 + batch))
    schema = spark.read.parquet(f"{src}/b0").schema
    late = jobs.read_fact_stream(spark, f"{src}/*", schema, files_per_batch=1)
    jobs.stream_rollup(late, "day", f"{tmp_path}/windows", f"{tmp_path}/c").awaitTermination()
    got = {r.bucket: r.record_count for r in spark.read.parquet(f"{tmp_path}/windows").collect()}
    assert got == {datetime(2024, 1, 10): 1, datetime(2024, 1, 20): 2}


def test_state_drops_copies_of_other_batches_and_the_table_those_behind_it(spark, tmp_path):
    src, raw = f"{tmp_path}/src", f"{tmp_path}/raw"
    first, later, far = ("2024-01-15 10:00:00", 1, 1), ("2024-01-16 10:00:00", 2, 2), ("2024-03-01 10:00:00", 3, 3)
    for batch, rows in enumerate([(first, later), (first, later), (far,), (far, later)]):
        land(spark, src, batch, *rows)
    query = jobs.stream_insert_new(stream(spark, src), raw, f"{tmp_path}/c", STOCK_KEY)
    query.awaitTermination()
    assert sorted(int(r.close) for r in spark.read.parquet(raw).collect()) == [1, 2, 3]
    kept = [o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]]
    assert kept[-1] == 1  # the keys behind the watermark have left the state
    jobs.stream_insert_new(stream(spark, src), raw, f"{tmp_path}/c2", STOCK_KEY).awaitTermination()
    assert spark.read.parquet(raw).count() == 3


def test_open_buckets_equal_the_batch_rollup_after_each_batch(spark, tmp_path):
    src, path = f"{tmp_path}/src", f"{tmp_path}/open"
    times = [["2024-01-30 09:00:00", "2024-01-31 09:00:00"], ["2024-01-31 15:00:00", "2024-02-01 09:00:00"], ["2024-02-01 08:00:00"]]
    so_far = []
    for batch, some in enumerate(times):
        rows = facts.fact_union({"STOCK": B.stock(spark, *[B.stock_row(ts=t, close=i + batch + 10) for i, t in enumerate(some)])})
        rows.coalesce(1).write.parquet(f"{src}/b{batch}")
        so_far.append(f"{src}/b{batch}")
        incoming = jobs.read_fact_stream(spark, f"{src}/*", rows.schema)
        jobs.stream_open_rollup(incoming, "day", path, f"{tmp_path}/c").awaitTermination()
        stored, batch_rollup = rollup_table(spark, path).read(), bucket_rollup(spark.read.parquet(*so_far), "day")
        assert stored.exceptAll(batch_rollup.select(stored.columns)).count() == 0 and stored.count() == batch_rollup.count()


CRYPTO = ("symbol string, currency string, ts string, open double, high double, low double, close double,"
          "volume_from double, volume_to double")


def land_crypto(spark, src, batch, *rows):
    """Raw bars of (symbol, currency, time, price) as one more folder below ``src``."""
    frame = spark.createDataFrame([(s, c, t, p, p + 2, p - 1, p + 1, 1.0, 2.0) for s, c, t, p in rows], CRYPTO)
    frame = conform(frame, RAW_SCHEMA["CRYPTO"])
    frame.coalesce(1).write.parquet(f"{src}/b{batch}")
    return frame.schema


def crypto_stream(spark, src, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")


def same(got, wanted):
    wanted = wanted.select(got.columns)
    return got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()


def test_open_crypto_days_equal_the_batch_transform_after_each_batch(spark, tmp_path):
    src, path = f"{tmp_path}/src", f"{tmp_path}/days"
    batches = [
        [("BTC", "USD", "2024-01-30 01:00:00", 10.0), ("BTC", "USD", "2024-01-31 01:00:00", 11.0), ("BTC", "EUR", "2024-01-31 01:00:00", 9.0)],
        [("BTC", "USD", "2024-01-31 23:00:00", 12.0), ("BTC", "USD", "2024-01-31 01:00:00", 11.0), (None, "USD", "2024-02-01 00:00:00", 3.0)],
        [(None, "USD", "2024-02-01 09:00:00", 0.0), ("ETH", "USD", "2024-02-01 00:00:00", 5.0)],
        [],
    ]
    for batch, rows in enumerate(batches):
        schema = land_crypto(spark, src, batch, *rows)
        jobs.stream_crypto_days(crypto_stream(spark, src, schema), path, f"{tmp_path}/c").awaitTermination()
        raw = spark.read.schema(schema).parquet(*[f"{src}/b{i}" for i in range(batch + 1)])
        days = crypto_days(raw, path)
        assert same(days.read(), conform(transform_crypto(raw), days.schema))
    assert days.read().count() == 5


def test_a_crypto_bar_behind_the_watermark_waits_for_the_batch(spark, tmp_path):
    src, path = f"{tmp_path}/src", f"{tmp_path}/days"
    times = ["2024-01-10 10:00:00", "2024-01-20 10:00:00", "2024-01-20 11:00:00", "2024-01-10 11:00:00"]
    for batch, time in enumerate(times):
        schema = land_crypto(spark, src, batch, ("BTC", "USD", time, 10.0 + batch))
        jobs.stream_crypto_days(crypto_stream(spark, src, schema), path, f"{tmp_path}/c", "1 day").awaitTermination()
    raw = spark.read.schema(schema).parquet(f"{src}/*")
    assert {r.ts.day: float(r.volume_from) for r in crypto_days(raw, path).read().collect()} == {10: 1.0, 20: 2.0}
    store_crypto_days(raw, path, datetime(2024, 1, 10))
    assert same(crypto_days(raw, path).read(), conform(transform_crypto(raw), crypto_days(raw, path).schema))


def page(day, close):
    value = {"datetime": f"2024-01-{day:02d}", "open": "1", "high": "3", "low": "1", "close": close, "volume": "5"}
    return json.dumps({"values": [value, value | {"datetime": "2024-02-01"}]})


def land_pages(spark, folder, *pages):
    lines = spark.createDataFrame([("AAPL", "1day", f"{n}\t{text}") for n, text in pages], "symbol string, interval_code string, value string")
    lines.coalesce(1).write.mode("append").partitionBy("symbol", "interval_code").text(folder)


def test_a_batch_that_died_between_its_two_writes_is_repeated_to_the_same_tables(spark, tmp_path, monkeypatch):
    landing, raw, rejects = f"{tmp_path}/landing", f"{tmp_path}/raw", f"{tmp_path}/rejects"
    sent = [[(1, page(1, "2")), (2, page(2, "x")), (3, "{broken")], [(4, page(1, "9")), (5, page(4, "7")), (6, "")]]

    def run():
        pages = P.stream_landed(spark, landing, ["symbol", "interval_code"], numbered_lines=True)
        jobs.stream_ingest(pages, "STOCK", raw, rejects, f"{tmp_path}/c").awaitTermination()

    def dies(*_):
        raise RuntimeError("between the writes")

    for pages in sent:
        land_pages(spark, landing, *pages)
        with monkeypatch.context() as patch, pytest.raises(Exception, match="between the writes"):
            patch.setattr(ingest, "store_rejects", dies)
            run()
        run()
        run()  # nothing new
    landed = P.read_landed(spark, landing, ["symbol", "interval_code"], numbered_lines=True)
    ingest.ingest_bars(P.parse_stock(landed), "STOCK", f"{raw}_batch", f"{rejects}_batch")
    bars, bad = ([read_table(spark, f"{path}{end}", schema) for end in ("", "_batch")]
                 for path, schema in ((raw, RAW_SCHEMA["STOCK"]), (rejects, REJECT_SCHEMA)))
    assert same(bars[0].drop("sys_timestamp"), bars[1].drop("sys_timestamp")) and bars[0].count() == 3
    assert same(*bad) and bad[0].count() >= 3
    assert {float(r.close) for r in bars[0].collect()} == {2.0, 7.0}


def test_news_pages_as_a_stream(spark, tmp_path):
    store = news.NewsStore(spark, f"{tmp_path}/news")
    row = {"title": "t", "published_date": "2024-01-05", "description": "d", "content": "c", "link": "l1"}
    for n, rows in enumerate([[row, row | {"link": None}], [row | {"title": "later"}, row | {"link": "l2"}]]):
        text = json.dumps({"rows": [{"row": r} for r in rows]})
        spark.createDataFrame([(f"{n}\t{text}",)], "value string").coalesce(1).write.mode("append").text(f"{tmp_path}/landing")
        pages = P.stream_landed(spark, f"{tmp_path}/landing", [], numbered_lines=True)
        jobs.stream_ingest_news(pages, store, f"{tmp_path}/c").awaitTermination()
    assert sorted((r.link, r.title) for r in store.raw().collect()) == [("l1", "t"), ("l2", "t")]
    assert read_table(spark, store.reject_path, REJECT_SCHEMA).count() == 1


def test_late_buckets_of_a_stream_are_found_and_recomputed(spark, tmp_path):
    src, path = f"{tmp_path}/src", f"{tmp_path}/open"
    late = ["2024-01-10 11:00:00", "2024-01-10 12:00:00", "2023-12-31 12:00:00"]
    for batch, times in enumerate([["2024-01-10 10:00:00", "2024-01-11 10:00:00"], ["2024-01-20 10:00:00"], ["2024-01-20 11:00:00"], late]):
        rows = facts.fact_union({"STOCK": B.stock(spark, *[B.stock_row(ts=t, close=i + batch + 10) for i, t in enumerate(times)])})
        rows.coalesce(1).write.parquet(f"{src}/b{batch}")
        query = jobs.stream_open_rollup(jobs.read_fact_stream(spark, f"{src}/*", rows.schema), "day", path, f"{tmp_path}/c")
        query.awaitTermination()
    assert jobs.dropped_rows(query) >= 2  # one by bucket and task at least
    fact, table = spark.read.parquet(f"{src}/*"), rollup_table(spark, path)
    found = {str(r.bucket.date()): r.late_rows for r in stale_buckets(table.read(), fact, "day").collect()}
    assert found == {"2024-01-10": 2, "2023-12-31": 1}
    assert refresh_late(fact, path, "day") == 2
    assert same(table.read(), bucket_rollup(fact, "day")) and table.read().count() == 4
    assert refresh_late(fact, path, "day") == 0
