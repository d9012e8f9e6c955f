"""Work that must not grow faster than the input: copies staged, pages built again, single tasks, facts that nobody asked for."""

import pytest
from pyspark.sql import functions as F

from candlehouse.plans import ingest, storage, transform, warehouse
from candlehouse.schemas import STOCK_KEY
from candlehouse.sources import payloads as P
from candlehouse.sources.tables import table_exists
from candlehouse.streaming import jobs
from candlehouse.workload import queries
from candlehouse.workload.tables import MarketTables


class Stop(Exception):
    """Ends a query once a test has seen what it wants."""


def page(number, *bars):
    values = ",".join(f'{{"datetime":"{d}","open":"{o}","high":"9","low":"1","close":"2","volume":"5"}}' for d, o in bars)
    return ("A", "1day", number, f'{{"values":[{values}]}}')


@pytest.fixture
def pages(spark):
    rows = [page(2, ("2024-01-02", "7"), ("2024-01-03", "8"), ("2024-01-04", "x")), page(1, ("2024-01-02", "6"), ("soon", "1")),
            page(3, ("2024-01-02", "5"), ("2024-01-04", "x")), ("A", "1day", 4, "{broken")]
    return spark.createDataFrame(rows, "symbol string, interval_code string, page bigint, payload string")


@pytest.mark.parametrize("named", [False, True])
def test_copies_are_not_staged(spark, pages, tmp_path, monkeypatch, named):
    whole, seen = ingest.staged, []

    def counting(parsed, path):
        seen.append({(r.rejected, r.n) for r in parsed.groupBy(F.col("reason").isNotNull().alias("rejected")).agg(F.count("*").alias("n")).collect()})
        return whole(parsed, path)

    monkeypatch.setattr(ingest, "staged", counting)
    pages = pages.withColumn("page", F.concat(F.lit("file-"), F.col("page"))) if named else pages
    raw, bad = f"{tmp_path}/raw", f"{tmp_path}/rejects"
    assert ingest.ingest_bars(P.parse_stock(pages), "STOCK", raw, bad) == {"stored": 2, "rejected": 4}
    assert ingest.ingest_bars(P.parse_stock(pages), "STOCK", raw, bad) == {"stored": 0, "rejected": 0}
    assert seen == [{(False, 2), (True, 4)}] * 2  # before: four good rows
    assert {(r.ts.day, int(r.open)) for r in spark.read.parquet(raw).collect()} == {(2, 6), (3, 8)}
    prefix = "file-" if named else ""
    assert {(r.page, r.pos, r.source_time, r.reason) for r in spark.read.parquet(bad).collect()} == {
        (f"{prefix}2", 2, "2024-01-04", "bad open"), (f"{prefix}1", 1, "soon", "bad datetime"),
        (f"{prefix}3", 1, "2024-01-04", "bad open"), (f"{prefix}4", 0, None, "malformed payload")}


def test_good_rows_stay_in_a_hash_aggregate(pages):
    plan = ingest.first_or_reject(P.parse_stock(pages), STOCK_KEY)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def builds_pages(rows) -> bool:
    return "collect_list" in rows._jdf.queryExecution().optimizedPlan().toString()


def test_rejects_read_landed_pages(spark, sf_dir, monkeypatch):
    seen = []

    def look(parsed, *_):
        seen.append(builds_pages(parsed))

    def stop(*_):
        raise Stop

    monkeypatch.setattr(ingest, "ingest_bars", look)
    monkeypatch.setattr(queries.news, "ingest_news", stop)
    with pytest.raises(Stop):
        queries.QUERIES["ingest_rejects"](spark, sf_dir)
    assert seen == [False] * 3


def test_load_by_type_parses_once(spark, sf_dir, monkeypatch):
    def look(_, transformed, codes):
        assert not builds_pages(transformed[codes[0]])
        raise Stop

    monkeypatch.setattr(warehouse, "load_full", look)
    with pytest.raises(Stop):
        queries.QUERIES["load_by_type"](spark, sf_dir)


def test_each_sending_is_a_run_of_the_stream(spark, sf_dir, monkeypatch):
    """One file for each batch would have to be written by one task."""
    runs, insert = [], jobs.stream_insert_new

    def counting(bars, path, checkpoint, key):
        runs.append(checkpoint)
        return insert(bars, path, checkpoint, key)

    monkeypatch.setattr(jobs, "stream_insert_new", counting)
    found = queries.QUERIES["stream_dedup_state"](spark, sf_dir)
    assert len(runs) == 4 and len(set(runs)) == 1
    assert found.count() == found.select(*STOCK_KEY).distinct().count() == MarketTables(spark, sf_dir).raw_stock.count()


def test_stored_tables_come_without_facts(spark, sf_dir):
    m = MarketTables(spark, f"{sf_dir}/.")  # a folder that no other test has asked for
    assert m.stored["STOCK"].count() > 0
    assert not table_exists(spark, m._store.fact_path)
    assert table_exists(spark, m.house.fact_path) and m.house.root == m._store.root


def test_no_pass_for_periods_before_the_first_write(spark, tmp_path, monkeypatch):
    bars = spark.sql("""select 'A' as symbol, '1day' as interval_code, timestamp '2024-01-02' as ts, 1.0BD as open, 1.0BD as high,
                        1.0BD as low, 1.0BD as close, 1L as volume""")
    asked, periods_of = [], storage.periods_of

    def counting(rows, *more):
        asked.append(1)
        return periods_of(rows, *more)

    monkeypatch.setattr(storage, "periods_of", counting)
    monkeypatch.setattr(transform, "periods_of", counting, raising=False)
    path = f"{tmp_path}/t"
    assert [transform.store_bars(bars, path, "STOCK"), len(asked)] == [1, 0]
    assert [transform.store_bars(bars, path, "STOCK"), len(asked)] == [0, 1]


def test_new_symbols_are_loaded_by_a_bounded_number_of_tasks(spark, tmp_path):
    bars = {"STOCK": spark.range(300).selectExpr("concat('S', id) as symbol"), "FOREX": spark.range(300).selectExpr("concat('F', id) as currency_pair")}
    house, partitions = warehouse.Warehouse(spark, str(tmp_path)), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert warehouse.load_symbols(house, bars) == 600
        assert warehouse.load_symbols(house, bars) == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert {r.symbol_code for r in house.symbols.collect()} == {f"{t}{i}" for t in "SF" for i in range(300)}
    written = house.symbols.select("symbol_id").inputFiles()
    assert len(written) <= warehouse.SYMBOL_TASKS  # before: 80
