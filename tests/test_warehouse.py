from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import bars as B
from candlehouse.operators import dims, facts, marts
from candlehouse.plans import warehouse as W
from candlehouse.plans import ledger

VIEWS = list(W.MART_REFRESH)


@pytest.fixture
def house(spark, tmp_path):
    return W.Warehouse(spark, str(tmp_path))


def sources(spark):
    return {
        "STOCK": B.stock(spark, B.stock_row(ts="2024-01-15 09:30:00"), B.stock_row(ts="2024-01-15 09:31:00", close=13),
                         B.stock_row(interval="1week"), B.stock_row("BTC", "1day", "2024-02-01 00:00:00")),
        "FOREX": B.forex(spark, ("EUR/USD", "2024-01-15"), ("EUR/USD", "2024-01-16")),
        "CRYPTO": B.crypto(spark, ("BTC", "USD", "2024-01-15", 5), ("BTC", "EUR", "2024-01-15", 4)),
    }


def test_full_load_twice(spark, house):
    first = W.load_full(house, sources(spark))
    assert (first.counts, first.total) == ({"STOCK": 3, "FOREX": 2, "CRYPTO": 2}, 7)
    assert first.date_range == ("2024-01-15 00:00:00", "2024-02-01 00:00:00")
    assert (sorted(first.views.refreshed), first.views.errors, first.views.processed) == (sorted(VIEWS), {}, 4)
    again = W.load_full(house, sources(spark))
    assert (again.counts, house.fact.count()) == ({"STOCK": 0, "FOREX": 0, "CRYPTO": 0}, 7)
    assert house.symbols.count() == 5
    assert house.fact.select("fact_id").distinct().count() == 7
    assert house.fact.filter("loaded_at is null").count() == 0


@pytest.mark.parametrize("requested,counts", [
    (["STOCK"], {"STOCK": 3}), (["FOO"], {}), ([], {"STOCK": 3, "FOREX": 2, "CRYPTO": 2}),
    (["CRYPTO", "FOO", "STOCK"], {"STOCK": 3, "CRYPTO": 2}),
])
def test_selected_types(spark, house, requested, counts):
    assert W.load_full(house, sources(spark), requested).counts == counts


def test_unknown_types_load_nothing_but_refresh_views(spark, house):
    W.load_full(house, sources(spark))
    report = W.load_full(house, sources(spark), ["FOO"])
    assert (report.counts, report.total, len(report.views.refreshed)) == ({}, 0, 4)


def test_unknown_interval_stays_out(spark):
    assert facts.fact_rows(sources(spark)["STOCK"], "STOCK").filter("interval_id is null").count() == 0
    assert facts.fact_rows(B.stock(spark, B.stock_row(interval="1week")), "STOCK").count() == 0


def test_lookback_is_strict(spark, house):
    rows = [B.stock_row(ts=t) for t in ("2024-01-15 08:00:00", "2024-01-15 08:00:01", "2024-01-15 09:59:59")]
    report = W.load_incremental(house, {"STOCK": B.stock(spark, *rows)}, datetime(2024, 1, 15, 10), hours_back=2)
    assert (report.hours_back, report.data_from, report.counts) == (2, datetime(2024, 1, 15, 8), {"STOCK": 2})
    with pytest.raises(ValueError):
        W.load_incremental(house, {}, datetime(2024, 1, 15, 10), hours_back=0)


def test_full_load_equals_incremental_loads(spark, tmp_path):
    one, many = W.Warehouse(spark, f"{tmp_path}/a"), W.Warehouse(spark, f"{tmp_path}/b")
    bars = {"STOCK": B.stock(spark, *[B.stock_row(ts=f"2024-01-{day:02d} 12:00:00", close=day) for day in range(26, 32)],
                             *[B.stock_row(ts=f"2024-02-{day:02d} 12:00:00", close=day) for day in range(1, 6)])}
    assert W.load_full(one, bars).views.errors == {}
    for month, day in ((1, 28), (1, 31), (2, 3), (2, 6)):
        known = {"STOCK": bars["STOCK"].filter(F.col("ts") <= F.lit(datetime(2024, month, day)))}
        report = W.load_incremental(many, known, datetime(2024, month, day), hours_back=100)
        assert report.views.errors == {}
    columns = ["symbol_id", "interval_id", "ts", "close"]
    assert one.fact.select(columns).exceptAll(many.fact.select(columns)).count() == 0
    assert one.fact.count() == many.fact.count() == 11
    for view in VIEWS:
        full, kept = one.mart(view).read(), many.mart(view).read()
        for frame in ("price_volatility", "avg_price", "avg_close_price"):
            if frame in full.columns:
                full, kept = (f.withColumn(frame, F.round(frame, 9)) for f in (full, kept))
        assert full.exceptAll(kept).count() == 0 and kept.exceptAll(full).count() == 0


def test_incremental_refresh_leaves_earlier_months_untouched(spark, house):
    early, late = B.stock_row(ts="2024-01-10 12:00:00"), B.stock_row(ts="2024-02-10 12:00:00")
    W.load_full(house, {"STOCK": B.stock(spark, early)})

    def january_files():
        return sorted(f for f in house.mart("mv_daily_ohlc_summary").read().inputFiles() if "2024-01-01" in f)

    before = january_files()
    W.load_incremental(house, {"STOCK": B.stock(spark, early, late)}, datetime(2024, 2, 10, 13), 24)
    assert january_files() == before
    assert spark.table("mv_daily_ohlc_summary").count() == 2


@pytest.mark.parametrize("grain", ["day", "month", "year"])
def test_fact_grain_does_not_change_results(spark, tmp_path, grain):
    house = W.Warehouse(spark, str(tmp_path), grain)
    bars = {"STOCK": B.stock(spark, *[B.stock_row(ts=f"2024-0{m}-10 12:00:00") for m in range(1, 7)])}
    W.load_full(house, {"STOCK": bars["STOCK"].filter("ts < '2024-05-01'")})
    report = W.load_incremental(house, bars, datetime(2024, 6, 10, 13), 168)
    assert (report.counts, report.views.errors) == ({"STOCK": 1}, {})
    assert house.fact.count() == 5 and spark.table("mv_daily_ohlc_summary").count() == 5
    assert spark.table("mv_symbol_analytics").first().total_records == 5


def test_one_failing_mart_does_not_stop_the_others(spark, house):
    W.load_full(house, sources(spark))

    def broken(run, name):
        return run.whole(name, lambda: run.warehouse.fact.select("nothing"), [])

    before = spark.table(VIEWS[1]).count()
    transformed = {"STOCK": B.stock(spark, B.stock_row(ts="2024-05-05 09:30:00"))}
    W.append_facts(house, transformed)
    report = W.refresh_marts(house, steps={**W.MART_REFRESH, VIEWS[1]: broken})
    assert (report.processed, len(report.refreshed), list(report.errors)) == (4, 3, [VIEWS[1]])
    assert spark.table(VIEWS[1]).count() == before  # the old rows stay readable
    assert W.refresh_marts(house).errors == {}
    assert spark.table(VIEWS[1]).count() == before + 1  # and the next refresh makes up for it


def test_views_follow_a_refresh(spark, house):
    W.load_full(house, {"STOCK": B.stock(spark, B.stock_row())})
    W.load_full(house, {"STOCK": B.stock(spark, B.stock_row(), B.stock_row(ts="2024-03-01 00:00:00"))})
    assert spark.table("mv_symbol_analytics").first().total_records == 2


def test_currencies_are_kept_apart(spark):
    rows = {r.currency: r for r in marts.daily(B.star({"CRYPTO": sources(spark)["CRYPTO"]})).collect()}
    assert {c: (r.record_count, float(r.day_close)) for c, r in rows.items()} == {"USD": (1, 5.0), "EUR": (1, 4.0)}


def test_one_code_in_two_asset_types_does_not_fan_out(spark):
    star = B.star(sources(spark))
    view = marts.day_view(marts.daily(star))
    assert view.count() == view.select("symbol_id", "interval_code", "bucket").distinct().count() == 6
    btc = star.symbols.filter("symbol_code = 'BTC'")
    assert btc.select("symbol_id").distinct().count() == 3


def test_empty_warehouse_has_no_date_range(house):
    assert W.date_range(house) == (None, None)


def test_statistics(spark, house):
    W.load_full(house, sources(spark))
    got = {r.asset_type_code: (r.record_count, r.active_symbols) for r in W.statistics(house).collect()}
    assert got == {"STOCK": (3, 2), "FOREX": (2, 1), "CRYPTO": (2, 2), "ALL": (7, 5)}


def test_shared_id_is_refused(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "symbol_id bigint, symbol_code string")
    with pytest.raises(ValueError):
        dims.check_unique(twice)


def days(spark, *dates):
    return {"STOCK": B.stock(spark, *[B.stock_row(ts=f"{d} 12:00:00") for d in dates])}


def mart_days(house):
    return sorted(str(r.trading_day.date()) for r in house.mart("mv_daily_ohlc_summary").read().collect())


def test_an_append_without_a_refresh_reaches_the_marts_later(spark, house):
    W.load_full(house, days(spark, "2024-01-10"))
    W.append_facts(house, days(spark, "2024-01-20"))
    W.load_incremental(house, days(spark, "2024-02-10"), datetime(2024, 2, 10, 13), 24)
    assert mart_days(house) == ["2024-01-10", "2024-01-20", "2024-02-10"]
    assert spark.table("mv_symbol_analytics").first().total_records == 3


def test_a_load_that_died_before_it_closed_its_entry(spark, house):
    W.load_full(house, days(spark, "2024-01-10", "2024-03-01"))
    house.ledger.open(date(2024, 2, 1))  # a run that wrote its facts and died
    rows = W.facts.finish(W.facts.fact_union(days(spark, "2024-02-05")))
    W.insert_ignore(rows, house.fact_path, W.FACT_KEY, schema=W.FACT_SCHEMA)
    W.load_incremental(house, days(spark, "2024-03-10"), datetime(2024, 3, 10, 13), 24)
    assert mart_days(house) == ["2024-01-10", "2024-02-05", "2024-03-01", "2024-03-10"]
    assert not house.ledger.behind("mv_daily_ohlc_summary")


def test_views_come_back_in_a_new_session(spark, house):
    W.load_full(house, days(spark, "2024-01-10"))
    for view in VIEWS:
        spark.sql(f"DROP VIEW {view}")
    assert sorted(W.open_views(house)) == sorted(VIEWS)
    assert spark.table("mv_hourly_ohlc_summary").count() == 1
    spark.sql("DROP VIEW mv_daily_ohlc_summary")
    W.load_incremental(house, days(spark, "2024-02-10"), datetime(2024, 2, 10, 13), 24)
    assert spark.table("mv_daily_ohlc_summary").count() == 2
    assert W.analytic_view(house, "ohlc_7day").count() == 2


def test_views_of_two_sessions_stay_right_over_refreshes(spark, house):
    """Readers of two sessions open the views once and see every row after each refresh; a reading under way fails loudly at worst."""
    W.load_full(house, days(spark, "2024-01-10", "2024-02-10"))
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    readers = [(s.table("mv_daily_ohlc_summary"), s) for s in (spark, other)]
    for n, day in enumerate((11, 12, 13), 3):
        W.load_incremental(house, days(spark, f"2024-02-{day}"), datetime(2024, 2, day, 13), 24)
        for held, session in readers:
            assert session.table("mv_daily_ohlc_summary").count() == n
            assert session.table("mv_symbol_analytics").first().total_records == n
            try:
                assert held.count() in (2, n)
            except Exception as error:  # noqa: BLE001
                assert "FILE_NOT_EXIST" in str(error) or "FileNotFound" in str(error)
    folders = {p.name for p in Path(house.mart("mv_daily_ohlc_summary").path).iterdir() if p.is_dir()}
    assert folders == {"trade_period=2024-01-01", "trade_period=2024-02-01"}


def test_changed_facts_are_found_by_pruning_at_run_time(spark, house):
    W.load_full(house, days(spark, "2024-01-10", "2024-02-10"))
    W.append_facts(house, days(spark, "2024-02-11"))
    run = W.Refresh(house)
    rows = marts.hourly(marts.Star(W.of_periods(house.fact, run.touched("mv_hourly_ohlc_summary")), house.symbols))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    fact_scan = next(line for line in plan.splitlines() if "FileScan" in line and "volume" in line)
    assert "dynamicpruning" in fact_scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert {r.trading_hour.month for r in rows.collect()} == {2}


def test_a_refresh_that_died_is_repeated(spark, house, monkeypatch):
    W.load_full(house, days(spark, "2024-01-10"))
    W.append_facts(house, days(spark, "2024-01-20"))
    with monkeypatch.context() as m:
        m.setattr(W.Refresh, "close", lambda run: None)  # the run ends before it notes what it has done
        W.refresh_marts(house)
    assert W.Refresh(house).is_behind("mv_symbol_analytics")
    assert W.refresh_marts(house).errors == {} and not W.Refresh(house).is_behind("mv_symbol_analytics")
    assert mart_days(house) == ["2024-01-10", "2024-01-20"]


def test_loads_of_one_type_each_with_other_decimals(spark, house):
    stock = sources(spark)["STOCK"].withColumn("open", F.col("open").cast("decimal(20,8)"))
    for one in ({"STOCK": stock}, {"CRYPTO": sources(spark)["CRYPTO"]}, {"FOREX": sources(spark)["FOREX"]}):
        assert W.load_full(house, one, list(one)).views.errors == {}
    assert house.fact.count() == 7 and house.fact.filter("volume_from is not null").count() == 2
    assert W.loaded_range(house) == W.date_range(house)


def test_a_new_symbol_with_a_stored_id_is_refused(spark, house, monkeypatch):
    W.load_symbols(house, {"STOCK": sources(spark)["STOCK"]})
    monkeypatch.setattr(dims.C, "symbol_id", lambda *_: F.lit(house.symbols.first().symbol_id))
    with pytest.raises(ValueError):
        W.load_symbols(house, {"FOREX": sources(spark)["FOREX"]})
    assert house.symbols.filter("asset_type_id = 2").count() == 0


def test_ledger(spark, tmp_path):
    book = ledger.Ledger(spark, f"{tmp_path}/l")
    fact = spark.createDataFrame([(date(2024, m, 1),) for m in (1, 2, 3, 3)], "trade_period date")
    found = lambda after, upto=None: sorted(r[0].month for r in book.periods(after, upto).collect())
    assert (book.last(), book.marks(), found(0)) == (0, {}, [])
    load = book.open(None)
    book.close(load, [date(2024, 1, 1), date(2024, 2, 1)])
    assert (book.last(), found(0), found(0, load - 1), found(load)) == (load, [1, 2], [], [])
    book.clear(["m"], load)
    assert not book.behind("m") and book.behind("other")
    book.open(date(2024, 2, 1))  # dies
    book.recover(fact)
    assert book.behind("m") and found(load) == [2, 3]
    upto = book.last()
    book.recover(fact)
    assert book.last() == upto
    empty = book.open(None)
    book.close(empty, [])
    assert book.last() == upto
