import math
import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import bars as B
from candlehouse.operators import marts
from candlehouse.workload.tables import MarketTables


def test_single_row_has_no_volatility(spark):
    star = B.star({"STOCK": B.stock(spark, B.stock_row())})
    for mart in (marts.symbol(star), marts.symbol_of(marts.day_rollup(star.fact), star.symbols)):
        row = mart.first()
        assert row.price_volatility is None and row.avg_price == 11.0


def test_merged_deviation_equals_the_plain_one(spark):
    rng = random.Random(5)
    start = datetime(2020, 1, 1)
    closes = [(start + timedelta(days=i, hours=i % 5), round(1e5 + rng.gauss(0, 3), 2)) for i in range(900)]
    rows = [B.stock_row(ts=str(t), close=c) for t, c in closes]
    star = B.star({"STOCK": B.stock(spark, *rows)})
    merged = marts.symbol_of(marts.day_rollup(star.fact), star.symbols).first()
    assert math.isclose(merged.price_volatility, statistics.stdev(c for _, c in closes), rel_tol=1e-9)
    plain = marts.symbol(star).first()
    assert [merged[c] for c in merged.asDict() if c != "price_volatility"] == [
        plain[c] for c in plain.asDict() if c != "price_volatility"]
    types = [m.first() for m in (marts.asset_type(star), marts.asset_type_of(marts.day_rollup(star.fact)))]
    assert types[0] == types[1] and types[0].total_records == 900


def test_missing_volume(spark):
    daily = marts.daily(B.star({"FOREX": B.forex(spark, ("EUR/USD", "2024-01-15"))}))
    assert daily.first().total_volume is None
    view = marts.day_view(daily).first()
    assert (view.total_volume, view.avg_volume, view.max_volume, view.min_volume) == (0, 0, 0, 0)


def test_low_of_zero_has_no_volatility(spark):
    daily = marts.daily(B.star({"STOCK": B.stock(spark, B.stock_row(low=0))}))
    assert marts.day_view(daily).first().volatility == 0.0
    assert marts.week_view(daily).first().volatility == 0.0


def test_hour_takes_first_open_and_last_close_by_time(spark):
    rows = [B.stock_row(ts="2024-01-15 09:50:00", open_=3, close=4), B.stock_row(ts="2024-01-15 09:10:00", open_=9, close=8),
            B.stock_row(ts="2024-01-15 09:59:59", open_=5, close=1)]
    row = marts.hourly(B.star({"STOCK": B.stock(spark, *rows)})).first()
    assert (row.hour_open, row.hour_close, row.record_count) == (9, 1, 3)


def test_week_starts_on_monday(spark):
    rows = [B.stock_row(ts=f"2024-01-{day} 12:00:00") for day in (14, 15, 21, 22)]
    weeks = marts.week_view(marts.daily(B.star({"STOCK": B.stock(spark, *rows)}))).orderBy("bucket").collect()
    assert [(w.bucket.day, w.record_count) for w in weeks] == [(8, 1), (15, 2), (22, 1)]


def test_daily_mart_is_the_rollup_of_the_hourly_mart(spark, sf_dir):
    star = MarketTables(spark, sf_dir).star
    key = ["symbol_id", "interval_code"]
    of_hours = marts.hourly(star).groupBy(*key, F.date_trunc("day", "trading_hour").alias("trading_day")).agg(
        F.sum("record_count").alias("record_count"), F.max("hour_high").alias("day_high"),
        F.min("hour_low").alias("day_low"), F.sum("total_volume").cast("bigint").alias("total_volume"))
    daily = marts.daily(star).withColumn("total_volume", F.col("total_volume").cast("bigint")).select(of_hours.columns)
    assert daily.exceptAll(of_hours).count() == 0 and of_hours.exceptAll(daily).count() == 0


@pytest.mark.parametrize("mart", [marts.daily, marts.hourly, marts.symbol, marts.asset_type])
def test_plans_pre_aggregate_and_join_late(spark, sf_dir, mart):
    plan = mart(MarketTables(spark, sf_dir).star)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("SortAggregate", "CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF"):
        assert unwanted not in plan
    assert "partial_" in plan
