import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from candlehouse.operators import dedup
from candlehouse.plans.storage import append_new, insert_ignore, periods_of

KEY = ["symbol", "ts"]


def skewed(spark, n=3000):
    """A third of the rows share one key."""
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        hot = rng.random() < 1 / 3
        ts = start if hot else start + timedelta(days=rng.randrange(90))
        rows.append(("HOT" if hot else f"S{rng.randrange(40)}", ts, rng.randrange(1000), i))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "symbol string, ts timestamp, close int, src_id bigint").repartition(6)


def expected(rows):
    best = {}
    for row in rows:
        if row[:2] not in best or row[3] < best[row[:2]][3]:
            best[row[:2]] = row
    return sorted(best.values())


@pytest.mark.parametrize("keep", [dedup.first_wins, dedup.first_wins_wide])
def test_smallest_order_wins_under_skew(spark, keep):
    rows, frame = skewed(spark)
    assert sorted(tuple(r) for r in keep(frame, KEY, "src_id").select("symbol", "ts", "close", "src_id").collect()) == expected(rows)


def test_ties_of_the_order_fall_to_other_columns(spark):
    frame = spark.createDataFrame([("A", 1, 1, 9), ("A", 1, 1, 4), ("A", 2, 0, 0)], "k string, o1 int, o2 int, v int")
    assert [tuple(r) for r in dedup.first_of_ordered(frame, ["k"], ["o1", "o2"]).collect()] == [("A", 1, 1, 4)]


def test_null_values_survive(spark):
    frame = spark.createDataFrame([("A", None, 1), ("A", 5, 2)], "k string, v int, src_id bigint")
    assert [tuple(r) for r in dedup.first_wins(frame, ["k"], "src_id").collect()] == [("A", None, 1)]


def test_dedup_aggregates_before_the_shuffle(spark):
    _, frame = skewed(spark, 50)
    plan = dedup.first_wins(frame, KEY, "src_id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "SortAggregate" not in plan and "Window" not in plan


def test_wide_dedup_spreads_copies_of_a_key(spark):
    _, frame = skewed(spark, 50)
    plan = dedup.first_wins_wide(frame, KEY, "src_id")._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "[symbol#" in plan and "Window" not in plan


def test_tied_rows_are_never_mixed_and_never_depend_on_their_order(spark):
    rows = [("A", 1, i, 100 - i) for i in range(40)] + [("B", 2, None, 3), ("B", 2, 4, None)]
    kept = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, "k string, o bigint, x int, y int").repartition(seed + 1)
        kept.add(tuple(sorted(tuple(r) for r in dedup.first_wins(frame, ["k"], "o").collect())))
    assert len(kept) == 1
    assert all(x is None or y is None or x + y == 100 for _, _, x, y in next(iter(kept)))


def test_a_key_with_null_is_stored_once(spark, tmp_path):
    rows = spark.createDataFrame([(None, "2024-01-01", 1), ("A", "2024-01-01", 2)], "symbol string, d string, close int").selectExpr(
        "symbol", "cast(d as timestamp) as ts", "close")
    assert [insert_ignore(rows, f"{tmp_path}/t", KEY)["inserted"] for _ in range(2)] == [2, 0]


def test_only_the_given_periods_are_compared(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.createDataFrame([("A", datetime(2024, m, 1), m) for m in (1, 2, 6)], "symbol string, ts timestamp, close int")
    insert_ignore(rows, path, KEY)
    delta = rows.filter("close in (1, 6)")
    assert periods_of(delta) == [date(2024, 1, 1), date(2024, 6, 1)]
    assert insert_ignore(delta, path, KEY, periods=periods_of(delta))["inserted"] == 0


def test_loads_with_other_types_share_a_declared_schema(spark, tmp_path):
    schema = spark.createDataFrame([], "symbol string, ts timestamp, close decimal(28,10)").schema
    path = f"{tmp_path}/t"
    for i, kind in enumerate(("decimal(12,2)", "decimal(20,6)", "double", "int")):
        rows = spark.createDataFrame([("A", datetime(2024, 1, 1 + i))], "symbol string, ts timestamp").withColumn("close", F.lit(5).cast(kind))
        assert insert_ignore(rows, path, KEY, schema=schema)["inserted"] == 1
    assert spark.read.parquet(path).filter("close = 5").count() == 4


@pytest.mark.parametrize("grain", ["day", "month", "year"])
def test_insert_ignore_again_adds_nothing(spark, tmp_path, grain):
    rows, frame = skewed(spark)
    path = f"{tmp_path}/t"
    for n in (len(expected(rows)), 0):
        delta = dedup.first_wins(frame, KEY, "src_id")
        assert insert_ignore(delta, path, KEY, grain, periods=periods_of(frame, grain=grain))["inserted"] == n
    assert spark.read.parquet(path).count() == len(expected(rows))


def test_known_rows_stay_as_they_are(spark, tmp_path):
    path = f"{tmp_path}/t"
    schema = "symbol string, ts timestamp, close int"
    old = spark.createDataFrame([("A", datetime(2024, 1, 1), 1)], schema)
    new = spark.createDataFrame([("A", datetime(2024, 1, 1), 2), ("A", datetime(2024, 2, 1), 3)], schema)
    counts = [F.count_if(F.col("close") == 3).alias("threes")]
    insert_ignore(old, path, KEY)
    assert insert_ignore(new, path, KEY, counts=counts) == {"inserted": 1, "threes": 1}
    assert sorted(r.close for r in spark.read.parquet(path).collect()) == [1, 3]


def test_insert_of_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.createDataFrame([("A", datetime(2024, 1, 1), 1)], "symbol string, ts timestamp, close int")
    assert insert_ignore(rows.limit(0), path, KEY)["inserted"] == 0
    assert insert_ignore(rows, path, KEY)["inserted"] == 1
    assert insert_ignore(rows.filter("close > 5"), path, KEY, periods=[])["inserted"] == 0


def test_only_periods_of_the_delta_are_read(spark, tmp_path):
    path = f"{tmp_path}/t"
    _, frame = skewed(spark)
    insert_ignore(dedup.first_wins(frame, KEY, "src_id"), path, KEY)
    march = spark.read.parquet(path).filter(F.col("trade_period") >= F.lit(datetime(2024, 3, 1)).cast("date"))
    plan = march.select(*KEY)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_period" in plan


def test_ledger(spark, tmp_path):
    links = spark.createDataFrame([("a",), ("b",)], "link string")
    assert append_new(links, f"{tmp_path}/l", ["link"]) == 2
    assert append_new(links.union(spark.createDataFrame([("c",)], "link string")), f"{tmp_path}/l", ["link"]) == 1


def test_a_hot_period_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 200_000, numPartitions=8).select(
        F.col("id").cast("string").alias("symbol"),
        F.when(F.col("id") % 3 > 0, F.lit("2024-01-05")).otherwise(F.lit("2024-02-05")).cast("timestamp").alias("ts"),
        F.xxhash64("id").alias("close"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        assert insert_ignore(rows, f"{tmp_path}/t", KEY)["inserted"] == 200_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    january = [f for f in spark.read.parquet(f"{tmp_path}/t").inputFiles() if "2024-01-01" in f]
    assert len(january) > 3
