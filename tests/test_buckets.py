import re

import pytest
from pyspark.sql import functions as F

from candlehouse.plans.buckets import BucketTable
from candlehouse.schemas import _fields

SCHEMA = _fields("symbol string, ts timestamp, close decimal(28,10)")


def rows(spark, *values):
    return spark.createDataFrame(list(values), "symbol string, ts string, close int, extra string")


def table(spark, path, name="bucketed_bars"):
    return BucketTable(spark, name, str(path), SCHEMA, ["symbol", "ts"], 6)


@pytest.fixture
def bars(spark, tmp_path):
    found = table(spark, tmp_path / "bars")
    yield found
    spark.sql(f"DROP TABLE IF EXISTS {found.name}")


def test_known_keys_are_left_alone(spark, bars):
    first, second = ("A", "2024-01-01 00:00:00", 1, "x"), ("B", "2024-01-01 00:00:00", 2, "x")
    assert bars.insert_ignore(rows(spark, first)) == 1
    assert bars.insert_ignore(rows(spark, ("A", "2024-01-01 00:00:00", 9, "y"), second)) == 1
    assert bars.insert_ignore(rows(spark, first, second)) == 0
    assert bars.insert_ignore(rows(spark, first).limit(0)) == 0
    assert sorted((r.symbol, int(r.close)) for r in bars.read().collect()) == [("A", 1), ("B", 2)]
    assert bars.read().columns == SCHEMA.names


def test_a_null_key_is_an_error_and_stores_nothing(spark, bars):
    bars.create()
    with pytest.raises(Exception, match="null in the key column symbol"):
        bars.insert_ignore(rows(spark, (None, "2024-01-01 00:00:00", 1, "x"), ("A", "2024-01-01 00:00:00", 1, "x")))
    assert bars.read().count() == 0


def test_the_stored_side_is_not_shuffled(spark, bars):
    many = spark.range(2000).select(F.concat(F.lit("S"), F.col("id") % 50).alias("symbol"), F.timestamp_seconds("id").alias("ts"), F.lit(1).alias("close"))
    assert bars.insert_ignore(many) == 2000
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = bars.missing(many.limit(100))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"Exchange hashpartitioning\(symbol", plan)) == 1  # the delta's
    assert "SelectedBucketsCount: 6 out of 6" in plan and "Bucketed: true" in plan
    scan = re.search(r"ReadSchema: struct<([^>]*)>", plan)
    assert scan[1] == "symbol:string,ts:timestamp"
