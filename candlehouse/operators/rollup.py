"""Time-bucket rollup of the fact table, the base of the continuous aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlehouse.functions import columns as C

ROLLUP_KEY = ["symbol_id", "asset_type_id", "interval_id"]


def measures() -> list[Column]:
    return [
        F.min_by("open", "ts").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "ts").alias("close"),
        C.exact_sum(F.col("volume")).alias("volume"),
        C.exact_mean(F.col("close")).alias("avg_price"),
        F.count("*").alias("record_count"),
    ]


def bucket_rollup(fact: DataFrame, grain: str) -> DataFrame:
    """First open, high, low, last close, volume, mean close and count per ``grain`` (day or hour)."""
    return fact.groupBy(*ROLLUP_KEY, F.date_trunc(grain, "ts").alias("bucket")).agg(*measures())


def stale_buckets(stored: DataFrame, fact: DataFrame, grain: str) -> DataFrame:
    """Buckets whose stored count is behind the fact table: late rows that no refresh has reached."""
    key = [*ROLLUP_KEY, "bucket"]
    actual = fact.groupBy(*ROLLUP_KEY, F.date_trunc(grain, "ts").alias("bucket")).agg(
        F.count("*").alias("actual_count")
    )
    known = stored.select(*key, F.col("record_count").alias("stored_count"))
    both = actual.join(known, key, "left").withColumn("stored_count", F.coalesce("stored_count", F.lit(0)))
    return both.filter("actual_count > stored_count").withColumn(
        "late_rows", F.col("actual_count") - F.col("stored_count")
    )
