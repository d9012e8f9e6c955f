"""Continuous aggregates kept by refreshing a range of whole buckets."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlehouse.functions import columns as C
from candlehouse.functions.arguments import naive_utc
from candlehouse.operators.dedup import not_in
from candlehouse.operators.rollup import ROLLUP_KEY, bucket_rollup, stale_buckets
from candlehouse.plans.periods import PeriodTable
from candlehouse.plans.storage import periods_of
from candlehouse.schemas import FACT_SCHEMA
from candlehouse.sources.tables import PERIOD, between_periods, empty_table, periods_between

# Refresh range behind the current time, per bucket size.
REFRESH_RANGE = {
    "day": (timedelta(days=3), timedelta(hours=1)),
    "hour": (timedelta(days=1), timedelta(minutes=15)),
}
_BUCKET = {"day": timedelta(days=1), "hour": timedelta(hours=1)}
_EPOCH = datetime(1970, 1, 1)


def refresh_range(grain: str, as_of: datetime) -> tuple[datetime, datetime]:
    """The policy range shrunk to whole buckets: a bucket only partly inside is left alone."""
    start_offset, end_offset = REFRESH_RANGE[grain]
    size = _BUCKET[grain]
    start, end = naive_utc(as_of) - start_offset, naive_utc(as_of) - end_offset
    first = _EPOCH + -(-(start - _EPOCH) // size) * size
    last = _EPOCH + (end - _EPOCH) // size * size
    return first, last


def rollup_table(spark: SparkSession, path: str, table_grain: str = "month") -> PeriodTable:
    schema = bucket_rollup(empty_table(spark, FACT_SCHEMA), "day").schema
    return PeriodTable(spark, path, schema, "bucket", table_grain)


def build_rollup(fact: DataFrame, path: str, grain: str, table_grain: str = "month") -> None:
    """First run: every bucket of the fact table."""
    rollup_table(fact.sparkSession, path, table_grain).replace(bucket_rollup(fact, grain), ["bucket", *ROLLUP_KEY])


def refresh_rollup(
    fact: DataFrame,
    path: str,
    grain: str,
    start: datetime,
    end: datetime,
    table_grain: str = "month",
    fact_grain: str = "month",
) -> None:
    """Recompute the buckets of [start, end) from the fact table, leaving all others as stored, even
    where late rows have arrived for them. Only the touched periods are read and replaced."""
    if start >= end:
        return
    rows = fact.filter((F.col("ts") >= C.utc(start)) & (F.col("ts") < C.utc(end)))
    if PERIOD in fact.columns:
        rows = between_periods(rows, start, end, fact_grain)
    table = rollup_table(fact.sparkSession, path, table_grain)
    periods = periods_between(start, end, table_grain)
    stored = table.stored().filter(F.col(PERIOD).isin(periods)).drop(PERIOD)
    outside = stored.filter((F.col("bucket") < C.utc(start)) | (F.col("bucket") >= C.utc(end)))
    table.merge(bucket_rollup(rows, grain).unionByName(outside), ["bucket", *ROLLUP_KEY], periods)


def refresh_late(fact: DataFrame, path: str, grain: str, table_grain: str = "month", fact_grain: str = "month") -> int:
    """Recompute the buckets that late rows have left behind: rows behind a stream's watermark, or out of reach of the refreshes.

    They are found by their counts, which reads four columns of the facts; only the periods they lie in are read whole and replaced.
    Returns how many buckets were recomputed. Pass facts from some period on to look at these only.
    """
    key = ["bucket", *ROLLUP_KEY]
    table = rollup_table(fact.sparkSession, path, table_grain)
    table.finish(key)
    late = stale_buckets(table.read(), fact, grain).select(*key, "late_rows").persist()  # what memory can't hold goes to disk
    try:
        n = late.count()
        if not n:
            return 0
        rows = fact
        if PERIOD in fact.columns:
            rows = rows.filter(F.col(PERIOD).isin(periods_of(late, "bucket", fact_grain))).drop(PERIOD)
        rows = rows.withColumn("bucket", F.date_trunc(grain, "ts")).join(late.select(*key), key, "left_semi").drop("bucket")
        stored = table.stored().filter(F.col(PERIOD).isin(periods_of(late, "bucket", table_grain))).drop(PERIOD)
        table.merge(bucket_rollup(rows, grain).unionByName(not_in(stored, late, key)), key)
        return n
    finally:
        late.unpersist()
