"""Writing tables. All writes go through Spark's file committer, so a lost executor costs a task retry
and a job that dies leaves nothing behind. One writer per table at a time.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlehouse.functions import columns as C
from candlehouse.operators.dedup import not_in
from candlehouse.sources.tables import PERIOD, conform, read_table, table_exists, with_period


def write_partitioned(
    rows: DataFrame, path: str, sort: list[str], mode: str = "append", counts: list[Column] | None = None
) -> dict:
    """Write rows that carry ``trade_period``, one directory per period, and return observed counts.

    REBALANCE gathers a period into few files and splits a period that is too large for one task. The
    sort gives tight row-group ranges. Counts are observed behind the shuffle, in the writing stage.
    """
    rows = rows.hint("rebalance", F.col(PERIOD))
    observed = Observation()
    if counts:
        rows = rows.observe(observed, *counts)
    (
        rows.sortWithinPartitions(PERIOD, *sort)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PERIOD)
        .parquet(path)
    )
    return observed.get if counts else {}


def periods_of(rows: DataFrame, time: str = "ts", grain: str = "month") -> list[date]:
    """The periods the rows lie in, one value per period. Ask a source table, not a derived one: this is a pass over it."""
    found = rows.select(C.trade_period(F.col(time), grain).alias(PERIOD)).distinct().collect()  # bounded by the calendar
    return sorted(r[PERIOD] for r in found if r[PERIOD] is not None)


def compared_periods(rows: DataFrame, path: str) -> list[date] | None:
    """The periods of ``rows`` for :func:`insert_ignore`; None, without a pass over them, where there is no table yet to compare with."""
    return periods_of(rows) if table_exists(rows.sparkSession, path) else None


def insert_ignore(
    rows: DataFrame,
    path: str,
    key: list[str],
    grain: str = "month",
    time: str = "ts",
    periods: list[date] | None = None,
    counts: list[Column] | None = None,
    schema: StructType | None = None,
    first: date | None = None,
) -> dict:
    """Append the rows whose key the table does not hold yet; returns ``inserted`` and other counts.

    Rows must be unique by key (``operators.dedup``) and the key must contain ``time``, so equal keys
    share a period. ``schema`` is the declared schema of the table (default: the rows' own). ``periods`` are the periods of
    the rows, or ``first`` the first of them, where the caller knows: only these partitions of the table are
    then compared, and only their key columns are read.
    """
    counts = [F.count("*").alias("inserted"), *(counts or [])]
    delta = (rows if schema is None else conform(rows, schema)).withColumn(PERIOD, C.trade_period(F.col(time), grain))
    known = read_table(rows.sparkSession, path, with_period(delta.schema))
    if periods is not None:
        known = known.filter(F.col(PERIOD).isin(periods)) if periods else known.limit(0)
    if first is not None:
        known = known.filter(F.col(PERIOD) >= F.lit(first))
    return write_partitioned(not_in(delta, known, key), path, key, counts=counts)


def append_new(rows: DataFrame, path: str, key: list[str]) -> int:
    """Insert-ignore into a table without time partitions, such as a dimension or a ledger."""
    spark = rows.sparkSession
    known = read_table(spark, path, rows.schema)
    observed = Observation()
    new = not_in(rows, known, key).select(*rows.columns).observe(observed, F.count("*").alias("inserted"))
    new.write.mode("append").parquet(path)
    return observed.get["inserted"]
