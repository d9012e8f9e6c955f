"""Stored tables: explicit schema, partition pruning on ``trade_period``."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from candlehouse.functions import columns as C
from candlehouse.functions.arguments import naive_utc

PERIOD = "trade_period"


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists, on whatever file system it names."""
    fs, hadoop_path = _hadoop(spark, path)
    return fs.exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job has made for itself."""
    fs, hadoop_path = _hadoop(spark, path)
    fs.delete(hadoop_path, True)


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, in a form the optimizer knows to be empty: joins with it fold away."""
    nothing = spark.sql("SELECT 1 WHERE false")
    return nothing.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A stored table. With a schema, a table that does not exist yet reads as empty."""
    if schema is None:
        return spark.read.parquet(path)
    if not table_exists(spark, path):
        return empty_table(spark, schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def conform(rows: DataFrame, schema: StructType) -> DataFrame:
    """``rows`` with exactly the columns and types of a stored table; a column that is not there is NULL.

    A value that does not fit its type is an error, not a NULL.
    """
    return rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def with_period(schema: StructType) -> StructType:
    fields = [f for f in schema.fields if f.name != PERIOD]
    return StructType([*fields, StructField(PERIOD, DateType())])


def period_start(moment: datetime, grain: str = "month") -> date:
    """The ``trade_period`` value of a moment."""
    day = naive_utc(moment).date()
    return {"day": day, "month": day.replace(day=1), "year": day.replace(month=1, day=1)}[grain]


def periods_between(start: datetime, end: datetime, grain: str = "month") -> list[date]:
    """The periods that hold any moment of [start, end)."""
    out, at, last = [], period_start(start, grain), period_start(end - timedelta(microseconds=1), grain)
    while at <= last:
        out.append(at)
        at = period_start(datetime.combine(at, datetime.min.time()) + {
            "day": timedelta(days=1), "month": timedelta(days=32), "year": timedelta(days=367)}[grain], grain)
    return out


def between_periods(
    table: DataFrame, start: datetime, end: datetime | None = None, grain: str = "month"
) -> DataFrame:
    """Partitions that hold any moment of [start, end)."""
    rows = table.filter(F.col(PERIOD) >= F.lit(period_start(start, grain)))
    if end is None:
        return rows
    return rows.filter(F.col(PERIOD) <= F.lit(period_start(end - timedelta(microseconds=1), grain)))


def since(table: DataFrame, moment: datetime, grain: str = "month") -> DataFrame:
    """Rows strictly after ``moment``.

    A predicate on the timestamp alone prunes no directory, so the partition predicate is added.
    """
    rows = table.filter(F.col("ts") > C.utc(moment))
    if PERIOD in table.columns:
        rows = rows.filter(F.col(PERIOD) >= F.lit(period_start(moment, grain)))
    return rows
