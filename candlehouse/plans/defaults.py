"""Catalog tables whose columns have defaults, and inserts that leave these columns out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def create(spark: SparkSession, table: str, schema: StructType, defaults: dict[str, str], path: str) -> None:
    """A Parquet table at ``path``. ``defaults`` has the SQL of a column's default, such as ``true`` or ``current_timestamp()``; the others have NULL."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "")
                        for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet LOCATION '{path}'")


def insert(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Append ``rows``, matched by name; columns that they lack get their defaults, stored with the row."""
    rows.createOrReplaceTempView("_rows_to_insert")
    names = ", ".join(f"`{c}`" for c in rows.columns)
    spark.sql(f"INSERT INTO {table} ({names}) SELECT {names} FROM _rows_to_insert")
    spark.catalog.dropTempView("_rows_to_insert")
