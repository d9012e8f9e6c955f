"""Dimensions of the star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlehouse.functions import columns as C
from candlehouse.schemas import ASSET_TYPE_ID, ASSET_TYPES, TIME_INTERVALS


def _sql_value(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def _seed(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    values = ", ".join(f"({', '.join(_sql_value(v) for v in row)})" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS seed({columns})")


def asset_types(spark: SparkSession) -> DataFrame:
    """Three fixed rows."""
    return _seed(spark, ASSET_TYPES, "asset_type_id, asset_type_code, asset_type_name, description")


def time_intervals(spark: SparkSession) -> DataFrame:
    """Six fixed rows."""
    return _seed(spark, TIME_INTERVALS,
                 "interval_id, interval_code, interval_name, interval_minutes, description")


def symbols(bars: DataFrame, asset_type: str) -> DataFrame:
    """Distinct symbols of transformed bars as dimension rows.

    Crypto symbols are kept apart by currency: two quotes of one coin must not share an id.
    """
    code = "currency_pair" if "currency_pair" in bars.columns else "symbol"
    currency = F.col("currency") if asset_type == "CRYPTO" else F.lit(None).cast("string")
    found = bars.select(F.col(code).alias("symbol_code"), currency.alias("currency")).distinct()
    return found.select(
        C.symbol_id(F.lit(asset_type), F.col("symbol_code"), F.col("currency")).alias("symbol_id"),
        "symbol_code",
        F.lit(ASSET_TYPE_ID[asset_type]).alias("asset_type_id"),
        F.col("symbol_code").alias("symbol_name"),
        F.lit(None).cast("string").alias("exchange"),
        "currency",
        F.lit(True).alias("is_active"),
    )


def check_unique(dimension: DataFrame) -> None:
    """Raise if two natural keys share an id (60-bit ids: about 1 in a million for a million symbols)."""
    shared = dimension.groupBy("symbol_id").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
    if shared:
        raise ValueError("two symbols share one symbol_id")


def all_symbols(transformed: dict[str, DataFrame]) -> DataFrame:
    """Symbols of all given sources, by asset type code. Types are disjoint, so no rows coincide."""
    return reduce(DataFrame.unionByName, [symbols(bars, code) for code, bars in transformed.items()])
