"""Which symbols a backfill covers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP_N = 10


def top_by_volume(crypto_bars: DataFrame, n: int = TOP_N) -> DataFrame:
    """The ``n`` symbols with the largest total volume; equal volumes are ordered by symbol."""
    return (
        crypto_bars.groupBy("symbol")
        .agg(F.sum("volume_to").alias("total_volume"))
        .orderBy(F.desc("total_volume"), "symbol")
        .limit(n)
    )


def top_by_rows(bars: DataFrame, column: str, n: int = TOP_N) -> DataFrame:
    """The ``n`` symbols with the most bars; equal numbers are ordered by symbol."""
    return (bars.groupBy(F.col(column).alias("symbol")).agg(F.count("*").alias("bars"))
            .orderBy(F.desc("bars"), "symbol").limit(n))


def only(bars: DataFrame, column: str, symbols: list[str]) -> DataFrame:
    """Bars of a fixed symbol list; the list becomes a pushed-down IN filter."""
    return bars.filter(F.col(column).isin(symbols))
