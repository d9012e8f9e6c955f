"""Transformed bars to fact rows.

The interval lookup is a broadcast inner join against six fixed rows: a bar of an unknown interval
drops out. ``symbol_id`` is a function of the natural key, so the symbol lookup is a projection.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlehouse.functions import columns as C
from candlehouse.operators import dims
from candlehouse.schemas import ASSET_TYPE_ID, DAILY, FACT_COLUMNS, FACT_KEY, INTERVAL_ID

SYMBOL_COLUMN = {"STOCK": "symbol", "FOREX": "currency_pair", "CRYPTO": "symbol"}
SOURCE_TABLE = {
    "STOCK": "transformed_stock_data",
    "FOREX": "transformed_forex_data",
    "CRYPTO": "transformed_crypto_data",
}
# Measures that only some sources have, with the type of the empty column.
_OPTIONAL = {"volume": "bigint", "volume_from": "decimal(28,10)", "volume_to": "decimal(28,10)",
             "price_change": "double", "avg_price": "double"}


def fact_rows(bars: DataFrame, asset_type: str) -> DataFrame:
    """Fact rows of one asset type. Crypto bars carry no interval: they are daily by definition."""
    currency = F.col("currency") if "currency" in bars.columns else F.lit(None).cast("string")
    if asset_type == "CRYPTO":
        rows = bars.withColumn("interval_id", F.lit(INTERVAL_ID[DAILY]))
    else:
        intervals = dims.time_intervals(bars.sparkSession).select("interval_code", "interval_id")
        rows = bars.join(F.broadcast(intervals), "interval_code")
    rows = rows.withColumns({
        "symbol_id": C.symbol_id(F.lit(asset_type), F.col(SYMBOL_COLUMN[asset_type]), currency),
        "asset_type_id": F.lit(ASSET_TYPE_ID[asset_type]),
        "source_table": F.lit(SOURCE_TABLE[asset_type]),
    })
    return rows.select(*[_measure(rows, c) for c in FACT_COLUMNS])


def _measure(rows: DataFrame, column: str) -> Column:
    if column in rows.columns:
        return F.col(column)
    return F.lit(None).cast(_OPTIONAL[column]).alias(column)


def fact_union(transformed: dict[str, DataFrame]) -> DataFrame:
    """Fact rows of all given sources, by asset type code."""
    return reduce(DataFrame.unionByName, [fact_rows(bars, code) for code, bars in transformed.items()])


def finish(rows: DataFrame) -> DataFrame:
    """Columns the store fills in: a row id from the natural key, and the load time."""
    return rows.withColumns({"fact_id": F.xxhash64(*FACT_KEY), "loaded_at": F.current_timestamp()})
