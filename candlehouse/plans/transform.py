"""Raw tables to transformed tables. A run adds what the transformed table lacks, so it can be repeated."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from candlehouse.functions import columns as C
from candlehouse.operators.dedup import not_in
from candlehouse.operators.transform import CRYPTO_DAY_KEY, transform_crypto, transform_forex, transform_stock
from candlehouse.plans.periods import PeriodTable
from candlehouse.plans.storage import compared_periods, insert_ignore
from candlehouse.schemas import RAW_KEY, TRANSFORMED_SCHEMA
from candlehouse.sources.tables import PERIOD, conform, period_start

TRANSFORM: dict[str, Callable[[DataFrame], DataFrame]] = {"STOCK": transform_stock, "FOREX": transform_forex}


def store_bars(raw: DataFrame, path: str, asset_type: str, source: DataFrame | None = None) -> int:
    """Transform the raw stock or forex bars that have no transformed bar yet; all symbols in one job.

    Only the periods of the raw bars are compared. They are asked of ``source``, if given: a table in the same periods that is cheaper to read.
    """
    periods = compared_periods(raw if source is None else source, path)
    return insert_ignore(TRANSFORM[asset_type](raw), path, RAW_KEY[asset_type], periods=periods,
                         schema=TRANSFORMED_SCHEMA[asset_type])["inserted"]


def crypto_days(raw: DataFrame, path: str) -> PeriodTable:
    return PeriodTable(raw.sparkSession, path, TRANSFORMED_SCHEMA["CRYPTO"], "ts")


def store_crypto_days(raw: DataFrame, path: str, replace_from: datetime | None = None) -> int:
    """Add the crypto days that are missing. Returns how many days were computed.

    A day that was transformed while still incomplete stays as it is, unless ``replace_from`` (a midnight)
    asks for the days from then on to be computed again; a stored day without raw bars stays too.
    """
    table, days = crypto_days(raw, path), transform_crypto(raw)
    table.finish(CRYPTO_DAY_KEY)
    replaced = 0
    if replace_from is not None:
        observed = Observation()
        again = days.filter(F.col("ts") >= C.utc(replace_from)).observe(observed, F.count("*").alias("n"))
        days = days.filter(F.col("ts") < C.utc(replace_from))
        stored = table.stored().filter(F.col(PERIOD) >= F.lit(period_start(replace_from))).drop(PERIOD)
        again = conform(again, TRANSFORMED_SCHEMA["CRYPTO"])
        table.merge(again.unionByName(not_in(stored, again, CRYPTO_DAY_KEY)), CRYPTO_DAY_KEY)
        replaced = observed.get["n"]
    added = insert_ignore(days, path, CRYPTO_DAY_KEY, periods=compared_periods(raw, path), schema=TRANSFORMED_SCHEMA["CRYPTO"])
    return replaced + added["inserted"]
