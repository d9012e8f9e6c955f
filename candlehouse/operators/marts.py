"""Rollups of the fact table and the analytic views over them.

Every mart aggregates on the compact fact keys first and looks codes up afterwards, so the joins meet
one row per group instead of one per bar. Asset types and intervals are fixed seeds and broadcast. The
symbol dimension grows with the data and carries no hint: adaptive execution broadcasts it when its
measured size allows and otherwise runs a sort-merge join with skew splitting.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlehouse.functions import columns as C
from candlehouse.operators import dims


class Star(NamedTuple):
    """A fact table with its symbol dimension."""

    fact: DataFrame
    symbols: DataFrame

    @property
    def spark(self) -> SparkSession:
        return self.fact.sparkSession


def _with_codes(rollup: DataFrame, star: Star) -> DataFrame:
    coded = rollup.join(star.symbols.select("symbol_id", "symbol_code", "currency", "exchange"), "symbol_id")
    if "asset_type_id" in rollup.columns:
        types = dims.asset_types(star.spark).select("asset_type_id", "asset_type_code")
        coded = coded.join(F.broadcast(types), "asset_type_id")
    if "interval_id" in rollup.columns:
        intervals = dims.time_intervals(star.spark).select("interval_id", "interval_code")
        coded = coded.join(F.broadcast(intervals), "interval_id")
    return coded


DAY_KEY = ["symbol_id", "asset_type_id", "interval_id"]


def day_rollup(fact: DataFrame) -> DataFrame:
    """Per symbol, interval and day: the measures of the daily mart and, in a form that can be merged,
    those of the all-time marts. A load changes the days it touches only, so all marts but the hourly
    one are refreshed from this table instead of the fact table."""
    close = F.col("close")
    return fact.groupBy(*DAY_KEY, F.date_trunc("day", "ts").alias("trading_day")).agg(
        F.count("*").alias("record_count"),
        F.min("open").alias("day_open"),
        F.max("high").alias("day_high"),
        F.min("low").alias("day_low"),
        F.max("close").alias("day_close"),
        C.exact_sum(F.col("volume")).alias("total_volume"),
        F.count(close).alias("n_close"),
        F.sum(close).alias("sum_close"),
        (F.var_pop(close.cast("double")) * F.count(close)).alias("squares"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_updated"),
    )


def daily_of(days: DataFrame, symbols: DataFrame) -> DataFrame:
    mean = F.try_divide(F.col("sum_close").cast("double"), F.col("n_close"))
    return _with_codes(days, Star(days, symbols)).select(
        "symbol_id", "symbol_code", "asset_type_code", "currency", "interval_code", "trading_day",
        "record_count", "day_open", "day_high", "day_low", "day_close", "total_volume",
        mean.alias("avg_close_price"), "last_updated",
    )


def daily(star: Star) -> DataFrame:
    """Per day: the smallest open and the largest close stand for the day's open and close."""
    return daily_of(day_rollup(star.fact), star.symbols)


def hourly(star: Star) -> DataFrame:
    """Per hour: first open and last close by time."""
    rollup = star.fact.groupBy(
        "symbol_id", "asset_type_id", "interval_id", F.date_trunc("hour", "ts").alias("trading_hour")
    ).agg(
        F.count("*").alias("record_count"),
        F.min_by("open", "ts").alias("hour_open"),
        F.max("high").alias("hour_high"),
        F.min("low").alias("hour_low"),
        F.max_by("close", "ts").alias("hour_close"),
        C.exact_sum(F.col("volume")).alias("total_volume"),
        C.exact_mean(F.col("close")).alias("avg_close_price"),
    )
    return _with_codes(rollup, star).select(
        "symbol_id", "symbol_code", "asset_type_code", "currency", "interval_code", "trading_hour",
        "record_count", "hour_open", "hour_high", "hour_low", "hour_close", "total_volume",
        "avg_close_price",
    )


def _asset_types(per_symbol: DataFrame) -> DataFrame:
    rollup = per_symbol.groupBy("asset_type_id").agg(
        F.count("*").alias("unique_symbols"),
        F.sum("n").alias("total_records"),
        F.min("lo").alias("earliest_data"),
        F.max("hi").alias("latest_data"),
    )
    types = dims.asset_types(per_symbol.sparkSession).select("asset_type_id", "asset_type_code", "asset_type_name")
    return rollup.join(F.broadcast(types), "asset_type_id").select(
        "asset_type_code", "asset_type_name", "unique_symbols", "total_records",
        "earliest_data", "latest_data",
    )


def asset_type(star: Star) -> DataFrame:
    """Per asset type: distinct symbols, rows and time range.

    Rolled up per symbol first, so that one dominant asset type is not counted in one task.
    """
    return _asset_types(star.fact.groupBy("asset_type_id", "symbol_id").agg(
        F.count("*").alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi")))


def asset_type_of(days: DataFrame) -> DataFrame:
    """The same from the day rollup."""
    return _asset_types(days.groupBy("asset_type_id", "symbol_id").agg(
        F.sum("record_count").alias("n"), F.min("first_ts").alias("lo"), F.max("last_updated").alias("hi")))


def _symbols(rollup: DataFrame, star: Star) -> DataFrame:
    return _with_codes(rollup, star).select(
        "symbol_id", "symbol_code", "asset_type_code", "currency", "exchange", "total_records",
        "first_record_date", "last_record_date", "avg_price", "price_volatility", "all_time_low",
        "all_time_high", "total_volume_traded",
    )


def symbol(star: Star) -> DataFrame:
    """Per symbol over all time; the volatility of a single row is NULL."""
    rollup = star.fact.groupBy("symbol_id", "asset_type_id").agg(
        F.count("*").alias("total_records"),
        F.min("ts").alias("first_record_date"),
        F.max("ts").alias("last_record_date"),
        C.exact_mean(F.col("close")).alias("avg_price"),
        F.stddev_samp(F.col("close").cast("double")).alias("price_volatility"),
        F.min("low").alias("all_time_low"),
        F.max("high").alias("all_time_high"),
        C.exact_sum(F.col("volume")).alias("total_volume_traded"),
    )
    return _symbols(rollup, star)


def symbol_of(days: DataFrame, symbols: DataFrame) -> DataFrame:
    """The same from the stored day rollup. The variance is merged from the days: squares within the days
    plus those between their means. The totals have one row per symbol, and adaptive execution
    broadcasts them if they are small."""
    totals = days.groupBy("symbol_id").agg(
        F.try_divide(F.sum("sum_close").cast("double"), F.sum("n_close")).alias("mean"))
    gap = F.try_divide(F.col("sum_close").cast("double"), F.col("n_close")) - F.col("mean")
    n = F.sum("n_close")
    rollup = days.join(totals, "symbol_id").groupBy("symbol_id", "asset_type_id").agg(
        F.sum("record_count").alias("total_records"),
        F.min("first_ts").alias("first_record_date"),
        F.max("last_updated").alias("last_record_date"),
        F.try_divide(F.sum("sum_close").cast("double"), n).alias("avg_price"),
        F.sqrt(F.try_divide(F.sum(F.col("squares") + F.col("n_close") * gap * gap), n - 1)).alias("price_volatility"),
        F.min("day_low").alias("all_time_low"),
        F.max("day_high").alias("all_time_high"),
        F.sum("total_volume").alias("total_volume_traded"),
    )
    return _symbols(rollup, Star(days, symbols))


def _or_zero(value: str | Column) -> Column:
    return F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(0))


def _bucket_view(mart: DataFrame, bucket: str, prefix: str) -> DataFrame:
    volume = F.col("total_volume")
    high, low = F.col(f"{prefix}_high"), F.col(f"{prefix}_low")
    return mart.select(
        "symbol_id", "interval_code", F.col(bucket).alias("bucket"),
        _or_zero("total_volume").alias("total_volume"),
        _or_zero(F.try_divide(volume.cast("double"), F.col("record_count"))).alias("avg_volume"),
        _or_zero("total_volume").alias("max_volume"),
        F.lit(0).alias("min_volume"),
        _or_zero(f"{prefix}_open").alias("first_open"),
        _or_zero(f"{prefix}_close").alias("last_close"),
        _or_zero(high).alias("max_high"),
        _or_zero(low).alias("min_low"),
        _or_zero("avg_close_price").alias("avg_close"),
        C.volatility(high, low).alias("volatility"),
        _or_zero("record_count").alias("record_count"),
    )


def day_view(daily_mart: DataFrame) -> DataFrame:
    return _bucket_view(daily_mart, "trading_day", "day")


def hour_view(hourly_mart: DataFrame) -> DataFrame:
    return _bucket_view(hourly_mart, "trading_hour", "hour")


def week_view(daily_mart: DataFrame) -> DataFrame:
    """Weeks start on Monday. Reads the daily mart, never the fact table."""
    weeks = daily_mart.groupBy(
        "symbol_id", "interval_code", F.date_trunc("week", "trading_day").alias("bucket")
    ).agg(
        F.sum("total_volume").alias("total_volume"),
        C.exact_mean(F.col("total_volume")).alias("avg_volume"),
        F.max("total_volume").alias("max_volume"),
        F.min("total_volume").alias("min_volume"),
        F.min("day_open").alias("first_open"),
        F.max("day_close").alias("last_close"),
        F.max("day_high").alias("max_high"),
        F.min("day_low").alias("min_low"),
        F.avg("avg_close_price").alias("avg_close"),
        F.sum("record_count").alias("record_count"),
    )
    measures = [c for c in weeks.columns if c not in ("symbol_id", "interval_code", "bucket")]
    return weeks.select(
        "symbol_id", "interval_code", "bucket", *[_or_zero(c).alias(c) for c in measures],
        C.volatility(F.col("max_high"), F.col("min_low")).alias("volatility"),
    )
