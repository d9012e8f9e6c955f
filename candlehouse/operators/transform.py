"""Raw bars and articles to transformed ones."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlehouse.functions import columns as C
from candlehouse.operators.dedup import not_in

CRYPTO_DAY_KEY = ["symbol", "currency", "ts"]


def transform_stock(raw: DataFrame) -> DataFrame:
    return raw.select(
        "symbol", "interval_code", "ts", "open", "high", "low", "close", "volume",
        C.price_change(F.col("open"), F.col("close")).alias("price_change"),
    )


def transform_forex(raw: DataFrame) -> DataFrame:
    return raw.select(
        "currency_pair", "interval_code", "ts", "open", "high", "low", "close",
        C.price_change(F.col("open"), F.col("close")).alias("price_change"),
    )


def crypto_day_rows(raw: DataFrame, *day: Column) -> DataFrame:
    """Crypto bars by symbol, currency and whatever tells the day: a column of the time, or its window in a stream."""
    return raw.groupBy("symbol", "currency", *day).agg(
        F.min("open").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max("close").alias("close"),
        F.sum("volume_from").alias("volume_from"),
        F.sum("volume_to").alias("volume_to"),
        (C.exact_mean(F.col("high") + F.col("low")) / 2).alias("avg_price"),
    ).withColumn("price_change", C.percent_change(F.col("open"), F.col("close")))


def transform_crypto(
    raw: DataFrame, done: DataFrame | None = None, replace_from: date | None = None
) -> DataFrame:
    """Crypto bars to one row per symbol, currency and day.

    Days present in ``done`` are skipped, except from ``replace_from`` on, which recomputes them. The
    anti join comes after the aggregation: it then meets one row per key, however many raw rows a key has,
    and reuses the partitioning of the aggregation.
    """
    day = F.date_trunc("day", "ts")
    if replace_from is not None and done is not None:
        done = done.filter(F.col("ts") < F.lit(replace_from))
    days = crypto_day_rows(raw, day.alias("ts"))
    return days if done is None else not_in(days, done, CRYPTO_DAY_KEY)


def pending(raw: DataFrame, transformed: DataFrame, key: list[str]) -> DataFrame:
    """Raw bars that have no transformed bar yet."""
    return not_in(raw, transformed, key)


def pending_keys(raw: DataFrame, transformed: DataFrame, key: list[str]) -> DataFrame:
    """Sorted (symbol, interval) pairs that still have bars to transform.

    Keys are made distinct first: copies of one key then never meet in the join, which reuses the
    partitioning of the distinct.
    """
    pair = key[:2]
    return pending(raw.select(*key).distinct(), transformed, key).select(*pair).distinct().orderBy(*pair)


def transform_news(articles: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Articles with a title, a description and a content that are not blank, in the published form."""
    kept = articles
    for column in ("title", "description", "content"):
        kept = kept.filter(C.not_blank(F.col(column)))
    return kept.select(*(keep or []), "title", "published_date", "description", "content")
