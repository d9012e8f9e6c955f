"""Column expressions. All of them are built-in Spark expressions that stay in generated code."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlehouse.functions.arguments import naive_utc
from candlehouse.schemas import INTERVAL_MINUTES, PRICE

# A character that is neither white space nor any Unicode separator.
NON_BLANK = r"[^\s\x0B\x1C-\x1F\p{Z}]"

DAY_MICROS = 86_400_000_000


def utc(moment: datetime) -> Column:
    """Timestamp literal. Passing the datetime itself would read it in the zone of the Python process."""
    return F.lit(naive_utc(moment).isoformat(sep=" ")).cast("timestamp")


def moment_of(rows: DataFrame, value: Column) -> datetime | None:
    """An aggregated timestamp as naive UTC; None without rows."""
    return rows.agg(value.cast("timestamp_ntz")).first()[0]


def percent_change(start: Column, end: Column) -> Column:
    """(end - start) / start * 100 as double; NULL where ``start`` is zero or NULL.

    The difference is taken on the exact decimals, only the ratio in double.
    """
    return F.try_divide((end - start).cast("double"), start.cast("double")) * 100


def price_change(open_: Column, close: Column) -> Column:
    return F.when(open_ > 0, percent_change(open_, close)).otherwise(F.lit(0.0))


def volatility(high: Column, low: Column) -> Column:
    return F.coalesce(F.when(low > 0, percent_change(low, high)), F.lit(0.0))


def exact_mean(value: Column) -> Column:
    """Mean from an exact decimal sum, so that the result does not depend on the row order."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def exact_sum(value: Column) -> Column:
    """Sum of whole or decimal numbers (up to 10 places) that cannot overflow a long."""
    return F.sum(value.cast("decimal(38,10)"))


def symbol_id(asset_type_code: Column, symbol: Column, currency: Column) -> Column:
    """Surrogate key: the first 60 bits of the MD5 of the natural key.

    A function of the key alone, so loads need no id counter, no global ranking and no lookup join,
    and a re-run or a recomputed task always gives the same id. ``dims.check_unique`` guards collisions.
    """
    text = F.concat_ws("|", asset_type_code, symbol, F.coalesce(currency, F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def trade_period(ts: Column, grain: str = "month") -> Column:
    """Date of the storage partition a timestamp belongs to (grain: day, month or year)."""
    return F.to_date(F.date_trunc(grain, ts))


def bar_start(ts: Column, interval_code: Column) -> Column:
    """Start of the bar that holds ``ts``; an unknown interval counts as daily."""
    micros = F.unix_micros(ts)
    length = _bar_micros(interval_code)
    return F.timestamp_micros(micros - F.pmod(micros, length))


def bar_end(ts: Column, interval_code: Column) -> Column:
    """Last microsecond of the bar that holds ``ts``."""
    start = F.unix_micros(bar_start(ts, interval_code))
    return F.timestamp_micros(start + _bar_micros(interval_code) - 1)


def _bar_micros(interval_code: Column) -> Column:
    chain = F.when(F.lit(False), F.lit(0).cast("bigint"))
    for code, minutes in INTERVAL_MINUTES.items():
        chain = chain.when(interval_code == code, F.lit(minutes * 60_000_000).cast("bigint"))
    return chain.otherwise(F.lit(DAY_MICROS).cast("bigint"))


def is_intraday(interval_code: Column) -> Column:
    return interval_code.contains("min") | interval_code.contains("h")


def parse_bar_time(text: Column, interval_code: Column) -> Column:
    """Intraday bars carry a date and time, all others a plain date. NULL where the text does not fit."""
    return F.when(
        is_intraday(interval_code), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))
    ).otherwise(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")))


def parse_price(text: Column) -> Column:
    """Text to stored price by way of double; NULL where it is no finite number that fits."""
    return text.try_cast("double").try_cast(PRICE)


def parse_whole(text: Column) -> Column:
    """Text to bigint; a fraction is cut off."""
    return text.try_cast("decimal(38,10)").try_cast("bigint")


def not_blank(text: Column) -> Column:
    return F.coalesce(text.rlike(NON_BLANK), F.lit(False))
