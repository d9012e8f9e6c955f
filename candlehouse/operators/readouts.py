"""Result shapes for readers: price history, lookups and warehouse statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlehouse.functions import columns as C
from candlehouse.functions.arguments import positive
from candlehouse.operators import dims
from candlehouse.schemas import DAILY, INDEX_ETF


def last_n(bars: DataFrame, key: list[str], n: int) -> DataFrame:
    """The newest ``n`` bars per key, with rank ``rn``.

    Cut per key and month first, so the final window of a hot symbol meets at most ``n`` rows a month.
    """
    newest = F.col("ts").desc()
    monthly = Window.partitionBy(*key, F.date_trunc("month", "ts")).orderBy(newest)
    overall = Window.partitionBy(*key).orderBy(newest)
    cut = bars.withColumn("rn", F.row_number().over(monthly)).filter(F.col("rn") <= n)
    return cut.withColumn("rn", F.row_number().over(overall)).filter(F.col("rn") <= n)


def price_history(bars: DataFrame, symbol: str, days: int = 30) -> DataFrame:
    """The newest ``days`` daily bars of every symbol, crypto symbols by currency. ``symbol`` names the key column.

    Bars without an interval, as crypto days are, are daily. ``arguments.check_days`` has the limit for requests.
    """
    n = positive("days", days)
    daily = bars.filter(F.col("interval_code") == DAILY) if "interval_code" in bars.columns else bars
    key = [symbol] + [c for c in ("currency",) if c in bars.columns]
    picked = last_n(daily, key, n)

    def optional(name: str, kind: str) -> Column:
        return (F.col(name) if name in bars.columns else F.lit(None).cast(kind)).alias(name)

    return picked.select(
        F.col(symbol).alias("symbol"), optional("currency", "string"), F.lit(DAILY).alias("interval_code"), F.lit(n).alias("days"),
        F.count("*").over(Window.partitionBy(*key)).alias("count"),
        "rn", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date"), "open", "high", "low", "close",
        optional("volume", "bigint"), optional("volume_from", "decimal(28,10)"), optional("volume_to", "decimal(28,10)"),
    )


def index_daily(bars: DataFrame, days: int = 30, symbol: str = INDEX_ETF) -> DataFrame:
    """The newest ``days`` daily bars of the index ETF (``arguments.check_days`` has the limit for requests)."""
    n = positive("days", days)
    daily = bars.filter((F.col("interval_code") == DAILY) & (F.col("symbol") == symbol))
    return daily.orderBy(F.desc("ts")).limit(n).select(
        "symbol", F.lit(DAILY).alias("interval_code"), F.lit(n).alias("days"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date"), "open", "high", "low", "close", "volume",
    ).orderBy(F.desc("date"))


def price_by_date(bars: DataFrame, requests: DataFrame) -> DataFrame:
    """Close of the newest bar up to the end of the requested day, for every request.

    ``requests`` holds symbol, currency and date. Bars and requests are both reduced to one row per
    symbol, currency and day before the ordered pass, so a group is bounded by the calendar. No bar
    before the day gives a NULL close; a request whose date is missing or no date is dropped.
    """
    key = ["symbol", "currency"]
    closes = bars.groupBy(*key, F.to_date("ts").alias("date")).agg(F.max_by("close", "ts").alias("close"))
    wanted = requests.select(*key, F.col("date").try_cast("date").alias("date")).dropna().distinct()
    timeline = closes.withColumn("wanted", F.lit(False)).unionByName(
        wanted.withColumn("wanted", F.lit(True)), allowMissingColumns=True
    )
    days = timeline.groupBy(*key, "date").agg(F.max("close").alias("close"), F.max("wanted").alias("wanted"))
    so_far = Window.partitionBy(*key).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    priced = days.withColumn("close", F.last("close", ignorenulls=True).over(so_far))
    return priced.filter("wanted").drop("wanted")


def warehouse_statistics(fact: DataFrame, symbols: DataFrame) -> DataFrame:
    """Rows, active symbols and time range per asset type, and for all of them (``ALL``)."""
    types = F.broadcast(dims.asset_types(fact.sparkSession).select("asset_type_id", "asset_type_code"))
    rows = fact.groupBy("asset_type_id").agg(
        F.count("*").alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi")
    )
    active = symbols.filter("is_active").groupBy("asset_type_id").agg(F.count("*").alias("active"))
    joined = rows.join(active, "asset_type_id", "full").join(types, "asset_type_id")
    return joined.rollup("asset_type_code").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("record_count"),
        F.coalesce(F.sum("active"), F.lit(0)).alias("active_symbols"),
        F.min("lo").alias("earliest"),
        F.max("hi").alias("latest"),
    ).withColumn("asset_type_code", F.coalesce("asset_type_code", F.lit("ALL")))


def date_range(fact: DataFrame) -> DataFrame:
    """First and last time as text; NULL on an empty fact table."""
    return range_of(fact, "ts", "ts")


def range_of(rows: DataFrame, first: str, last: str) -> DataFrame:
    pattern = "yyyy-MM-dd HH:mm:ss"
    return rows.agg(
        F.date_format(F.min(first), pattern).alias("earliest"),
        F.date_format(F.max(last), pattern).alias("latest"),
    )


def link_counts(articles: DataFrame) -> DataFrame:
    return articles.groupBy("link").agg(F.count("*").alias("articles"))
