"""One query per operator. Each takes (spark, sf_dir) and returns a DataFrame with plain column types."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlehouse.functions import columns as C
from candlehouse.functions.arguments import parse_asset_types
from candlehouse.operators import dedup, dims, facts, marts, readouts, rollup, transform
from candlehouse.plans import backfill, continuous, defaults, ingest, news, storage, warehouse
from candlehouse.plans import transform as transforms
from candlehouse.plans.buckets import BucketTable
from candlehouse.plans.periods import PeriodTable
from candlehouse.schemas import (
    CRYPTO_KEY, DIM_SYMBOL_SCHEMA, FACT_COLUMNS, FOREX_KEY, INTERVAL_ID, RAW_KEY, RAW_SCHEMA, REJECT_SCHEMA, STOCK_KEY, TRANSFORMED_SCHEMA,
)
from candlehouse.session import scratch_path
from candlehouse.sources import payloads as P
from candlehouse.sources import universe
from candlehouse.sources.tables import read_table
from candlehouse.streaming import jobs
from candlehouse.workload.tables import MarketTables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(rows: DataFrame) -> DataFrame:
    """Decimals as double, whole numbers as bigint, timestamps without zone (they are UTC)."""
    target = {T.IntegerType: "bigint", T.ShortType: "bigint", T.TimestampType: "timestamp_ntz"}
    columns = []
    for field in rows.schema.fields:
        kind = "double" if isinstance(field.dataType, T.DecimalType) else target.get(type(field.dataType))
        columns.append(F.col(field.name).cast(kind) if kind else F.col(field.name))
    return rows.select(*[c.alias(n) for c, n in zip(columns, rows.columns)])


def query(build: Callable[[MarketTables], DataFrame]) -> Callable[[MarketTables], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: plain(build(MarketTables(spark, sf_dir)))
    return build


# --- sources ---------------------------------------------------------------------------------------


@query
def ingest_stock(m: MarketTables) -> DataFrame:
    return P.valid(P.parse_stock(m.stock_payloads)).drop("page", "pos")


@query
def ingest_forex(m: MarketTables) -> DataFrame:
    return P.valid(P.parse_forex(m.forex_payloads)).drop("page", "pos")


@query
def ingest_crypto(m: MarketTables) -> DataFrame:
    return P.valid(P.parse_crypto(m.crypto_payloads)).drop("page", "pos")


def _in_range(m: MarketTables, asset_type: str, payloads: DataFrame, start: str, end: str) -> DataFrame:
    """Bars of a date-range backfill, and its rejects: refused pages count with their reason."""
    parsed = backfill.parse_range(payloads, asset_type, start, end)
    column = facts.SYMBOL_COLUMN[asset_type]
    shape = ["page", "pos", F.col(column).alias("symbol"), "ts", "open", "high", "low", "close", "reason"]
    return parsed.select(*shape)


@query
def ingest_range(m: MarketTables) -> DataFrame:
    """Whole stock pages: one with a bad bar is refused, and says so."""
    return _in_range(m, "STOCK", m.stock_payloads, "2024-01-10", "2024-01-19")


@query
def ingest_range_forex(m: MarketTables) -> DataFrame:
    return _in_range(m, "FOREX", m.forex_payloads, "1996-01-01", "1997-12-31")


@query
def ingest_range_crypto(m: MarketTables) -> DataFrame:
    """Crypto pages keep their good rows."""
    return _in_range(m, "CRYPTO", m.crypto_payloads, "1996-01-01", "1997-12-31")


@query
def ingest_news(m: MarketTables) -> DataFrame:
    articles = P.valid(P.parse_news(m.news_payloads))
    return articles.select("link", "title", "published_date", "description", "content", "transformed")


def _stored_once(m: MarketTables, rows: DataFrame) -> DataFrame:
    """Rows as they lie in the landing zone or in a table, for jobs that read them more than once."""
    path = scratch_path(m.spark, "landing")
    rows.write.option("compression", "zstd").parquet(path)
    return read_table(m.spark, path, rows.schema)


@query
def ingest_rejects(m: MarketTables) -> DataFrame:
    """The reject table after two ingests of all pages, bars and news."""
    root = scratch_path(m.spark, "rejects")
    store = news.NewsStore(m.spark, f"{root}/news")
    landed = {"STOCK": m.stock_payloads, "FOREX": m.forex_payloads, "CRYPTO": m.crypto_payloads, "NEWS": m.news_payloads}
    landed = {code: _stored_once(m, pages) for code, pages in landed.items()}
    pages = {"STOCK": P.parse_stock(landed["STOCK"]), "FOREX": P.parse_forex(landed["FOREX"]), "CRYPTO": P.parse_crypto(landed["CRYPTO"])}
    for _ in range(2):
        for code, parsed in pages.items():
            ingest.ingest_bars(parsed, code, f"{root}/raw_{code}", store.reject_path)
        news.ingest_news(store, landed["NEWS"])
    return read_table(m.spark, store.reject_path, REJECT_SCHEMA)


def _ingested(m: MarketTables, code: str, parsed: DataFrame) -> DataFrame:
    path = scratch_path(m.spark, f"raw_{code}")
    ingest.ingest_bars(parsed, code, path, f"{path}_rejects")
    return read_table(m.spark, path, RAW_SCHEMA[code]).drop("sys_timestamp")


@query
def ingest_store(m: MarketTables) -> DataFrame:
    """Land stock pages as numbered lines of text files, then ingest them into the raw table; the result is that table."""
    landing = scratch_path(m.spark, "landing")
    line = F.concat(F.col("page").cast("string"), F.lit("\t"), F.col("payload")).alias("value")
    m.stock_payloads.select("symbol", "interval_code", line).write.partitionBy("symbol", "interval_code").text(landing)
    landed = P.read_landed(m.spark, landing, ["symbol", "interval_code"], numbered_lines=True)
    return _ingested(m, "STOCK", P.parse_stock(landed))


@query
def ingest_store_forex(m: MarketTables) -> DataFrame:
    return _ingested(m, "FOREX", P.parse_forex(m.forex_payloads))


@query
def ingest_store_crypto(m: MarketTables) -> DataFrame:
    return _ingested(m, "CRYPTO", P.parse_crypto(m.crypto_payloads))


@query
def payload_history(m: MarketTables) -> DataFrame:
    """Chart points of every page, with volume."""
    return P.price_points(m.stock_payloads, include_volume=True).drop("pos", "page")


@query
def price_history_crypto(m: MarketTables) -> DataFrame:
    return P.crypto_price_points(m.crypto_payloads).drop("page", "pos")


@query
def kline_bounds(m: MarketTables) -> DataFrame:
    interval = F.col("interval_code")
    return m.landed_stock.select(
        "src_id", "interval_code", "ts", C.bar_start(F.col("ts"), interval).alias("start_date_time"),
        C.bar_end(F.col("ts"), interval).alias("end_date_time"),
    )


@query
def top_symbols(m: MarketTables) -> DataFrame:
    return universe.top_by_volume(m.landed_crypto)


@query
def ranked_names(m: MarketTables) -> DataFrame:
    """Coins of the ranking payload, in rank order."""
    return P.ranked_names(m.ranking_payload)


@query
def backfill_top(m: MarketTables) -> DataFrame:
    """Backfill the most quoted stocks and pairs and the ranked coins, all their pages; the rows of the raw tables."""
    root = scratch_path(m.spark, "backfill")
    jobs_ = {
        "STOCK": (m.stock_payloads, universe.top_by_rows(m.landed_stock, "symbol")),
        "FOREX": (m.forex_payloads, universe.top_by_rows(m.landed_forex, "currency_pair")),
        "CRYPTO": (m.crypto_payloads, P.ranked_names(m.ranking_payload).select("symbol")),
    }
    out = []
    for code, (pages, symbols) in jobs_.items():
        backfill.backfill(pages, code, f"{root}/{code}", f"{root}/rejects", symbols)
        raw = read_table(m.spark, f"{root}/{code}", RAW_SCHEMA[code])
        out.append(raw.select(F.lit(code).alias("asset_type_code"), F.col(facts.SYMBOL_COLUMN[code]).alias("symbol"),
                              *[F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in ("currency", "interval_code")],
                              "ts", "open", "high", "low", "close"))
    return out[0].unionByName(out[1]).unionByName(out[2])


# --- insert-ignore ---------------------------------------------------------------------------------


def _two_overlapping_loads(landed: DataFrame, key: list[str], split: datetime, overlap: timedelta) -> DataFrame:
    """Load the rows before ``split``, then those from ``split - overlap`` on."""
    path = scratch_path(landed.sparkSession, "raw")
    early, late = landed.filter(F.col("ts") < C.utc(split)), landed.filter(F.col("ts") >= C.utc(split - overlap))
    for batch in (early, late):
        storage.insert_ignore(
            dedup.first_wins(batch, key, "src_id"), path, key, periods=storage.periods_of(batch))
    return landed.sparkSession.read.parquet(path).drop("trade_period")


@query
def insert_ignore_raw(m: MarketTables) -> DataFrame:
    return _two_overlapping_loads(m.landed_forex, FOREX_KEY, datetime(1998, 1, 1), timedelta(days=365))


@query
def insert_ignore_stock(m: MarketTables) -> DataFrame:
    return _two_overlapping_loads(m.landed_stock, STOCK_KEY, datetime(2024, 1, 20), timedelta(days=5))


@query
def insert_ignore_bucketed(m: MarketTables) -> DataFrame:
    """Two overlapping loads into a table bucketed by its key, whose stored rows are not shuffled."""
    name = scratch_path(m.spark, "bucketed").rsplit("/", 1)[1].replace("-", "_")
    table = BucketTable(m.spark, name, scratch_path(m.spark, "bucketed_rows"), m.landed_stock.schema, STOCK_KEY)
    for part in (F.col("ts") < C.utc(datetime(2024, 1, 20)), F.col("ts") >= C.utc(datetime(2024, 1, 15))):
        table.insert_ignore(dedup.first_wins(m.landed_stock.filter(part), STOCK_KEY, "src_id"))
    return table.read()


@query
def insert_ignore_crypto(m: MarketTables) -> DataFrame:
    """Two overlapping loads: the second finds a year of keys stored."""
    order = ["l_orderkey", "l_linenumber", "open", "high", "low", "close", "volume_from", "volume_to"]
    path, split, overlap = scratch_path(m.spark, "raw_crypto"), datetime(1996, 1, 1), timedelta(days=365)
    for batch in (m.raw_crypto.filter(F.col("ts") < C.utc(split)), m.raw_crypto.filter(F.col("ts") >= C.utc(split - overlap))):
        storage.insert_ignore(dedup.first_of_ordered(batch, CRYPTO_KEY, order), path, CRYPTO_KEY, periods=storage.periods_of(batch))
    return m.spark.read.parquet(path).drop("trade_period")


# --- transforms ------------------------------------------------------------------------------------


@query
def transform_stock(m: MarketTables) -> DataFrame:
    return m.transformed["STOCK"]


@query
def transform_forex(m: MarketTables) -> DataFrame:
    return m.transformed["FOREX"]


@query
def transform_crypto(m: MarketTables) -> DataFrame:
    return m.transformed["CRYPTO"]


@query
def transform_crypto_pending(m: MarketTables) -> DataFrame:
    """Only the days that an earlier run, over the bars before 1998, has not produced."""
    done = transform.transform_crypto(m.landed_crypto.filter("ts < '1998-01-01'"))
    return transform.transform_crypto(m.landed_crypto, done)


@query
def transform_store_stock(m: MarketTables) -> DataFrame:
    """The stored table after a run over the bars of three weeks and a run over all bars."""
    path = scratch_path(m.spark, "transformed_stock_data")
    for raw in (m.raw_stock.filter("ts < '2024-01-22'"), m.raw_stock):
        transforms.store_bars(raw, path, "STOCK")
    return read_table(m.spark, path, TRANSFORMED_SCHEMA["STOCK"])


@query
def transform_store_forex(m: MarketTables) -> DataFrame:
    """The stored table after a run over the pairs before 1996 and a run over all."""
    path = scratch_path(m.spark, "transformed_forex_data")
    for raw in (m.raw_forex.filter("ts < '1996-01-01'"), m.raw_forex):
        transforms.store_bars(raw, path, "FOREX")
    return read_table(m.spark, path, TRANSFORMED_SCHEMA["FOREX"])


@query
def transform_store_crypto(m: MarketTables) -> DataFrame:
    """The stored table after a first run that saw small lots only, from 2000 on, and a run that
    computes the days since 1999 again."""
    path = scratch_path(m.spark, "transformed_crypto_data")
    transforms.store_crypto_days(m.raw_crypto.filter("ts >= '2000-01-01' and volume_from < 10"), path)
    transforms.store_crypto_days(m.raw_crypto, path, datetime(1999, 1, 1))
    return transforms.crypto_days(m.raw_crypto, path).read()


@query
def pending_keys(m: MarketTables) -> DataFrame:
    """Daily stock bars and forex bars before 2000 have been transformed already."""
    stock = transform.pending_keys(m.landed_stock, m.landed_stock.filter("interval_code = '1day'"), STOCK_KEY)
    forex = transform.pending_keys(m.landed_forex, m.landed_forex.filter("ts < '2000-01-01'"), FOREX_KEY)
    found = stock.unionByName(forex.withColumnRenamed("currency_pair", "symbol")).orderBy("symbol", "interval_code")
    rows = [(i, r.symbol, r.interval_code) for i, r in enumerate(found.collect(), 1)]  # symbols times intervals
    return m.spark.createDataFrame(rows, "position bigint, symbol string, interval_code string")


# --- news ------------------------------------------------------------------------------------------

_NEWS_COLUMNS = ["link", "title", "published_date", "description", "content"]


@query
def dedup_news(m: MarketTables) -> DataFrame:
    return m.raw_news.select("src_id", *_NEWS_COLUMNS)


@query
def news_link_counts(m: MarketTables) -> DataFrame:
    return readouts.link_counts(m.landed_news.select("link"))


@query
def transform_news(m: MarketTables) -> DataFrame:
    return transform.transform_news(m.raw_news, keep=["link"])


@query
def news_all(m: MarketTables) -> DataFrame:
    """Two fetch-and-transform rounds over landed pages, the second with all of them, then all published articles."""
    store = news.NewsStore(m.spark, scratch_path(m.spark, "news"))
    for batch in (m.news_payloads.filter("page < 5"), m.news_payloads):
        news.news_round(store, batch)
    return store.published()


# --- dimensions and facts --------------------------------------------------------------------------


@query
def dim_seed(m: MarketTables) -> DataFrame:
    """Every seeded interval with the number of landed stock bars that use it."""
    used = m.landed_stock.groupBy("interval_code").agg(F.count("*").alias("bars"))
    seeds = dims.time_intervals(m.spark).join(used, "interval_code", "left")
    return seeds.select("interval_id", "interval_code", "interval_name", "interval_minutes",
                        F.coalesce("bars", F.lit(0)).alias("bars"))


def _new_warehouse(m: MarketTables) -> warehouse.Warehouse:
    return warehouse.Warehouse(m.spark, scratch_path(m.spark, "warehouse"))


@query
def dim_symbol_load(m: MarketTables) -> DataFrame:
    """Two dimension loads; the second finds the symbols of the first present."""
    w = _new_warehouse(m)
    landed = {"STOCK": m.landed_stock, "FOREX": m.landed_forex, "CRYPTO": m.landed_crypto}
    warehouse.load_symbols(w, {"STOCK": m.landed_stock})
    warehouse.load_symbols(w, landed)
    return w.symbols


@query
def fact_load_stock(m: MarketTables) -> DataFrame:
    return facts.fact_rows(m.transformed["STOCK"], "STOCK")


@query
def fact_load_forex(m: MarketTables) -> DataFrame:
    return facts.fact_rows(m.transformed["FOREX"], "FOREX")


@query
def fact_load_crypto(m: MarketTables) -> DataFrame:
    return facts.fact_rows(m.transformed["CRYPTO"], "CRYPTO")


@query
def fact_union(m: MarketTables) -> DataFrame:
    return m.fact


@query
def full_load(m: MarketTables) -> DataFrame:
    """Load everything twice: the second load finds nothing new."""
    w = _new_warehouse(m)
    warehouse.load_full(w, m.stored)
    warehouse.load_full(w, m.stored)
    return w.fact.select(*FACT_COLUMNS)


@query
def load_by_type(m: MarketTables) -> DataFrame:
    """Three loads of one asset type each, from parsed payloads."""
    w = _new_warehouse(m)
    parsed = {"STOCK": P.parse_stock(m.stock_payloads), "CRYPTO": P.parse_crypto(m.crypto_payloads), "FOREX": P.parse_forex(m.forex_payloads)}
    for code, rows in parsed.items():
        good = P.valid(rows)
        if code == "CRYPTO":
            bars = transform.transform_crypto(good)
        else:
            bars = transforms.TRANSFORM[code](ingest.arrival(good, RAW_KEY[code]))
        warehouse.load_full(w, {code: _stored_once(m, bars)}, [code])
    return w.fact.select(*FACT_COLUMNS)


@query
def refresh_after_gap(m: MarketTables) -> DataFrame:
    """The daily mart after a full load, an append that no refresh followed, and an incremental load."""
    w, as_of = _new_warehouse(m), _newest(m.landed_stock)
    middle, late = C.utc(as_of - timedelta(days=12)), C.utc(as_of - timedelta(days=2))
    bars = m.stored
    warehouse.load_full(w, {code: b.filter(F.col("ts") < middle) for code, b in bars.items()})
    between = {code: b.filter((F.col("ts") >= middle) & (F.col("ts") < late)) for code, b in bars.items()}
    warehouse.load_symbols(w, between)
    warehouse.append_facts(w, between)
    report = warehouse.load_incremental(w, bars, as_of, hours_back=72)
    assert not report.views.errors, report.views.errors
    return w.mart("mv_daily_ohlc_summary").read()


@query
def load_selected(m: MarketTables) -> DataFrame:
    w = _new_warehouse(m)
    warehouse.load_full(w, m.stored, parse_asset_types(" stock, ,Foo,crypto"))
    return w.fact.select(*FACT_COLUMNS)


def _newest(bars: DataFrame) -> datetime:
    return C.moment_of(bars, F.max("ts"))


def _two_step_load(m: MarketTables) -> tuple[warehouse.Warehouse, warehouse.LoadReport]:
    """A full load of everything older than 100 hours, then the last 168 hours on top."""
    w, as_of = _new_warehouse(m), _newest(m.landed_stock)
    split = C.utc(as_of - timedelta(hours=100))
    warehouse.load_full(w, {code: bars.filter(F.col("ts") <= split) for code, bars in m.stored.items()})
    return w, warehouse.load_incremental(w, m.stored, as_of, hours_back=168)


@query
def incremental_load(m: MarketTables) -> DataFrame:
    w, _ = _two_step_load(m)
    return w.fact.select(*FACT_COLUMNS)


@query
def incremental_symbol(m: MarketTables) -> DataFrame:
    """The symbol mart after an incremental load, which reads the touched months only."""
    w, _ = _two_step_load(m)
    mart = w.mart("mv_symbol_analytics").read()
    return mart.withColumn("price_volatility", F.round("price_volatility", 4))


@query
def incremental_daily(m: MarketTables) -> DataFrame:
    """The daily mart after an incremental load, which rewrites the touched months only."""
    w, _ = _two_step_load(m)
    return w.mart("mv_daily_ohlc_summary").read()


@query
def lookback(m: MarketTables) -> DataFrame:
    """Rows of the last 24 hours per asset type, loaded into an empty warehouse."""
    w = _new_warehouse(m)
    warehouse.load_incremental(w, m.stored, _newest(m.landed_stock), hours_back=24)
    return w.fact.select(*FACT_COLUMNS)


@query
def load_report(m: MarketTables) -> DataFrame:
    """Report of a full load and of its repetition."""
    w, rows = _new_warehouse(m), []
    for run in (1, 2):
        report = warehouse.load_full(w, m.stored)
        rows += [(run, report.load_type, code, n, report.total, *report.date_range) for code, n in report.counts.items()]
    return m.spark.createDataFrame(
        rows, "run int, load_type string, asset_type_code string, records_loaded bigint,"
        "total_records_loaded bigint, earliest string, latest string")


@query
def refresh_marts(m: MarketTables) -> DataFrame:
    """Load, publish all marts plus one that fails, and report with the rows each view now shows."""
    w = _new_warehouse(m)
    warehouse.load_symbols(w, m.stored)
    warehouse.append_facts(w, m.stored)

    def failing(run: warehouse.Refresh, name: str) -> PeriodTable:
        return run.whole(name, lambda: run.warehouse.fact.select("no_such_column"), [])

    report = warehouse.refresh_marts(w, steps={**warehouse.MART_REFRESH, "mv_failing": failing})
    rows = [(name, "refreshed", m.spark.table(name).count()) for name in report.refreshed]
    rows += [(name, "error", None) for name in report.errors]
    return m.spark.createDataFrame(
        [(*row, report.processed, len(report.refreshed), len(report.errors)) for row in rows],
        "view_name string, status string, rows bigint, views_processed int, views_refreshed int,"
        "views_with_errors int",
    )


# --- marts and views -------------------------------------------------------------------------------


@query
def mv_daily(m: MarketTables) -> DataFrame:
    return marts.daily(m.star)


@query
def mv_hourly(m: MarketTables) -> DataFrame:
    return marts.hourly(m.star)


@query
def mv_asset_type(m: MarketTables) -> DataFrame:
    return marts.asset_type(m.star)


@query
def mv_symbol(m: MarketTables) -> DataFrame:
    """Rounded: the last bits of a standard deviation depend on the row order."""
    return marts.symbol(m.star).withColumn("price_volatility", F.round("price_volatility", 4))


def _analytic(m: MarketTables, name: str) -> DataFrame:
    """An analytic view over the stored mart, which the first such query brings up to date."""
    mart = warehouse.ANALYTIC_VIEWS[name][0]
    run = warehouse.Refresh(m.house)
    warehouse.MART_REFRESH[mart](run, mart)
    run.close()
    return warehouse.analytic_view(m.house, name)


@query
def ohlc_1day(m: MarketTables) -> DataFrame:
    return _analytic(m, "ohlc_1day")


@query
def ohlc_1hour(m: MarketTables) -> DataFrame:
    return _analytic(m, "ohlc_1hour")


@query
def ohlc_7day(m: MarketTables) -> DataFrame:
    """Rounded: a mean of daily means depends in its last bits on the row order."""
    return _analytic(m, "ohlc_7day").withColumn("avg_close", F.round("avg_close", 6))


# --- continuous aggregates -------------------------------------------------------------------------


@query
def cagg_daily(m: MarketTables) -> DataFrame:
    return rollup.bucket_rollup(m.house.fact, "day")


@query
def cagg_hourly(m: MarketTables) -> DataFrame:
    return rollup.bucket_rollup(m.house.fact, "hour")


def _refreshed(m: MarketTables, grain: str) -> tuple[str, DataFrame]:
    """Build a rollup before the minute bars arrive, then refresh the policy range with them."""
    w, path, as_of = _new_warehouse(m), scratch_path(m.spark, f"cagg_{grain}"), _newest(m.landed_stock)
    early = {c: t if c == "CRYPTO" else t.filter("interval_code <> '1min'") for c, t in m.stored.items()}
    warehouse.append_facts(w, early)
    continuous.build_rollup(w.fact, path, grain)
    warehouse.append_facts(w, {"STOCK": m.stored["STOCK"].filter("interval_code = '1min'")})
    assert w.fact.filter(F.col("interval_id") == INTERVAL_ID["1min"]).limit(1).count() == 1
    continuous.refresh_rollup(w.fact, path, grain, *continuous.refresh_range(grain, as_of))
    return path, w.fact


@query
def cagg_daily_refresh(m: MarketTables) -> DataFrame:
    path, _ = _refreshed(m, "day")
    return continuous.rollup_table(m.spark, path).read()


@query
def cagg_hourly_refresh(m: MarketTables) -> DataFrame:
    path, _ = _refreshed(m, "hour")
    return continuous.rollup_table(m.spark, path).read()


@query
def late_rows(m: MarketTables) -> DataFrame:
    """Buckets whose late rows no refresh has reached."""
    path, fact = _refreshed(m, "day")
    return rollup.stale_buckets(continuous.rollup_table(m.spark, path).read(), fact, "day")


@query
def stream_dedup(m: MarketTables) -> DataFrame:
    """Stream the bars into a raw table, then the same bars once more."""
    raw = scratch_path(m.spark, "raw_stream")
    for _ in range(2):
        checkpoint = scratch_path(m.spark, "checkpoint")
        jobs.stream_insert_ignore(m.event_stream(), raw, checkpoint, STOCK_KEY, "src_id").awaitTermination()
    return m.spark.read.parquet(raw).drop("trade_period")


@query
def stream_dedup_state(m: MarketTables) -> DataFrame:
    """Bars by thirds of January in files, each third sent again with the next one and the first once more at the end:
    copies in another batch within the watermark, and far behind it. What is sent at a time makes one batch, in however many files."""
    raw, landing, checkpoint = (scratch_path(m.spark, name) for name in ("raw_stream", "landing", "checkpoint"))
    day, bars = F.dayofmonth("ts"), _stored_once(m, m.raw_stock)
    thirds = [bars.filter(day <= 10), bars.filter((day > 10) & (day <= 20)), bars.filter(day > 20)]
    for sent in (thirds[:1], thirds[:2], thirds[1:], thirds[:1] + thirds[2:]):
        reduce(DataFrame.unionByName, sent).write.mode("append").parquet(landing)
        stream = m.spark.readStream.schema(bars.schema).parquet(landing)
        jobs.stream_insert_new(stream, raw, checkpoint, STOCK_KEY).awaitTermination()
    return m.spark.read.parquet(raw).drop("trade_period")


@query
def stream_cagg_open(m: MarketTables) -> DataFrame:
    """The day rollup of streamed stock and forex bars with the buckets that are still open."""
    w, path = _new_warehouse(m), scratch_path(m.spark, "open_rollup")
    for code, stream, key in (("STOCK", m.event_stream(), STOCK_KEY), ("FOREX", m.order_stream(), FOREX_KEY)):
        jobs.stream_load(code, stream, w, scratch_path(m.spark, "checkpoint"), key, "src_id").awaitTermination()
    stream = jobs.read_fact_stream(m.spark, w.fact_path, w.fact.schema)
    jobs.stream_open_rollup(stream, "day", path, scratch_path(m.spark, "checkpoint")).awaitTermination()
    return continuous.rollup_table(m.spark, path).read()


@query
def stream_cagg_late(m: MarketTables) -> DataFrame:
    """The day rollup of streamed stock bars whose first half comes last, far behind the watermark, after the late buckets were recomputed."""
    w, path, checkpoint = _new_warehouse(m), scratch_path(m.spark, "late_rollup"), scratch_path(m.spark, "checkpoint")
    middle = datetime(2024, 1, 15)
    for half in (F.col("ts") >= C.utc(middle), F.col("ts") < C.utc(middle)):
        warehouse.append_facts(w, {"STOCK": m.stored["STOCK"].filter(half)})
        stream = jobs.read_fact_stream(m.spark, w.fact_path, w.fact.schema)
        jobs.stream_open_rollup(stream, "day", path, checkpoint).awaitTermination()
    continuous.refresh_late(w.fact, path, "day")
    return continuous.rollup_table(m.spark, path).read()


#: The files of the lots are in no order of time: no day is closed before all of them are read.
WHOLE_HISTORY = "10000 days"


@query
def stream_transform_crypto(m: MarketTables) -> DataFrame:
    """Crypto days of streamed bars, the open ones included."""
    path = scratch_path(m.spark, "crypto_days")
    jobs.stream_crypto_days(m.lineitem_stream(), path, scratch_path(m.spark, "checkpoint"), WHOLE_HISTORY).awaitTermination()
    return transforms.crypto_days(m.raw_crypto, path).read()


@query
def stream_full_load(m: MarketTables) -> DataFrame:
    """All three asset types through streams into one fact table."""
    w, path = _new_warehouse(m), scratch_path(m.spark, "crypto_days")
    for code, stream, key in (("STOCK", m.event_stream(), STOCK_KEY), ("FOREX", m.order_stream(), FOREX_KEY)):
        jobs.stream_load(code, stream, w, scratch_path(m.spark, "checkpoint"), key, "src_id").awaitTermination()
    jobs.stream_crypto_days(m.lineitem_stream(), path, scratch_path(m.spark, "checkpoint"), WHOLE_HISTORY).awaitTermination()
    days = {"CRYPTO": transforms.crypto_days(m.raw_crypto, path).read()}
    warehouse.load_symbols(w, days)
    warehouse.append_facts(w, days)
    return w.fact.select(*FACT_COLUMNS)


def _streamed_pages(m: MarketTables) -> str:
    """Land all stock pages as files in two goes, the later pages second, each followed by a run of the stream."""
    root = scratch_path(m.spark, "stream_ingest")
    line = F.concat(F.col("page").cast("string"), F.lit("\t"), F.col("payload")).alias("value")
    middle = m.stock_payloads.agg(F.avg("page")).first()[0]
    for part in (F.col("page") < middle, F.col("page") >= middle):
        (m.stock_payloads.filter(part).select("symbol", "interval_code", line)
         .write.mode("append").partitionBy("symbol", "interval_code").text(f"{root}/landing"))
        pages = P.stream_landed(m.spark, f"{root}/landing", ["symbol", "interval_code"], numbered_lines=True, files_per_batch=None)
        jobs.stream_ingest(pages, "STOCK", f"{root}/raw", f"{root}/rejects", f"{root}/checkpoint").awaitTermination()
    return root


@query
def stream_ingest(m: MarketTables) -> DataFrame:
    """The raw table after landed stock pages came as a stream."""
    return read_table(m.spark, f"{_streamed_pages(m)}/raw", RAW_SCHEMA["STOCK"]).drop("sys_timestamp")


@query
def stream_ingest_rejects(m: MarketTables) -> DataFrame:
    """The rejects of the same stream."""
    return read_table(m.spark, f"{_streamed_pages(m)}/rejects", REJECT_SCHEMA)


@query
def defaults_stored(m: MarketTables) -> DataFrame:
    """Symbols inserted without the columns that have defaults, into a table that declares these."""
    w = _new_warehouse(m)
    warehouse.load_symbols(w, {"STOCK": m.landed_stock, "FOREX": m.landed_forex})
    table = scratch_path(m.spark, "dim_symbol").rsplit("/", 1)[1].replace("-", "_")
    defaults.create(m.spark, table, DIM_SYMBOL_SCHEMA, {"is_active": "true"}, f"{w.root}/{table}")
    defaults.insert(m.spark, table, w.symbols.drop("is_active"))
    return m.spark.table(table)


def _streamed(m: MarketTables, grain: str) -> DataFrame:
    """Stream bars into the fact table and the fact table into closed windows."""
    w, path = _new_warehouse(m), scratch_path(m.spark, "windows")
    checkpoints = [scratch_path(m.spark, "checkpoint") for _ in range(2)]
    jobs.stream_load_stock(m.event_stream(), w, checkpoints[0], STOCK_KEY, "src_id").awaitTermination()
    stream = jobs.read_fact_stream(m.spark, w.fact_path, w.fact.schema)
    jobs.stream_rollup(stream, grain, path, checkpoints[1]).awaitTermination()
    return m.spark.read.parquet(path)


@query
def stream_cagg_daily(m: MarketTables) -> DataFrame:
    return _streamed(m, "day")


@query
def stream_cagg_hourly(m: MarketTables) -> DataFrame:
    return _streamed(m, "hour")


# --- read-outs -------------------------------------------------------------------------------------


@query
def price_history(m: MarketTables) -> DataFrame:
    found = [readouts.price_history(bars, facts.SYMBOL_COLUMN[code], 30) for code, bars in m.stored.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def index_daily(m: MarketTables) -> DataFrame:
    return readouts.index_daily(m.stored["STOCK"], 100_000, symbol="view")


@query
def price_by_date(m: MarketTables) -> DataFrame:
    return readouts.price_by_date(m.stored["CRYPTO"], m.price_requests)


@query
def warehouse_stats(m: MarketTables) -> DataFrame:
    return warehouse.statistics(m.house)


@query
def date_range(m: MarketTables) -> DataFrame:
    return readouts.date_range(m.house.fact)
