"""Market tables derived from the given tables: events are stock bars, orders forex bars, lineitem
crypto bars, documents news articles. The SQL of the bar tables runs unchanged in Spark and DuckDB.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlehouse.operators import facts, transform
from candlehouse.operators.dedup import first_wins, first_wins_wide
from candlehouse.operators.facts import SOURCE_TABLE
from candlehouse.operators.marts import Star
from candlehouse.plans.transform import store_bars, store_crypto_days
from candlehouse.plans.warehouse import Warehouse, append_facts, load_symbols
from candlehouse.schemas import FOREX_KEY, STOCK_KEY, TRANSFORMED_SCHEMA
from candlehouse.session import pin_utc, scratch_path
from candlehouse.sources import universe
from candlehouse.sources.tables import read_table, with_period

LANDED_STOCK = """
select event_id as src_id, event_type as symbol,
       case when event_id % 50 = 0 then '1week' when event_id % 3 = 0 then '1min'
            when event_id % 3 = 1 then '1h' else '1day' end as interval_code,
       ts, open, cast(greatest(open, close) + 0.25 as decimal(12,2)) as high,
       cast(least(open, close) - 0.01 as decimal(12,2)) as low, close, event_id % 1000 as volume
from (select *, cast(open + (event_id % 7 - 3) * 0.10 as decimal(12,2)) as close
      from (select event_id, event_type, ts,
                   cast(case when event_id % 97 = 0 then 0 else value end as decimal(12,2)) as open
            from {events}) a) b
"""

LANDED_FOREX = """
select o_orderkey as src_id, concat(substr(o_orderpriority, 1, 1), '/USD') as currency_pair,
       case when o_orderdate = date_trunc('day', o_orderdate) then '1day' else '1h' end as interval_code,
       o_orderdate as ts, open, cast(open + 1.25 as decimal(14,2)) as high,
       cast(open - 0.75 as decimal(14,2)) as low, cast(open + 0.50 as decimal(14,2)) as close
from (select o_orderkey, o_orderpriority, o_orderdate, cast(o_totalprice as decimal(14,2)) as open
      from {orders}) a
"""

LANDED_CRYPTO = """
select l_orderkey, l_linenumber,
       case when l_partkey % 25 = 0 then 'click' else concat('C', cast(l_partkey % 25 as varchar(5))) end as symbol,
       l_returnflag as currency, l_shipdate as ts, open,
       cast(open + 1.25 as decimal(12,2)) as high, cast(open - 0.75 as decimal(12,2)) as low,
       cast(open + (l_linenumber - 4) * 0.10 as decimal(12,2)) as close,
       cast(l_quantity as decimal(12,2)) as volume_from, cast(l_extendedprice as decimal(14,2)) as volume_to
from (select *, cast(l_extendedprice as decimal(12,2)) as open from {lineitem}) a
"""

PRICE_REQUESTS = """
select concat('C', cast(o_custkey % 25 as varchar(5))) as symbol,
       case o_orderstatus when 'O' then 'N' when 'F' then 'A' else 'R' end as currency,
       cast(o_orderdate as date) as date
from {orders}
"""


# Declared, so that no job has to read file footers first.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
                "l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


#: Root of the warehouse by session and folder of tables: where the transformed tables are stored, and of these where all is loaded too.
STORES: dict[tuple[str, str], str] = {}
HOUSES: dict[tuple[str, str], str] = {}


def stored_path(house: Warehouse, code: str) -> str:
    return f"{house.root}/{SOURCE_TABLE[code]}"


def stored_bars(house: Warehouse) -> dict[str, DataFrame]:
    return {code: read_table(house.spark, stored_path(house, code), with_period(schema)) for code, schema in TRANSFORMED_SCHEMA.items()}


class MarketTables:
    """Lazy market tables over one folder of test tables. Nothing runs until a query needs it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = pin_utc(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def from_sql(self, query: str, source: str, rows: DataFrame | None = None) -> DataFrame:
        """Run a recipe; zone-less timestamps become UTC timestamps."""
        found = self.spark.sql(query, **{source: self.table(source) if rows is None else rows})
        return found.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in found.columns else found

    @cached_property
    def landed_stock(self) -> DataFrame:
        return self.from_sql(LANDED_STOCK, "events")

    @cached_property
    def landed_forex(self) -> DataFrame:
        return self.from_sql(LANDED_FOREX, "orders")

    @cached_property
    def landed_crypto(self) -> DataFrame:
        return self.from_sql(LANDED_CRYPTO, "lineitem")

    @cached_property
    def landed_news(self) -> DataFrame:
        """Every tenth description is missing, and as many are blank in two ways; every twentieth title is blank."""
        pick = F.col("doc_id") % 10
        description = (
            F.when(pick == 0, F.lit(None).cast("string")).when(pick == 1, F.lit("\u00a0  "))
            .when(pick == 2, F.lit(" \t")).otherwise(F.col("source"))
        )
        title = F.when(F.col("doc_id") % 20 == 13, F.lit("\u2003")).otherwise(F.concat("source", F.lit(" "), F.col("doc_id").cast("string")))
        return self.table("documents").select(
            F.col("doc_id").alias("src_id"), F.md5("text").alias("link"),
            title.alias("title"),
            F.date_add(F.lit("2017-01-01").cast("date"), (F.col("doc_id") % 2830).cast("int")).alias("published_date"),
            description.alias("description"), F.col("text").alias("content"),
        )

    @cached_property
    def raw_stock(self) -> DataFrame:
        return first_wins(self.landed_stock, STOCK_KEY, "src_id")

    @cached_property
    def raw_forex(self) -> DataFrame:
        return first_wins(self.landed_forex, FOREX_KEY, "src_id")

    @cached_property
    def raw_crypto(self) -> DataFrame:
        """As landed: several bars per key, which the daily transform aggregates."""
        return self.landed_crypto

    @cached_property
    def raw_news(self) -> DataFrame:
        return first_wins_wide(self.landed_news, ["link"], "src_id")

    @cached_property
    def transformed(self) -> dict[str, DataFrame]:
        return {
            "STOCK": transform.transform_stock(self.raw_stock),
            "FOREX": transform.transform_forex(self.raw_forex),
            "CRYPTO": transform.transform_crypto(self.raw_crypto),
        }

    @property
    def _key(self) -> tuple[str, str]:
        return self.spark.sparkContext.applicationId, self.sf_dir

    @cached_property
    def _store(self) -> Warehouse:
        """A warehouse beside the transformed tables, as the transform jobs leave them; they run once per session and folder of tables,
        by the first query that asks for it."""
        if self._key not in STORES:
            house = Warehouse(self.spark, scratch_path(self.spark, "house"))
            store_bars(self.raw_stock, stored_path(house, "STOCK"), "STOCK", self.landed_stock)
            store_bars(self.raw_forex, stored_path(house, "FOREX"), "FOREX", self.landed_forex)
            store_crypto_days(self.raw_crypto, stored_path(house, "CRYPTO"))
            STORES[self._key] = house.root
        return Warehouse(self.spark, STORES[self._key])

    @cached_property
    def house(self) -> Warehouse:
        """The same warehouse with all bars loaded, as the load job leaves it; once, too."""
        house = self._store
        if self._key not in HOUSES:
            load_symbols(house, self.stored)
            append_facts(house, self.stored)
            HOUSES[self._key] = house.root
        return house

    @property
    def stored(self) -> dict[str, DataFrame]:
        """The stored transformed tables, by month."""
        return stored_bars(self._store)

    @cached_property
    def fact(self) -> DataFrame:
        return facts.fact_union(self.transformed)

    @cached_property
    def star(self) -> Star:
        return self.house.star

    @cached_property
    def price_requests(self) -> DataFrame:
        return self.from_sql(PRICE_REQUESTS, "orders")

    # Payloads: JSON pages as an API would return them, with some broken rows. A page holds the rows of
    # at most 100 consecutive ids, so the lists that are collected are bounded.

    @cached_property
    def stock_payloads(self) -> DataFrame:
        n = F.col("src_id") % 100
        time = F.when(
            F.col("interval_code").isin("1min", "1h"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
        ).otherwise(F.date_format("ts", "yyyy-MM-dd"))
        close = F.when(n == 9, F.lit("n/a")).when(n != 7, F.col("close").cast("string"))
        point = F.struct(
            "src_id", time.alias("datetime"), *_texts("open", "high", "low"), close.alias("close"),
            *_texts("volume"),
        )
        return _pages(self.landed_stock, ["symbol", "interval_code"], point)

    @cached_property
    def forex_payloads(self) -> DataFrame:
        n = F.col("src_id") % 50
        opening = F.when(n == 9, F.lit("x")).when(n != 7, F.col("open").cast("string"))
        point = F.struct(
            "src_id", F.date_format("ts", "yyyy-MM-dd").alias("datetime"), opening.alias("open"),
            *_texts("high", "low", "close"),
        )
        return _pages(self.landed_forex, ["currency_pair", "interval_code"], point)

    @cached_property
    def crypto_payloads(self) -> DataFrame:
        """Pages of 100 consecutive orders; every 13th lot lacks a volume."""
        volume_to = F.when(F.col("volume_from") != 13, F.col("volume_to"))
        point = F.struct(
            "l_orderkey", "l_linenumber", F.unix_timestamp("ts").alias("time"), "open", "high", "low", "close",
            F.col("volume_from").alias("volumefrom"), volume_to.alias("volumeto"),
        )
        page = F.floor(F.col("l_orderkey") / 100).alias("page")
        grouped = self.raw_crypto.groupBy("symbol", "currency", page).agg(F.sort_array(F.collect_list(point)).alias("Data"))
        return grouped.select("symbol", "currency", "page", F.to_json(F.struct(F.struct("Data").alias("Data"))).alias("payload"))

    @cached_property
    def news_payloads(self) -> DataFrame:
        """Pages of 20 consecutive articles; one in 50 has no date, one in 50 no link."""
        n = F.col("src_id") % 50
        row = F.struct(
            "title", F.when(n == 7, F.lit("soon")).otherwise(F.date_format("published_date", "yyyy-MM-dd")).alias("published_date"),
            "description", "content", F.when(n != 9, F.col("link")).alias("link"),
        )
        page = F.floor(F.col("src_id") / 20).alias("page")
        rows = F.transform(F.sort_array(F.collect_list(F.struct("src_id", row.alias("row")))), lambda x: F.struct(x["row"].alias("row")))
        return self.landed_news.groupBy(page).agg(rows.alias("rows")).select("page", F.to_json(F.struct("rows")).alias("payload"))

    @cached_property
    def ranking_payload(self) -> DataFrame:
        """The ranking of coins by volume, as the API sends it: one small payload."""
        top = universe.top_by_volume(self.landed_crypto)
        ranked = F.sort_array(F.collect_list(F.struct((-F.col("total_volume")).alias("v"), "symbol")))
        coins = F.transform(ranked, lambda x: F.struct(F.struct(x["symbol"].alias("Name")).alias("CoinInfo")))
        return top.agg(F.to_json(F.struct(coins.alias("Data"))).alias("payload"))

    def event_stream(self) -> DataFrame:
        """The stock bars as a stream of files."""
        events = (self.spark.readStream.schema(SCHEMAS["events"]).option("pathGlobFilter", "events.parquet")
                  .option("maxFilesPerTrigger", 8).parquet(self.sf_dir))
        return self.from_sql(LANDED_STOCK, "events", events)

    def order_stream(self) -> DataFrame:
        """The forex bars as a stream of files."""
        orders = (self.spark.readStream.schema(SCHEMAS["orders"]).option("pathGlobFilter", "orders.parquet")
                  .option("maxFilesPerTrigger", 8).parquet(self.sf_dir))
        return self.from_sql(LANDED_FOREX, "orders", orders)

    def lineitem_stream(self) -> DataFrame:
        """The crypto bars as a stream of files."""
        lots = (self.spark.readStream.schema(SCHEMAS["lineitem"]).option("pathGlobFilter", "lineitem.parquet")
                .option("maxFilesPerTrigger", 8).parquet(self.sf_dir))
        return self.from_sql(LANDED_CRYPTO, "lineitem", lots)


def _texts(*names: str) -> list:
    return [F.col(c).cast("string").alias(c) for c in names]


def _pages(bars: DataFrame, key: list[str], point) -> DataFrame:
    page = F.floor(F.col("src_id") / 100).alias("page")
    grouped = bars.groupBy(*key, page).agg(F.sort_array(F.collect_list(point)).alias("values"))
    return grouped.select(*key, "page", F.to_json(F.struct("values")).alias("payload"))
