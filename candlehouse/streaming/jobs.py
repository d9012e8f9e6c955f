"""Streams: landed pages and bars into raw, transformed and fact tables, and the fact table into rollups, of closed windows or with the open ones."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from candlehouse.functions import columns as C
from candlehouse.operators.dedup import first_wins, not_in
from candlehouse.operators.rollup import ROLLUP_KEY, measures
from candlehouse.operators.transform import CRYPTO_DAY_KEY, crypto_day_rows
from candlehouse.plans import ingest, news
from candlehouse.plans.continuous import rollup_table
from candlehouse.plans.periods import PeriodTable
from candlehouse.plans.storage import insert_ignore, periods_of
from candlehouse.plans.transform import TRANSFORM, crypto_days
from candlehouse.plans.warehouse import Warehouse, append_facts, load_symbols
from candlehouse.sources import payloads as P
from candlehouse.sources.tables import PERIOD, conform

# Late rows are awaited this long, as in the batch refresh of the daily rollup.
LATENESS = "3 days"

PARSE: dict[str, Callable[[DataFrame], DataFrame]] = {"STOCK": P.parse_stock, "FOREX": P.parse_forex, "CRYPTO": P.parse_crypto}


def stream_ingest(pages: DataFrame, asset_type: str, raw_path: str, reject_path: str, checkpoint: str) -> StreamingQuery:
    """Ingest a stream of landed pages of bars (:func:`payloads.stream_landed`) with the batch job: good rows by keyed insert-ignore,
    rejects beside them.

    A batch adds to each table what it lacks. One that died between the two writes is repeated by its number from the checkpoint,
    and then adds the rest. Of equal bars the one of the earlier batch stays, and within a batch the one of the earlier page.
    """

    def store(batch: DataFrame, _: int) -> None:
        ingest.ingest_bars(PARSE[asset_type](batch), asset_type, raw_path, reject_path)

    return _available_now(pages.writeStream.foreachBatch(store), checkpoint)


def stream_ingest_news(pages: DataFrame, store: news.NewsStore, checkpoint: str) -> StreamingQuery:
    """The same for landed pages of news."""
    return _available_now(pages.writeStream.foreachBatch(lambda batch, _: news.ingest_news(store, batch)), checkpoint)


def stream_insert_ignore(
    bars: DataFrame, path: str, checkpoint: str, key: list[str], order: str
) -> StreamingQuery:
    """Insert-ignore a stream of raw bars.

    Each micro-batch is reduced by key with partial aggregation and anti-joined with the table, so a
    hot key is no hot task, duplicates are caught however late they come, and a repeated batch is
    harmless. No state has to be kept.
    """

    def insert(batch: DataFrame, _: int) -> None:
        with _cached(batch):
            insert_ignore(first_wins(batch, key, order).drop(order), path, key, periods=periods_of(batch))

    return _available_now(bars.writeStream.foreachBatch(insert), checkpoint)


def stream_insert_new(bars: DataFrame, path: str, checkpoint: str, key: list[str], lateness: str = LATENESS) -> StreamingQuery:
    """Insert-ignore a stream of raw bars whose copies mostly come soon after each other.

    The state store keeps the keys of the last ``lateness`` of event time and drops their copies, so these reach neither a
    shuffle of whole rows nor the table. Of what passes, the table's keys are left out as in :func:`stream_insert_ignore`, which
    catches copies that come after their key has left the state. Of copies within one batch any one stays, so bars must be equal by
    key; a bar older than the watermark is dropped, and belongs into a batch load.
    """
    fresh = bars.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(key)

    def insert(batch: DataFrame, _: int) -> None:
        with _cached(batch):
            insert_ignore(batch, path, key, periods=periods_of(batch))

    return _available_now(fresh.writeStream.foreachBatch(insert), checkpoint)


def stream_load_stock(
    bars: DataFrame, warehouse: Warehouse, checkpoint: str, key: list[str], order: str
) -> StreamingQuery:
    """Transform and load a stream of raw stock bars with the functions of the batch load."""
    return stream_load("STOCK", bars, warehouse, checkpoint, key, order)


def stream_load(
    asset_type: str, bars: DataFrame, warehouse: Warehouse, checkpoint: str, key: list[str], order: str
) -> StreamingQuery:
    """Transform and load a stream of raw stock or forex bars with the functions of the batch load."""

    def load(batch: DataFrame, _: int) -> None:
        with _cached(batch):
            transformed = {asset_type: TRANSFORM[asset_type](first_wins(batch, key, order))}
            load_symbols(warehouse, transformed)
            append_facts(warehouse, transformed, C.moment_of(batch, F.min("ts")))

    return _available_now(bars.writeStream.foreachBatch(load), checkpoint)


def stream_crypto_days(bars: DataFrame, path: str, checkpoint: str, lateness: str = LATENESS) -> StreamingQuery:
    """Keep the table of crypto days from a stream of raw crypto bars, with the days that are still open.

    The state store holds each open day's measures; a batch gives the whole days that its bars changed, which replace the stored
    ones, so after each batch the table equals the batch transform of the bars so far, and a repeated batch changes nothing. A day
    stays open for ``lateness`` behind the youngest bar; older bars are left to :func:`plans.transform.store_crypto_days` with its
    ``replace_from``. Files of a history in no order of time want the length of that history.
    """
    found = crypto_day_rows(bars.withWatermark("ts", lateness), F.window("ts", "1 day"))
    values = [c for c in found.columns if c not in ("symbol", "currency", "window")]
    days = found.select("symbol", "currency", F.col("window.start").alias("ts"), *values)
    return _keep_current(days, crypto_days(bars, path), CRYPTO_DAY_KEY, checkpoint)


def read_fact_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    """The files appended to a fact table, as a stream with bounded micro-batches."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def rollup_windows(fact_stream: DataFrame, grain: str, lateness: str = LATENESS) -> DataFrame:
    """Windowed rollup of a fact stream; a window is emitted once the watermark has passed its end."""
    window = F.window("ts", f"1 {grain}")
    grouped = fact_stream.withWatermark("ts", lateness).groupBy(*ROLLUP_KEY, window).agg(*measures())
    values = [c for c in grouped.columns if c not in (*ROLLUP_KEY, "window")]
    return grouped.select(*ROLLUP_KEY, F.col("window.start").alias("bucket"), *values)


def stream_open_rollup(fact_stream: DataFrame, grain: str, path: str, checkpoint: str, table_grain: str = "month") -> StreamingQuery:
    """Keep a rollup table with the buckets that are still open: after each batch it equals the batch rollup of the rows so far.

    Each batch gives the whole buckets that its rows changed, from the state; they replace the stored ones, so a batch that is
    repeated changes nothing. The watermark bounds the state: rows behind it are counted (:func:`dropped_rows`) and left to
    :func:`plans.continuous.refresh_late`.
    """
    changed = rollup_windows(fact_stream.drop(PERIOD), grain)
    table = rollup_table(fact_stream.sparkSession, path, table_grain)
    return _keep_current(changed, table, ["bucket", *ROLLUP_KEY], checkpoint)


def _keep_current(changed: DataFrame, table: PeriodTable, key: list[str], checkpoint: str) -> StreamingQuery:
    """Replace the stored rows of a table by the changed ones of each batch; only the touched periods are read and written."""

    def merge(batch: DataFrame, _: int) -> None:
        with _cached(batch):
            periods = periods_of(batch, table.time, table.grain)
            if periods:
                batch = conform(batch, table.schema)
                stored = table.stored().filter(F.col(PERIOD).isin(periods)).drop(PERIOD)
                table.merge(batch.unionByName(not_in(stored, batch, key)), key)

    return _available_now(changed.writeStream.foreachBatch(merge), checkpoint, "update")


def dropped_rows(query: StreamingQuery) -> int:
    """How many (pre-aggregated) rows the recent batches of a stream found behind its watermark and left out.

    :func:`plans.continuous.refresh_late` brings their buckets up to date.
    """
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def stream_rollup(fact_stream: DataFrame, grain: str, path: str, checkpoint: str) -> StreamingQuery:
    """Append closed windows to a table."""
    closed = rollup_windows(fact_stream.drop(PERIOD), grain)
    return _available_now(closed.writeStream.format("parquet").option("path", path), checkpoint)


@contextmanager
def _cached(batch: DataFrame) -> Iterator[None]:
    """A micro-batch is read several times; a lost executor only costs the read of its part again.

    The source bounds a batch (``maxFilesPerTrigger``); what memory can't hold of it goes to disk.
    """
    batch.persist()
    try:
        yield
    finally:
        batch.unpersist()


def _available_now(writer, checkpoint: str, mode: str = "append") -> StreamingQuery:
    return (
        writer.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
