"""Landed payloads to raw tables, with one reject table beside them."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlehouse.operators.dedup import first_of_ordered, first_wins
from candlehouse.plans.storage import append_new, compared_periods, insert_ignore
from candlehouse.schemas import RAW_KEY, RAW_SCHEMA, REJECT_KEY, REJECT_SCHEMA
from candlehouse.sources import payloads as P
from candlehouse.sources.tables import conform, remove

#: Entries of one page at most, for the number that a numbered page and a place in it make together.
PAGE_ROWS = 1 << 24

#: What names a reject beside its key.
_NAMED = ["page", "pos", "source_time"]


@contextmanager
def staged(parsed: DataFrame, path: str):
    """Parse once: good rows and rejects go to one written table below ``path``, split by directory, which is removed at the end."""
    spark = parsed.sparkSession
    folder = f"{path}_staging/{uuid.uuid4().hex}"
    flagged = parsed.withColumn("rejected", F.col("reason").isNotNull())
    flagged.write.partitionBy("rejected").parquet(folder)
    try:
        yield spark.read.schema(flagged.schema).parquet(folder).withColumn("rejected", F.col("rejected").cast("boolean"))
    finally:
        remove(spark, folder)


def arrival(rows: DataFrame, key: list[str]) -> DataFrame:
    """Of equal keys the row that came first: by page, then by place in the page; ties fall to the other columns.

    Numbered pages make one number with the place, which keeps the rows in a hash aggregate; pages that are named by their file do not.
    """
    if "page" not in rows.columns:
        raise ValueError("payloads need a page, to tell which of two equal bars came first")
    if rows.schema["page"].dataType.simpleString() in ("bigint", "int"):
        numbered = rows.withColumn("_arrival", F.col("page") * F.lit(PAGE_ROWS).cast("bigint") + F.col("pos")).drop("page", "pos")
        return first_wins(numbered, key, "_arrival").drop("_arrival")
    return first_of_ordered(rows, key, ["page", "pos"]).drop("page", "pos")


def first_or_reject(parsed: DataFrame, key: list[str]) -> DataFrame:
    """Parsed rows with of the good ones only the first by ``key``, in one aggregation that every reject passes as a group of its own.

    What names a reject is null for good rows and so takes no part in their key, nor in the hash that tells ties apart.
    """
    bad = F.col("reason").isNotNull()
    named = [F.when(bad, F.col(c)).alias(f"_bad_{c}") for c in _NAMED]
    marked = parsed.select(*[c for c in parsed.columns if c != "source_time"], *named)
    return arrival(marked, [*key, "reason", *[f"_bad_{c}" for c in _NAMED]])


def store_rejects(bad: DataFrame, source: str, path: str) -> int:
    """Add the rejects that the table does not hold yet, by source, page (of one symbol and interval) and place."""
    rows = conform(P.rejects(bad, source), REJECT_SCHEMA)
    return append_new(first_of_ordered(rows, REJECT_KEY, []), path, REJECT_KEY)


def ingest_bars(parsed: DataFrame, asset_type: str, raw_path: str, reject_path: str) -> dict:
    """Store good rows by keyed insert-ignore and the rejects likewise. Returns how many of each are new.

    Bad rows never fail the batch: they are split off before the write. Repeating a batch adds nothing to either table.
    Rows are reduced by key before they are staged, so that copies are neither written nor read again.
    """
    key, schema = RAW_KEY[asset_type], RAW_SCHEMA[asset_type]
    with staged(first_or_reject(parsed, key), raw_path) as rows:
        first = P.valid(rows.filter("NOT rejected")).withColumn("sys_timestamp", F.current_timestamp())
        stored = insert_ignore(first, raw_path, key, periods=compared_periods(first, raw_path), schema=schema)
        bad = rows.filter("rejected").withColumnsRenamed({f"_bad_{c}": c for c in _NAMED})
        rejected = store_rejects(bad, asset_type.lower(), reject_path)
    return {"stored": stored["inserted"], "rejected": rejected}
