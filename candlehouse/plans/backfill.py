"""Backfill of a symbol universe from landed pages: all symbols of an asset type in one job."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlehouse.operators.facts import SYMBOL_COLUMN
from candlehouse.plans.ingest import ingest_bars
from candlehouse.schemas import INDEX_ETF, TOP_FOREX_PAIRS, TOP_STOCKS
from candlehouse.sources import payloads as P
from candlehouse.sources.universe import only

#: Symbols that are filled by default; crypto symbols come from a ranking (``payloads.ranked_names``, ``universe.top_by_volume``).
DEFAULT_UNIVERSE = {"STOCK": [*TOP_STOCKS, INDEX_ETF], "FOREX": TOP_FOREX_PAIRS}


def parse_range(payloads: DataFrame, asset_type: str, start: date | str | None = None, end: date | str | None = None) -> DataFrame:
    """Parsed bars of a date range (both days included), rejects too. Stock and forex pages with a bad bar are refused as a
    whole; crypto pages keep their good rows. A reject has no time that could be compared, so all of them stay."""
    parse = {"STOCK": lambda p: P.parse_stock(p, whole_pages=True), "FOREX": lambda p: P.parse_forex(p, whole_pages=True),
             "CRYPTO": P.parse_crypto}[asset_type]
    parsed = parse(payloads)
    if start is None:
        return parsed
    good = P.in_date_range(parsed.filter("reason IS NULL"), start, end)
    return good.unionByName(parsed.filter("reason IS NOT NULL"))


def backfill(
    payloads: DataFrame, asset_type: str, raw_path: str, reject_path: str, universe: list[str] | DataFrame | None = None,
    start: date | str | None = None, end: date | str | None = None,
) -> dict:
    """Store the bars of the universe's pages. ``universe`` is a list, or a table with a column ``symbol``."""
    column = SYMBOL_COLUMN[asset_type]
    if universe is None:
        universe = DEFAULT_UNIVERSE[asset_type]
    if isinstance(universe, DataFrame):
        pages = payloads.join(universe.select(F.col("symbol").alias(column)), column, "left_semi")
    else:
        pages = only(payloads, column, universe)
    return ingest_bars(parse_range(pages, asset_type, start, end), asset_type, raw_path, reject_path)
