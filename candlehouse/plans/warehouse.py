"""Warehouse load: dimensions, then facts, then marts, with a report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlehouse.functions import columns as C
from candlehouse.functions.arguments import naive_utc, positive, select_asset_types
from candlehouse.operators import dims, facts, marts, readouts
from candlehouse.operators.dedup import not_in
from candlehouse.plans.ledger import Ledger
from candlehouse.plans.periods import PeriodTable
from candlehouse.plans.storage import insert_ignore
from candlehouse.schemas import ASSET_TYPE_ID, DIM_SYMBOL_SCHEMA, FACT_KEY, FACT_SCHEMA
from candlehouse.sources.tables import PERIOD, conform, empty_table, period_start, read_table, with_period
from candlehouse.sources.tables import since as younger_than


@dataclass(frozen=True)
class Warehouse:
    """Where the tables of one warehouse live. ``grain`` is the partition grain of the fact table."""

    spark: SparkSession
    root: str
    grain: str = "month"

    @property
    def fact_path(self) -> str:
        return f"{self.root}/fact_ohlc_data"

    @property
    def symbol_path(self) -> str:
        return f"{self.root}/dim_symbol"

    @property
    def fact(self) -> DataFrame:
        return read_table(self.spark, self.fact_path, with_period(FACT_SCHEMA))

    @property
    def symbols(self) -> DataFrame:
        return read_table(self.spark, self.symbol_path, DIM_SYMBOL_SCHEMA)

    @property
    def ledger(self) -> Ledger:
        return Ledger(self.spark, f"{self.root}/ledger")

    def mart(self, name: str) -> PeriodTable:
        return PeriodTable(self.spark, f"{self.root}/marts/{name}", mart_schema(name), MART_TIME.get(name), self.grain)

    @property
    def star(self) -> marts.Star:
        return marts.Star(self.fact, self.symbols)


@dataclass
class RefreshReport:
    refreshed: dict[str, str] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)

    @property
    def processed(self) -> int:
        return len(self.refreshed) + len(self.errors)


@dataclass
class LoadReport:
    load_type: str
    asset_types: list[str]
    counts: dict[str, int]
    views: RefreshReport
    date_range: tuple[str | None, str | None] = (None, None)
    hours_back: int | None = None
    data_from: datetime | None = None

    @property
    def total(self) -> int:
        return sum(self.counts.values())


def load_full(
    warehouse: Warehouse, transformed: dict[str, DataFrame], asset_types: list[str] | None = None
) -> LoadReport:
    """Load every transformed bar of the selected asset types that the fact table lacks."""
    selected = select_asset_types(asset_types)
    counts = _load(warehouse, {code: transformed[code] for code in selected if code in transformed})
    views = refresh_marts(warehouse)
    return LoadReport("full", selected, counts, views, loaded_range(warehouse))


def load_incremental(
    warehouse: Warehouse,
    transformed: dict[str, DataFrame],
    as_of: datetime,
    hours_back: int = 2,
    asset_types: list[str] | None = None,
    source_grain: str = "month",
) -> LoadReport:
    """Load the bars strictly younger than ``as_of`` minus the look-back, from 1 hour on (``arguments.check_hours_back`` has
    the limits for requests).

    ``source_grain`` is the partition grain of the transformed tables, where they are stored.
    """
    hours = positive("hours_back", hours_back)
    cutoff = naive_utc(as_of) - timedelta(hours=hours)
    selected = select_asset_types(asset_types)
    recent = {code: younger_than(transformed[code], cutoff, source_grain) for code in selected if code in transformed}
    counts = _load(warehouse, recent, cutoff)
    views = refresh_marts(warehouse)
    return LoadReport("incremental", selected, counts, views, hours_back=hours, data_from=cutoff)


#: Tasks over the new symbols of a load. Each reads its share of the shuffle behind ``distinct``, whose partitions grow with the bars.
SYMBOL_TASKS = 16


def load_symbols(warehouse: Warehouse, transformed: dict[str, DataFrame]) -> int:
    """Insert the symbols the dimension lacks, found by their natural key.

    A new symbol whose id a stored or another new one has is an error, and nothing is written.
    """
    found = conform(dims.all_symbols(transformed), DIM_SYMBOL_SCHEMA)
    stored = warehouse.symbols
    new = not_in(found, stored, ["symbol_code", "asset_type_id", "currency"])
    # new symbols alone: few. Adaptive execution leaves a cached plan as it is, so every job here would have a task per shuffle partition and type
    new = new.coalesce(SYMBOL_TASKS).cache()
    try:
        n = new.count()
        if n:
            dims.check_unique(new)
            if not new.join(stored.select("symbol_id"), "symbol_id", "left_semi").isEmpty():
                raise ValueError("a new symbol has the symbol_id of a stored one")
            new.write.mode("append").parquet(warehouse.symbol_path)
        return n
    finally:
        new.unpersist()


def _load(
    warehouse: Warehouse, transformed: dict[str, DataFrame], cutoff: datetime | None = None
) -> dict[str, int]:
    if not transformed:
        return {}
    load_symbols(warehouse, transformed)
    return append_facts(warehouse, transformed, cutoff)


def append_facts(
    warehouse: Warehouse, transformed: dict[str, DataFrame], cutoff: datetime | None = None
) -> dict[str, int]:
    """Insert-ignore the fact rows of all sources in one write, counting per asset type on the way.

    With a cutoff, only the partitions from its period on are compared.
    """
    per_type = [
        F.count_if(F.col("asset_type_id") == ASSET_TYPE_ID[code]).alias(code) for code in transformed
    ]
    first = period_start(cutoff, warehouse.grain) if cutoff else None
    load = warehouse.ledger.open(first)
    rows = facts.finish(facts.fact_union(transformed))
    periods = F.collect_set(PERIOD).alias("periods")  # bounded by the calendar
    written = insert_ignore(rows, warehouse.fact_path, FACT_KEY, warehouse.grain, first=first, counts=[*per_type, periods],
                            schema=FACT_SCHEMA)
    warehouse.ledger.close(load, written["periods"])
    return {code: written[code] for code in transformed}


DAYS = "ohlc_days"
MART_TIME = {DAYS: "trading_day", "mv_daily_ohlc_summary": "trading_day", "mv_hourly_ohlc_summary": "trading_hour"}


class Refresh:
    """One refresh run. The ledger tells each mart which periods have changed since its own last refresh; these are computed anew
    and replace the stored ones. The facts to read are found by a join with the ledger, which prunes their partitions at
    run time. Every mart but the hourly one comes from the stored day rollup."""

    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse
        self.spark = warehouse.spark
        warehouse.ledger.recover(warehouse.fact)
        self.upto, self.marks = warehouse.ledger.last(), warehouse.ledger.marks()
        self.followed: list[str] = []

    def touched(self, name: str) -> DataFrame | None:
        """The periods that the mart has to catch up with; None for all, where it has not been written yet."""
        if not self.warehouse.mart(name).exists:
            return None
        return self.warehouse.ledger.periods(self.marks.get(name, 0), self.upto)

    def is_behind(self, name: str) -> bool:
        return self.upto > self.marks.get(name, 0) or not self.warehouse.mart(name).exists

    def over_time(self, name: str, build: Callable[[DataFrame | None], DataFrame]) -> PeriodTable:
        """Bring a table over time up to date. ``build`` makes its rows of the given periods, or of all for None."""
        table = self.warehouse.mart(name)
        if self.is_behind(name):
            table.replace(build(self.touched(name)), ["symbol_id", table.time])
        self.followed.append(name)
        return table

    @cached_property
    def days(self) -> PeriodTable:
        """The stored day rollup, brought up to date once per run."""
        return self.over_time(DAYS, lambda periods: marts.day_rollup(of_periods(self.warehouse.fact, periods)))

    def daily(self, name: str) -> PeriodTable:
        days = self.days
        return self.over_time(name, lambda periods: marts.daily_of(of_periods(days.stored(), periods), self.warehouse.symbols))

    def hourly(self, name: str) -> PeriodTable:
        return self.over_time(name, lambda periods: marts.hourly(
            marts.Star(of_periods(self.warehouse.fact, periods), self.warehouse.symbols)))

    def whole(self, name: str, build: Callable[[], DataFrame], sort: list[str]) -> PeriodTable:
        """A small table that is computed as a whole from the day rollup, if any period has changed."""
        table = self.warehouse.mart(name)
        if self.is_behind(name):
            table.replace(build(), sort)
        self.followed.append(name)
        return table

    def asset_type(self, name: str) -> PeriodTable:
        days = self.days.read()
        return self.whole(name, lambda: marts.asset_type_of(days), ["asset_type_code"])

    def symbol(self, name: str) -> PeriodTable:
        days = self.days.read()
        return self.whole(name, lambda: marts.symbol_of(days, self.warehouse.symbols), ["symbol_id"])

    def close(self) -> None:
        """Note what the marts have followed. A run that dies before that is repeated by the next one."""
        behind = [name for name in self.followed if self.upto > self.marks.get(name, 0)]
        self.warehouse.ledger.clear(behind, self.upto)


def of_periods(rows: DataFrame, periods: DataFrame | None) -> DataFrame:
    """The rows of some periods, which the calendar bounds."""
    return rows if periods is None else rows.join(F.broadcast(periods), PERIOD, "left_semi")


MART_REFRESH: dict[str, Callable[[Refresh, str], PeriodTable]] = {
    "mv_daily_ohlc_summary": Refresh.daily,
    "mv_hourly_ohlc_summary": Refresh.hourly,
    "mv_asset_type_summary": Refresh.asset_type,
    "mv_symbol_analytics": Refresh.symbol,
}


@cache
def mart_schema(name: str) -> StructType:
    """Columns of a mart, as its operator makes them of the declared fact and symbol tables."""
    spark = SparkSession.active()
    fact, symbols = empty_table(spark, FACT_SCHEMA), empty_table(spark, DIM_SYMBOL_SCHEMA)
    days = marts.day_rollup(fact)
    made = {
        DAYS: lambda: days,
        "mv_daily_ohlc_summary": lambda: marts.daily_of(days, symbols),
        "mv_hourly_ohlc_summary": lambda: marts.hourly(marts.Star(fact, symbols)),
        "mv_asset_type_summary": lambda: marts.asset_type_of(days),
        "mv_symbol_analytics": lambda: marts.symbol_of(days, symbols),
    }
    return made[name]().schema if name in made else StructType([])


# Analytic views over the stored marts: name, mart, and what the view does with it.
ANALYTIC_VIEWS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "ohlc_1day": ("mv_daily_ohlc_summary", marts.day_view),
    "ohlc_1hour": ("mv_hourly_ohlc_summary", marts.hour_view),
    "ohlc_7day": ("mv_daily_ohlc_summary", marts.week_view),
}


def refresh_marts(warehouse: Warehouse, steps: dict | None = None) -> RefreshReport:
    """Refresh every mart and (re)create its view; a failing one is reported and does not stop the others.

    What a failed mart has missed stays in the ledger, so its next refresh makes up for it.
    """
    run, report = Refresh(warehouse), RefreshReport()
    for name, step in (steps or MART_REFRESH).items():
        try:
            table = step(run, name)
            table.show(name)
            report.refreshed[name] = table.path
        except Exception as error:  # noqa: BLE001 - the report carries the reason
            report.errors[name] = f"{name} was not refreshed: {error}"
    run.close()
    return report


def open_views(warehouse: Warehouse) -> list[str]:
    """Create the views of all marts that have been written, as a new session with an in-memory catalog needs."""
    found = [name for name in MART_REFRESH if warehouse.mart(name).exists]
    for name in found:
        warehouse.mart(name).show(name)
    return found


def analytic_view(warehouse: Warehouse, name: str) -> DataFrame:
    """Daily, hourly or weekly bars (``ohlc_1day``, ``ohlc_1hour``, ``ohlc_7day``) over the stored mart."""
    mart, view = ANALYTIC_VIEWS[name]
    return view(warehouse.mart(mart).read())


def loaded_range(warehouse: Warehouse) -> tuple[str | None, str | None]:
    """First and last time from the day rollup, where it is up to date, else from the fact table."""
    days = warehouse.mart(DAYS)
    if not days.exists or warehouse.ledger.behind(DAYS):
        return date_range(warehouse)
    return tuple(readouts.range_of(days.read(), "first_ts", "last_updated").first())


def date_range(warehouse: Warehouse) -> tuple[str | None, str | None]:
    """First and last time in the fact table; None before the first load."""
    return tuple(readouts.date_range(warehouse.fact).first())


def statistics(warehouse: Warehouse) -> DataFrame:
    return readouts.warehouse_statistics(warehouse.fact, warehouse.symbols)
