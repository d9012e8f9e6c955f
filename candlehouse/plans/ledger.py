"""Which periods loads have touched, and how far each mart has followed: three small tables that are only appended to.

A load opens an entry before it writes facts and closes it with the periods of the rows it inserted. A load that died in between has an open entry;
:meth:`Ledger.recover` then counts every period of the facts from its lower bound on as touched. A mart's mark is the last load it has
been refreshed for, so a failed or skipped refresh is made up for by the next one. Loads are numbered by time, and there is one writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, date, datetime
from time import time_ns

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlehouse.sources.tables import PERIOD, read_table

LOADS = StructType().add("load", "long").add("since", "date").add("done", "boolean")
TOUCHED = StructType().add("load", "long").add(PERIOD, "date").add("loaded_on", "date")
MARKS = StructType().add("mart", "string").add("load", "long")


def _day(load: int) -> date:
    return datetime.fromtimestamp(load // 10**9, UTC).date()


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    path: str

    def _read(self, name: str, schema: StructType) -> DataFrame:
        return read_table(self.spark, f"{self.path}/{name}", schema)

    def _add(self, name: str, schema: StructType, rows: list[tuple]) -> None:
        table = self.spark.createDataFrame(rows, schema).coalesce(1)
        table.write.mode("append").parquet(f"{self.path}/{name}")

    def open(self, since: date | None) -> int:
        """Begin a load of rows in periods from ``since`` on (None: of any)."""
        load = time_ns()
        self._add("loads", LOADS, [(load, since or date.min, False)])
        return load

    def close(self, load: int, periods: list[date]) -> None:
        self._touch(self.spark.createDataFrame([(p,) for p in periods], f"{PERIOD} date"), load)
        self._add("loads", LOADS, [(load, None, True)])

    def _touch(self, periods: DataFrame, load: int) -> None:
        rows = periods.where(f"{PERIOD} is not null").select(F.lit(load).alias("load"), PERIOD, F.lit(_day(load)).alias("loaded_on"))
        rows.coalesce(1).write.mode("append").partitionBy("loaded_on").parquet(f"{self.path}/touched")

    def recover(self, fact: DataFrame) -> None:
        """Close the entries of loads that died: all periods of ``fact`` from their lower bound on are touched."""
        entries = self._read("loads", LOADS).groupBy("load").agg(F.max("done").alias("done"), F.max("since").alias("since"))
        dead = entries.where("not done").select("load", "since").collect()  # loads that died since the last run: a few
        if dead:
            since = min(r.since for r in dead)
            self._touch(fact.where(F.col(PERIOD) >= F.lit(since)).select(PERIOD).distinct(), time_ns())
            self._add("loads", LOADS, [(r.load, None, True) for r in dead])

    def last(self) -> int:
        """The newest load that has touched anything; 0 before the first."""
        return self._read("touched", TOUCHED).agg(F.coalesce(F.max("load"), F.lit(0))).first()[0]

    def marks(self) -> dict[str, int]:
        """How far each mart has followed: one number per mart."""
        return dict(map(tuple, self._read("marks", MARKS).groupBy("mart").agg(F.max("load")).collect()))

    def periods(self, after: int, upto: int | None = None) -> DataFrame:
        """The periods that loads have touched after one load, up to another: a table to join with, which the calendar bounds."""
        rows = self._read("touched", TOUCHED).where((F.col("loaded_on") >= F.lit(_day(after))) & (F.col("load") > after))
        if upto is not None:
            rows = rows.where(F.col("load") <= upto)
        return rows.select(PERIOD).distinct()

    def clear(self, marts: list[str], upto: int) -> None:
        """Note that ``marts`` have followed up to a load."""
        if marts:
            self._add("marks", MARKS, [(m, upto) for m in marts])

    def behind(self, mart: str) -> bool:
        return self.last() > self.marks().get(mart, 0)
