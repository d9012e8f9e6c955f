"""Tables whose periods are replaced as a whole, by Spark's dynamic partition overwrite.

The place of a table never changes, so a reader of any session finds the current rows whenever it starts a query; a view over the
table is resolved anew each time. Spark writes new partitions beside the table and swaps them in when the job commits. A query that
is reading a partition at that moment fails for its missing file, rather than giving fewer rows, and can be repeated.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlehouse.functions import columns as C
from candlehouse.plans.storage import write_partitioned
from candlehouse.sources.tables import PERIOD, conform, read_table, remove, table_exists, with_period

ALWAYS = date(1970, 1, 1)  # the one period of a table without time


@dataclass(frozen=True)
class PeriodTable:
    """``time`` is the column that decides the period; without it the whole table is one period."""

    spark: SparkSession
    path: str
    schema: StructType
    time: str | None = None
    grain: str = "month"

    @property
    def exists(self) -> bool:
        return table_exists(self.spark, self.path)

    def period(self) -> Column:
        return C.trade_period(F.col(self.time), self.grain) if self.time else F.lit(ALWAYS)

    def stored(self) -> DataFrame:
        """The rows with their period, for filters and joins that prune by it; none before the first write."""
        return read_table(self.spark, self.path, with_period(self.schema))

    def read(self) -> DataFrame:
        return self.stored().drop(PERIOD)

    def replace(self, rows: DataFrame, sort: list[str]) -> None:
        """Make ``rows`` the content of the periods they lie in. They must not come from this table: see :meth:`merge`."""
        keyed = conform(rows, self.schema).withColumn(PERIOD, self.period())
        write_partitioned(keyed, self.path, sort, mode="overwrite")

    def merge(self, rows: DataFrame, sort: list[str], periods: list[date] | None = None) -> None:
        """The same for rows that are computed from stored ones too. Of ``periods``, those without rows go.

        All rows are written to a folder of their own first. A run that dies while they replace the old ones leaves this folder complete, and
        the next one begins with finishing it, so no stored row is lost.
        """
        self.finish(sort)
        keyed = conform(rows, self.schema).withColumn(PERIOD, self.period())
        write_partitioned(keyed, self._pending, sort)  # an append, since only that leaves the mark of a completed write
        if periods:
            left = {r[PERIOD] for r in self._staged().select(PERIOD).distinct().collect()}  # bounded by the calendar
            for gone in set(periods) - left:
                remove(self.spark, f"{self.path}/{PERIOD}={gone}")
        self.finish(sort)

    @property
    def _pending(self) -> str:
        return f"{self.path}_pending"

    def _staged(self) -> DataFrame:
        return read_table(self.spark, self._pending, with_period(self.schema))

    def finish(self, sort: list[str]) -> None:
        """Replace periods by the rows that wait in the folder beside the table, if their write was completed."""
        if table_exists(self.spark, f"{self._pending}/_SUCCESS"):
            write_partitioned(self._staged(), self.path, sort, mode="overwrite")
        remove(self.spark, self._pending)

    def show(self, view: str) -> None:
        """(Re)create ``view`` over the table, in whatever catalog the session has."""
        columns = ", ".join(f"`{f.name}`" for f in self.schema.fields)
        if self.exists and not self.spark.read.schema(with_period(self.schema)).parquet(self.path).isEmpty():
            self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM parquet.`{self.path}`")
        else:
            nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in self.schema.fields)
            self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {nothing} WHERE false")
