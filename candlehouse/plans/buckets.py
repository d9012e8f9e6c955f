"""Catalog tables bucketed by their natural key, so that insert-ignore never shuffles what is stored."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlehouse.sources.tables import conform


@dataclass(frozen=True)
class BucketTable:
    """For keys that no time partition bounds. ``buckets`` is fixed once the table exists: about stored bytes / 200 MB, as it will be."""

    spark: SparkSession
    name: str
    path: str
    schema: StructType
    key: list[str]
    buckets: int = 64

    def create(self) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        key = ", ".join(f"`{c}`" for c in self.key)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet LOCATION '{self.path}'"
                       f" CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def missing(self, rows: DataFrame) -> DataFrame:
        """The rows whose key the table does not hold. They are dealt like the table's buckets; of the table only key columns are read, in place.

        Rows must be unique by key (``operators.dedup``). A null in a key is an error: such rows belong to the rejects.
        """
        delta = conform(rows, self.schema)
        for c in self.key:
            delta = delta.withColumn(c, F.coalesce(c, F.raise_error(F.lit(f"null in the key column {c} of {self.name}"))))
        return delta.repartition(self.buckets, *self.key).join(self.read().select(*self.key), self.key, "left_anti")

    def insert_ignore(self, rows: DataFrame) -> int:
        """Append the rows whose key is new, one file for each bucket; returns their number. A repeated load adds nothing."""
        self.create()
        self.spark.catalog.refreshTable(self.name)  # another session may have added files
        observed = Observation()
        new = self.missing(rows).observe(observed, F.count("*").alias("inserted"))
        new.select(*self.schema.names).write.insertInto(self.name)
        return observed.get["inserted"]
