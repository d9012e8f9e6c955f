"""Keyed insert-ignore: the first row of a key wins, known keys are left alone.

Duplicates are removed by aggregation rather than by a window: partial aggregation leaves at most one
row per key and map task before the shuffle, so a key that holds a third of the table costs no more
than any other.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_wins(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """One row per key: the one with the smallest ``order`` value.

    One ``min_by`` per column keeps fixed-width rows in a hash aggregate and lets unused columns be pruned. Rows of a
    key that tie on ``order`` are told apart by a hash of all their columns, so every column is taken from one row, the same
    one in whatever order the rows arrive.
    """
    rest = [c for c in rows.columns if c not in key and c != order]
    by = F.struct(F.col(order), F.xxhash64(*rows.columns))
    low = _one_long(rows, order)
    if low is not None:
        by = low
    picked = rows.withColumn("_by", by).groupBy(*key).agg(
        *[F.min_by(c, "_by").alias(c) for c in rest], F.min(order).alias(order)
    )
    return picked.select(*rows.columns)


def _one_long(rows: DataFrame, order: str):
    """Order and tie-break in one fixed-width number, which a hash aggregate can keep; None for orders that are no whole numbers."""
    if rows.schema[order].dataType.simpleString() not in ("bigint", "int", "smallint", "tinyint"):
        return None
    return (F.col(order).cast("decimal(38,0)") * F.lit(1 << 32).cast("decimal(12,0)")
            + F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 32)))


def first_of_ordered(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """As ``first_wins`` for an order of several columns that may tie: ties fall to the other columns."""
    rest = [c for c in rows.columns if c not in key and c not in order]
    picked = rows.groupBy(*key).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return picked.select(*key, "_first.*").select(*rows.columns)


def first_wins_wide(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """As ``first_wins`` for rows with long texts; ``order`` must be unique and not NULL.

    Only key and order are aggregated. The texts are then shuffled once on (key, order), which spreads
    copies of one key evenly, and never sorted.
    """
    winners = rows.groupBy(*key).agg(F.min(order).alias(order))
    return rows.join(winners, [*key, order], "left_semi")


def not_in(rows: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is not in ``existing``. NULL equals NULL here, so a key with NULL is not stored twice."""
    known = existing.select(*[F.col(c).alias(f"_known_{c}") for c in key])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in key])
    return rows.join(known, same, "left_anti")
