"""Prefix sums along linked lists and along long groups, without one task that sees a whole list or group."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlehouse.llm.common import checkpoint

#: Rows of a group that are summed in one window; a longer group is summed in blocks.
BLOCK = 1024
#: A list of at most so many elements is walked in one task.
WALKED = 1 << 13

SUM: tuple[Callable, Callable] = F.sum, lambda a, b: a + b
MIN: tuple[Callable, Callable] = F.min, F.least
XOR: tuple[Callable, Callable] = F.bit_xor, lambda a, b: a.bitwiseXOR(b)


def running(rows: DataFrame, group: list[str], at: Column, values: dict[str, tuple[Callable, Callable]], block: int = BLOCK) -> DataFrame:
    """Replace each column of ``values`` by its running aggregate within ``group``, in the order of the whole number ``at``.

    ``at`` must not repeat within a group. Rows are dealt by group and block of ``at`` together (one column, which a partitioning by the
    group alone does not satisfy), so a group of any length is spread; then each block takes over the aggregate of the blocks before it.
    """
    rows = rows.withColumn("__at", at.cast("bigint"))
    rows = rows.withColumn("__k", F.struct(*group, F.floor(F.col("__at") / block).alias("block")))
    inside = Window.partitionBy("__k").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*[f"__k.{g}" for g in group]).orderBy("__k.block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("__k").agg(*[agg(v).alias(v) for v, (agg, _) in values.items()])
    before = totals.select("__k", F.row_number().over(Window.partitionBy(*[f"__k.{g}" for g in group]).orderBy("__k.block")).alias("__n"),
                           *[agg(v).over(earlier).alias(f"__before_{v}") for v, (agg, _) in values.items()]).where("__n > 1").drop("__n")
    out = rows.withColumns({v: agg(v).over(inside) for v, (agg, _) in values.items()}).join(before, "__k", "left")
    for v, (_, merge) in values.items():
        there = F.col(f"__before_{v}")
        out = out.withColumn(v, F.when(there.isNull(), F.col(v)).when(F.col(v).isNull(), there).otherwise(merge(there, F.col(v))))
    return out.drop("__k", "__at", *[f"__before_{v}" for v in values])


def _walk(weights: list[str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        follows = dict(zip(rows["id"].map(_key), rows["next"].map(_key), strict=True))
        own = dict(zip(follows, rows[weights].astype("int64").to_numpy().tolist(), strict=True))
        starts = set(follows) - set(follows.values())
        out = []
        for at in starts:
            total = [0] * len(weights)
            while at is not None:
                out.append((dict(zip("ca", at, strict=True)), *total))
                total = [t + w for t, w in zip(total, own[at], strict=True)]
                at = follows[at]
        return pd.DataFrame(out, columns=["id", *weights])

    return walk


def _key(value) -> tuple[int, int] | None:
    return None if value is None else (value["c"], value["a"])


def list_rank(elements: DataFrame, weights: list[str], walked: int = WALKED) -> DataFrame:
    """(id, weights...): the sum of the weights of all elements before each one, along its list.

    ``elements`` has ``id`` and ``next`` (struct c, a: bigint; null at the end) and bigint weights, which are at least 0. Random-mate contraction:
    in a round every element throws a coin that depends on its id and the round; one that throws 1 behind one that throws 0 is taken
    into that one, about a quarter of all. What remains after some rounds, ``walked`` elements at most, is walked in one task, and the
    rounds are undone in reverse. Rows shuffled over all rounds are a constant times the elements, and no element has more than one neighbour, so there is
    no hot key. Each round lies in the shared folder; the driver sees counts only.
    """
    left, taken, round_ = checkpoint(elements.select("id", "next", *[F.col(w).cast("bigint").alias(w) for w in weights])), [], 0
    while left.count() > walked:
        coin = lambda c: F.xxhash64(f"{c}.c", f"{c}.a", F.lit(round_)) % 2 != 0  # noqa: B023, E731
        tails = left.where(coin("id"))
        heads = left.where(~coin("id"))
        before = heads.where(F.col("next").isNotNull() & coin("next"))
        before = before.select(F.col("next").alias("id"), F.col("id").alias("head"), *[F.col(w).alias(f"head_{w}") for w in weights])
        met = checkpoint(tails.join(before, "id", "left"))
        taken.append(met.where("head is not null").select("id", "head", *[F.col(f"head_{w}").alias(w) for w in weights]))
        merged = met.select(F.coalesce("head", "id").alias("id"), "next",
                            *[(F.col(w) + F.coalesce(f"head_{w}", F.lit(0))).alias(w) for w in weights])
        left = checkpoint(merged.unionByName(heads.where(F.col("next").isNull() | ~coin("next"))))
        round_ += 1
    schema = "id struct<c:bigint,a:bigint>, " + ", ".join(f"{w} bigint" for w in weights)
    ranked = checkpoint(left.withColumn("__all", F.lit(1)).groupBy("__all").applyInPandas(_walk(weights), schema))
    for step in reversed(taken):
        of_head = ranked.select(F.col("id").alias("head"), *[F.col(w).alias(f"head_{w}") for w in weights])
        more = step.join(of_head, "head").select("id", *[(F.col(w) + F.col(f"head_{w}")).alias(w) for w in weights])
        ranked = checkpoint(ranked.unionByName(more))
    return ranked
