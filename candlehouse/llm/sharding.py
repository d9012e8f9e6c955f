"""Reproducible shuffle and shards: a Feistel permutation with cycle walking over global row numbers.

Rows get gapless global numbers, a keyed permutation of 0..N-1 moves number ``n`` to ``position``, and
``shard = position mod shards``, ``slot = position div shards``. So shard and slot of any row can be computed
from its number alone, shard sizes differ by one at most, and slots have no gaps.

The permutation works on pairs (L, R) with L < a and R < b, where a * b is the least such product of about equal
sides that reaches N; rounds add a keyed function of one side to the other. A result beyond N - 1 is permuted
again (cycle walking). Out-of-range points number under a, so a walk ends after at most that many further steps,
and about one row in sqrt(N) needs even one. All arithmetic is on whole numbers below 2^62, so any SQL engine gives the same order.

Global numbers need no global sort: rows are dealt to ``buckets`` by a mix of their key, a running sum over the
bucket counts (``buckets`` rows) gives each bucket's first number, and rows are numbered inside their bucket.
Rows that agree in all their columns are interchangeable; they are counted before the shuffle and expanded after numbering.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlehouse.llm.common import checkpoint, let

M31 = 2**31 - 1
ROUNDS = 8
BUCKETS = 4096
RUN = 4096


def round_keys(seed: int) -> list[int]:
    """One key below 2^31 - 1 for each round."""
    keys, x = [], (seed * 2654435761 + 97) % M31
    for _ in range(ROUNDS):
        x = (x * 48271 + 11) % M31
        keys.append(x)
    return keys


def sides(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(n - 1, 0)) + (math.isqrt(max(n - 1, 0)) ** 2 < n))
    return a, max(1, -(-n // a))


def mix(x: int, key: int) -> int:
    """The round function in Python, for tests and for computing one row's place."""
    u = (x + key) % M31 * 48271 % M31
    return ((u * u + key) % M31 * 69621 + u) % M31


def permute(number: int, n: int, seed: int) -> int:
    """Where the permutation puts one number."""
    a, b = sides(n)
    while True:
        left, right = number % a, number // a
        for i, key in enumerate(round_keys(seed)):
            if i % 2:
                right = (right + mix(left, key)) % b
            else:
                left = (left + mix(right, key)) % a
        number = right * a + left
        if number < n:
            return number


def _mix(x: Column, key: Column) -> Column:
    return let((x + key) % M31 * 48271 % M31, lambda u: ((u * u + key) % M31 * 69621 + u) % M31)


def position(number: Column, n: int, seed: int) -> Column:
    """The permuted place of ``number`` (a bigint column, 0..n-1) as a column expression."""
    a, b = sides(n)
    keys = F.array(*[F.struct(F.lit(k).cast("bigint").alias("key"), F.lit(i % 2 == 1).alias("odd"))
                     for i, k in enumerate(round_keys(seed))])

    def turn(s: Column, k: Column) -> Column:
        return F.struct(
            F.when(k.odd, s.l).otherwise((s.l + _mix(s.r, k.key)) % a).alias("l"),
            F.when(k.odd, (s.r + _mix(s.l, k.key)) % b).otherwise(s.r).alias("r"))

    def once(p: Column) -> Column:
        side = F.lit(a).cast("bigint")
        start = F.struct((p % side).alias("l"), F.call_function("div", p, side).alias("r"))
        return F.aggregate(keys, start, turn, lambda s: s.r * a + s.l)

    return let(once(number), lambda p: F.when(p < n, p).otherwise(
        F.aggregate(F.sequence(F.lit(0), F.lit(max(a * b - n, 0))), p, lambda q, _: F.when(q < n, q).otherwise(once(q)))))


def number_rows(rows: DataFrame, key: str, buckets: int = BUCKETS) -> tuple[DataFrame, int]:
    """``rows`` with a gapless ``row_number`` from 0, the same for the same rows however they are partitioned; their count.

    ``key`` is a bigint column that tells most rows apart; null counts as -1. Order: bucket of the key, the key,
    then all other columns. All columns must be orderable.
    """
    bucket = ((F.pmod(F.coalesce(F.col("k").cast("bigint"), F.lit(-1)), F.lit(M31)) * 48271 + 12345) % M31 * 69621 % M31) % buckets
    names = rows.columns
    rows = rows.select(F.col(f"`{key}`").alias("k"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    counted = checkpoint(rows.withColumn("__bucket", bucket).groupBy("__bucket", *rows.columns).agg(F.count("*").alias("__n")))
    first = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (counted.groupBy("__bucket").agg(F.sum("__n").alias("__in"))
              .select("__bucket", F.coalesce(F.sum("__in").over(first), F.lit(0)).alias("__start")))
    order = Window.partitionBy("__bucket").orderBy(*[F.col(c).asc_nulls_first() for c in rows.columns])
    before = F.coalesce(F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # starts holds at most one row for each bucket
    placed = counted.withColumn("__before", before).join(F.broadcast(starts), "__bucket")
    runs = placed.withColumn("__run", F.explode(F.sequence(F.lit(0), F.expr(f"(__n - 1) div {RUN}"))))
    n = counted.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    last = F.least(F.lit(RUN), F.col("__n") - F.col("__run") * RUN) - 1
    numbered = (runs.withColumn("__i", F.explode(F.sequence(F.lit(0), last.cast("int"))))
            .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], (F.col("__start") + F.col("__before") + F.col("__run") * RUN + F.col("__i")).alias("row_number")))
    return numbered, n


def shard(rows: DataFrame, key: str, shards: int, seed: int = 20, buckets: int = BUCKETS) -> DataFrame:
    """``rows`` with row_number, position, shard and slot.

    No row is lost: null keys, repeated rows and ties get places of their own. Empty input gives an empty result.
    Columns named row_number, position, shard or slot in the input are replaced by the results.
    """
    rows = rows.drop("row_number", "position", "shard", "slot")
    numbered, n = number_rows(rows, key, buckets)
    return (numbered.withColumn("position", position(F.col("row_number"), max(n, 1), seed))
            .withColumn("shard", (F.col("position") % shards).cast("int"))
            .withColumn("slot", F.expr(f"position div {shards}")))


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 20) -> DataFrame:
    """Shards of documents by their ids, sizes and checksums; the texts themselves are read once and not shuffled.

    Size is the text's UTF-8 bytes plus 16; a null text has size 16 and the checksum 0 of no bytes. Other columns
    of ``docs`` are left out.
    """
    raw = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    slim = docs.select("doc_id", (F.octet_length(raw) + 16).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    return shard(slim, "doc_id", shards, seed)
