"""Benchmark decontamination: passages of documents that repeat a benchmark item.

Items and documents are read as lower-cased words; five words make a shingle, and a similarity is the weighted Jaccard of two
shingle bags, each shingle weighing as often as it occurs: sum of minima over sum of maxima.

1. A window of a document is as long as an item. A window without any of the item's shingles has similarity 0, so windows
   are laid only where a shingle of some item of that size occurs, so that the shingle has its place in the item. A Bloom
   filter of all item shingles finds the few documents with such windows while the corpus is scanned: it is neither
   shuffled nor scanned again.
2. Each window and item gets a 64-bit SimHash of its shingles.
3. Fingerprints within ``radius`` differ in at most that many bits. Cut into radius + 1 blocks, two of them agree in at least one block
   (else each block would hold a differing bit), so looking up every block in an index of the items of the same size misses none within the radius.
4. Candidates within the radius are verified by the exact similarity of the bags.

At a similarity of 0.8 about 10 of 64 bits differ; the default radius of 20 is over three standard deviations above that.
All of it is DataFrame work: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlehouse.llm.common import checkpoint, let

N = 5
PERCENT = 80
RADIUS = 20
#: Item shingles up to which the Bloom filter is used, 64 bits each; beyond, all documents are looked up by a shuffle.
FILTER_SHINGLES = 1 << 20
PROBES = 4


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))


def shingles(w: Column, n: int) -> Column:
    """Hashes of the n-word shingles, in order; empty for fewer words."""
    def of(x: Column) -> Column:
        last = F.size(x) - n + 1
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.xxhash64(F.slice(x, i, n)))
                      ).otherwise(F.array().cast("array<bigint>"))

    return let(w, of)


def simhash(bag: Column) -> Column:
    """64-bit SimHash of an array of hashes: bit b is set if most hashes have it."""
    def of(x: Column) -> Column:
        def most(b: Column) -> Column:
            return 2 * F.size(F.filter(x, lambda h: F.call_function("shiftright", h, b).bitwiseAND(F.lit(1).cast("bigint")) == 1)) > F.size(x)

        one = F.lit(1).cast("bigint")
        return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"), lambda acc, b: acc.bitwiseOR(
            F.when(most(b), F.call_function("shiftleft", one, b)).otherwise(F.lit(0).cast("bigint"))))

    return let(bag, of)


def blocks(fingerprint: Column, radius: int) -> Column:
    """(block number, its bits) of all radius + 1 blocks; block j has the bits from j * 64 / (radius + 1) on."""
    cuts = [j * 64 // (radius + 1) for j in range(radius + 2)]
    return F.array(*[
        F.struct(F.lit(j).alias("block"),
                 F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1 if b - a < 64 else -1)).alias("bits"))
        for j, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))])


def common(a: Column, b: Column) -> Column:
    """Sum over all shingles of the lesser count in the two bags."""
    def times(bag: Column, h: Column) -> Column:
        return F.size(F.filter(bag, lambda y: y == h))

    def of(both: Column) -> Column:
        x, y = both["x"], both["y"]
        return F.aggregate(F.array_intersect(x, y), F.lit(0), lambda acc, h: acc + F.least(times(x, h), times(y, h)))

    return let(F.struct(a.alias("x"), b.alias("y")), of)


def item_bags(items: DataFrame, n: int = N) -> DataFrame:
    """(item_id, size, bag) of the items with at least n words. Shorter and null items say too little and match nothing."""
    split = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") >= n)
    return split.select("item_id", F.size("w").alias("size"), shingles(F.col("w"), n).alias("bag"))


def _probes(h: Column, bits: int) -> list[Column]:
    return [F.shiftrightunsigned(h, 11 * j).bitwiseAND(F.lit(bits - 1)) for j in range(PROBES)]


def _filter(hashes: DataFrame, longs: int) -> Column:
    """An array of ``longs`` numbers with a bit for each probe of each hash, as a scalar subquery."""
    probes = hashes.select(F.explode(F.array(*_probes(F.col("h"), longs * 64))).alias("p"))
    filled = probes.select(F.shiftright("p", 6).alias("at"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("bits"))
    zeros = hashes.sparkSession.range(longs).select(F.col("id").alias("at"), F.lit(0).cast("bigint").alias("bits"))
    rows = filled.unionAll(zeros).groupBy("at").agg(F.bit_or("bits").alias("bits"))
    return rows.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "bits"))), lambda x: x["bits"]).alias("bits")).scalar()


def candidates(docs: DataFrame, hashes: DataFrame, n: int) -> DataFrame:
    """(doc_id, copy, bag) of the documents that may hold one of ``hashes``; equal rows once."""
    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.xxhash64("text").alias("copy"), words(F.col("text")).alias("w"))
    rows = rows.select("doc_id", "copy", shingles(F.col("w"), n).alias("bag"))
    m = hashes.count()
    if 0 < m <= FILTER_SHINGLES:
        longs = 1 << max(4, (m - 1).bit_length())

        def held(h: Column) -> Column:
            out = F.lit(True)
            for p in _probes(h, longs * 64):
                at = F.call_function("shiftright", F.col("__filter")[F.shiftright(p, 6).cast("int")], p.bitwiseAND(F.lit(63)).cast("int"))
                out = out & (at.bitwiseAND(F.lit(1).cast("bigint")) == 1)
            return out

        rows = rows.withColumn("__filter", _filter(hashes, longs)).where(F.exists("bag", held)).drop("__filter")
    elif not m:
        rows = rows.where(F.lit(False))
    return checkpoint(rows).dropDuplicates(["doc_id", "copy"])


def matches(docs: DataFrame, items: DataFrame, n: int = N, percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, start, size, similarity, distance, windows): one row for each document and item it repeats.

    A document repeats an item if a window of the item's size has a similarity of at least ``percent`` hundredths with it; start (in words, from 0),
    similarity and SimHash distance are of the most similar window, the first of equals, and ``windows`` counts all. A document shorter
    than the item is one window. Null and empty texts repeat nothing, rows without an id are not looked at; equal rows count once; other columns are ignored.
    """
    bags = checkpoint(item_bags(items, n))
    placed = bags.select("item_id", "size", F.posexplode("bag").alias("place", "h"))
    hashes = placed.select("h").distinct()
    found = candidates(docs, hashes, n)
    hits = found.select("doc_id", "copy", F.size("bag").alias("__n"), F.posexplode("bag").alias("at", "h")).join(
        placed.select("h", "size", "place").distinct(), "h")
    latest = F.greatest(F.col("__n") + (n - 1) - F.col("size"), F.lit(0))
    starts = (hits.select("doc_id", "copy", "size", F.greatest(F.least(F.col("at") - F.col("place"), latest), F.lit(0)).alias("start"))
              .distinct().groupBy("doc_id", "copy").agg(F.collect_list(F.struct("size", "start")).alias("starts")))
    windows = (found.join(starts, ["doc_id", "copy"]).select("doc_id", "copy", "bag", F.explode("starts").alias("s"))
               .select("doc_id", "copy", "s.size", "s.start", F.slice("bag", F.col("s.start") + 1, F.col("s.size") - (n - 1)).alias("window")))
    windows = checkpoint(windows.withColumn("print", simhash(F.col("window"))))
    index = bags.withColumn("print", simhash(F.col("bag")))
    keyed = windows.select("doc_id", "copy", "start", "size", F.col("print").alias("p"), F.explode(blocks(F.col("print"), radius)).alias("k"))
    by_block = index.select("item_id", "size", F.col("print").alias("q"), F.explode(blocks(F.col("print"), radius)).alias("k"))
    distance = F.bit_count(F.col("p").bitwiseXOR(F.col("q")))
    near = (keyed.join(by_block, ["size", "k"]).where(distance <= radius)
            .select("doc_id", "copy", "start", "size", "item_id", distance.alias("distance")).distinct())
    both = near.join(windows.select("doc_id", "copy", "start", "size", "window"), ["doc_id", "copy", "start", "size"]).join(
        bags.select("item_id", "bag"), "item_id")
    shared = both.withColumn("shared", common(F.col("window"), F.col("bag")))
    whole = F.size("window") + F.size("bag") - F.col("shared")
    good = shared.where(100 * F.col("shared") >= percent * whole).withColumn("similarity", F.col("shared") / whole)
    best = F.min(F.struct(-F.col("similarity"), F.col("start"), F.col("distance"))).alias("best")
    return (good.groupBy("doc_id", "item_id", "size").agg(best, F.countDistinct("copy", "start").alias("windows"))
            .select("doc_id", "item_id", F.col("best.start").alias("start"), "size", (-F.col("best.col1")).alias("similarity"),
                    F.col("best.distance").alias("distance"), "windows"))
