"""Near-duplicate documents from bottom-k sketches.

One hash function maps the word shingles of a document to 63-bit numbers; the sketch is the k smallest. Two documents
whose shingle sets have Jaccard similarity J share each value of their union's sketch with probability J, so

* overlaps: inverted lists of retained values bring documents together. Pairs at the threshold share at least ``need`` of k values but for
  a chance of 1e-7, so lists are only built of each document's k - need + 1 rarest values: one of the shared is among them.
* filter: the share of the union's sketch that both have estimates J; pairs below need / k are dropped. Before that a
  256-bit mark (one bit of the smallest hash in each of 256 ranges) drops nearly all other pairs without moving sketches.
* verification: exact Jaccard similarity of the full sets.

Documents with equal sets are one class first, so copies cost one row. Lists are not turned into all pairs. Each member is
paired with the list's first member, and what passes the filter gives clusters of similar documents; then lists that
still hold several clusters pair the members outside the list's main cluster with all others, in blocks. Now every link lies
within a cluster. A cluster's full sets meet in one task, a large cluster's in blocks of bounded size, where all similarities come
from products of incidence matrices. The blocks of a large cluster are joined in two steps: all sets are compared with a few hubs,
then those outside the main component with all others. Only labels leave the task, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlehouse.llm import words
from candlehouse.llm.common import checkpoint
from candlehouse.llm.graph import components, merged

K = 32
MISS = 1e-7
#: Ranges of the hash that a mark has a bit for; a multiple of 64, and a power of two.
RANGES = 256
#: Members of a list, or of a cluster, that meet in one block; members of small clusters that share a task.
BLOCK, TASK_ROWS = 1024, 2048
#: Sets of a large cluster that all its other sets are compared with first.
HUBS = 32
#: Shingles of a block that are multiplied at a time.
COLUMNS = 1024


def shingles(texts: list[str], n: int) -> list[np.ndarray]:
    """The set of each text's n-word shingles as ascending 63-bit hashes; a shorter text is one shingle, one without words none."""
    found = words.hash_words([words.ascii_lower(t) for t in words.encoded(texts)], words.SPACES)
    h, first = found.hash, found.first
    out = []
    rolled = h.copy() if len(h) else h
    for i in range(1, n):
        rolled = words.scramble(rolled[:-1] * words.U(3)) + h[i:] if len(rolled) > 1 else rolled[:0]
    for i in range(len(texts)):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= n:
            out.append(np.unique(words.scramble(rolled[a:b - n + 1]) >> words.U(1)))
        elif b > a:
            whole = h[a:a + 1] + words.U(b - a)
            for x in h[a + 1:b]:
                whole = words.scramble(whole * words.U(3)) + x
            out.append(words.scramble(whole) >> words.U(1))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def least_hits(p: float, n: int) -> int:
    """The greatest number that n trials of chance p reach, but for a chance of MISS."""
    tail = 0.0
    for x in range(n + 1):
        tail += math.comb(n, x) * p**x * (1 - p) ** (n - x)
        if tail > MISS:
            return x
    return n


def needed(percent: int, k: int = K) -> int:
    """Values of the union's sketch that both documents of a link have."""
    return max(1, least_hits(percent / 100, k))


def equal_bits(percent: int) -> int:
    """Equal bits of the marks of a link: each is equal if its range has one smallest hash, else by half."""
    return least_hits((1 + percent / 100) / 2, RANGES)


def signature(values: np.ndarray) -> np.ndarray:
    """One bit of the smallest hash in each of the equal ranges (0 for an empty range), as signed 64-bit numbers."""
    at = np.searchsorted(values, np.arange(RANGES, dtype=np.uint64) << np.uint64(63 - RANGES.bit_length() + 1))
    ends = np.append(at[1:], len(values))
    there = at < ends
    bits = np.zeros(RANGES, dtype=np.uint64)
    bits[there] = (values[at[there]] >> np.uint64(3)) & np.uint64(1)
    return (bits.reshape(-1, 64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).astype(np.int64)


def sketches(docs: DataFrame, n: int, k: int = K) -> DataFrame:
    """(doc_id, size, s1, s2, bits, sketch) of every row: two checksums tell sets apart. Null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, texts in words.grouped(whole):
                sets = shingles(texts, n)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([int(s.sum(dtype=np.uint64).astype(np.int64)) for s in sets], pa.int64()),
                    pa.array([int(words.scramble(s).sum(dtype=np.uint64).astype(np.int64)) for s in sets], pa.int64()),
                    pa.array([signature(s) for s in sets], pa.list_(pa.int64())),
                    pa.array([s[:k].astype(np.int64) for s in sets], pa.list_(pa.int64())),
                ], names=["doc_id", "size", "s1", "s2", "bits", "sketch"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, size bigint, s1 bigint, s2 bigint, bits array<bigint>, sketch array<bigint>")


def _alike(size_a: Column, size_b: Column, bits_a: Column, bits_b: Column, percent: int) -> Column:
    """What sizes and marks allow to be a link.

    Each unequal bit needs a shingle that only one of the two has, and a link has few of these: for small sets that is the closer bound.
    """
    unequal = sum(F.bit_count(bits_a[i].bitwiseXOR(bits_b[i])) for i in range(RANGES // 64))
    apart = F.floor((size_a + size_b) * (100 - percent) / (100 + percent) + 1e-9)
    return ((F.least(size_a, size_b) * 100 >= F.greatest(size_a, size_b) * percent)
            & (unequal <= F.least(F.lit(RANGES - equal_bits(percent)), apart)))


def inverted_lists(classes: DataFrame, percent: int, k: int = K) -> DataFrame:
    """(value, rep, size, bits): each class under the rarest values of its sketch that other classes have too.

    A set so small that all its partners' sketches are whole sets needs no allowance for chance: links share ``percent`` of it.
    """
    need = F.when(F.size("values") < k * percent / 100, percent / 100).otherwise(needed(percent, k) / k)
    values = classes.select("rep", F.explode("sketch").alias("value"))
    common = values.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
    known = values.join(common, "value", "left").groupBy("rep").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "value"))).alias("values"))  # k at most
    many = F.size("values")
    prefix = (many - F.ceil(many * need - 1e-9) + 1).cast("int")
    rare = F.filter(F.slice("values", F.lit(1), prefix), lambda x: x["n"] > 1)
    return (known.select("rep", F.explode(rare).alias("x")).select("rep", F.col("x.value").alias("value"))
            .join(classes.select("rep", "size", "bits"), "rep"))


def _likely(classes: DataFrame, pairs: DataFrame, percent: int, k: int) -> DataFrame:
    """The pairs (a, b) whose union's sketch has enough values of both."""
    of = lambda side: classes.select(F.col("rep").alias(side), F.col("sketch").alias(f"sketch_{side}"))
    union = F.slice(F.sort_array(F.array_union("sketch_a", "sketch_b")), 1, k)
    shared = F.size(F.array_intersect(union, F.array_intersect("sketch_a", "sketch_b")))
    return (pairs.join(of("a"), "a").join(of("b"), "b")
            .where(shared >= F.ceil(F.size(union) * (needed(percent, k) / k))).select("a", "b"))


def _dealt(members: DataFrame, group: str) -> DataFrame:
    """``members`` (rep, component, ``group``, ...) of the groups with several components, dealt into blocks, with main, own, others and blocks.

    ``main`` members have the group's most frequent component. The others lie in the blocks below ``others``, the main ones in those
    from there to ``blocks``; ``own`` is a member's block. Pairs of different components lie in (i, j) with i below ``others`` and i <= j.
    """
    parts = members.groupBy(group, "component").agg(F.count("*").alias("n"))
    whole = parts.groupBy(group).agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("n")).where(F.col("n") > F.col("most.n"))
    blocks = whole.select(group, F.col("most.component").alias("__main"), F.ceil((F.col("n") - F.col("most.n")) / BLOCK).cast("int").alias("others"),
                          F.ceil(F.col("most.n") / BLOCK).cast("int").alias("__blocks"))
    main = F.col("component") == F.col("__main")
    own = F.when(main, F.col("others") + F.pmod(F.xxhash64("rep"), F.col("__blocks"))).otherwise(F.pmod(F.xxhash64("rep"), F.col("others")))
    return (members.join(blocks, group).withColumn("main", main).withColumn("own", own.cast("int"))
            .withColumn("blocks", F.col("others") + F.col("__blocks")).drop("__main", "__blocks"))


def clusters(classes: DataFrame, percent: int, k: int = K) -> DataFrame:
    """(rep, cluster): similar classes, so that every link lies within one cluster. Classes without any similar one are left out."""
    lists = checkpoint(inverted_lists(classes, percent, k))
    # each member of a list with its first
    heads = (lists.groupBy("value").agg(F.min(F.struct("rep", "size", "bits")).alias("head"), F.count("*").alias("n"))
             .where("n > 1").select("value", "head"))
    stars = (lists.join(heads, "value").where(F.col("rep") != F.col("head.rep"))
             .where(_alike(F.col("size"), F.col("head.size"), F.col("bits"), F.col("head.bits"), percent))
             .select(F.col("head.rep").alias("a"), F.col("rep").alias("b")).distinct())
    first = components(_likely(classes, stars, percent, k))
    # lists that hold several clusters: members outside the main one, with members of other clusters
    marked = checkpoint(lists.join(first.select(F.col("node").alias("rep"), "component"), "rep", "left")
                        .withColumn("component", F.coalesce("component", "rep")))
    dealt = checkpoint(_dealt(marked, "value"))
    side = lambda s: [F.col(c).alias(f"{c}_{s}") for c in ("rep", "size", "bits", "component")]
    left = dealt.where("not main").select("value", F.col("own").alias("i"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("j"), *side("a"))
    right = dealt.select("value", F.explode(F.sequence(F.lit(0), F.least(F.col("own"), F.col("others") - 1))).alias("i"), F.col("own").alias("j"), *side("b"))
    rest = (left.join(right, ["value", "i", "j"])
            .where(((F.col("i") < F.col("j")) | (F.col("rep_a") < F.col("rep_b"))) & (F.col("component_a") != F.col("component_b")))
            .where(_alike(F.col("size_a"), F.col("size_b"), F.col("bits_a"), F.col("bits_b"), percent))
            .select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).distinct())
    return merged(first, _likely(classes, rest, percent, k)).select(F.col("node").alias("rep"), F.col("component").alias("cluster"))


def similar(x: list[np.ndarray], y: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether each set of ``x`` and each of ``y`` have enough in common, from incidence matrices over their shared values."""
    values, row = np.concatenate([*x, *y]), np.repeat(np.arange(len(x) + len(y)), [len(s) for s in (*x, *y)])
    kinds, at, times = np.unique(values, return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    shared = times[at] > 1
    at, row = column[at[shared]], row[shared]
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    same = np.zeros((len(x), len(y)), dtype=np.float32)
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
        part = slice(*np.searchsorted(at, [low, low + COLUMNS]))
        matrix = np.zeros((len(x) + len(y), COLUMNS), dtype=np.float32)
        matrix[row[part], at[part] - low] = 1
        same += matrix[:len(x)] @ matrix[len(x):].T
    whole = np.array([len(s) for s in x])[:, None] + np.array([len(s) for s in y])[None, :] - same
    return (same > 0) & (100.0 * same >= percent * whole)


def label(reps: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """The smallest rep that links reach from each set; sets of one rep are linked."""
    linked = similar(sets, sets, percent) | (reps[:, None] == reps[None, :])
    labels = reps
    while True:
        new = np.where(linked, labels[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (new == labels).all():
            return labels
        labels = new


def _sets(column: pa.ChunkedArray) -> list[np.ndarray]:
    column = column.combine_chunks()
    column = column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def linked_classes(docs: DataFrame, members: DataFrame, n: int, percent: int) -> DataFrame:
    """(rep, component) of all ``members`` (rep, cluster) by exact similarity within their clusters."""
    blocks = members.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = checkpoint(members.join(blocks, "cluster").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")))
    large = dealt.where("blocks > 1")
    texts = (docs.select(F.col("doc_id").cast("bigint").alias("rep"), "text").join(dealt, "rep")
             .groupBy("rep", "cluster", "blocks", "block", F.xxhash64("text").alias("copy")).agg(F.first("text").alias("text")))

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, part in words.grouped(whole):
                sets = pa.array([s.astype(np.int64) for s in shingles(part, n)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("rep", "cluster", "blocks", "block")), sets],
                                                 names=["rep", "cluster", "blocks", "block", "shingles"])

    sets = checkpoint(texts.drop("copy").mapInArrow(
        to_sets, "rep bigint, cluster bigint, blocks int, block int, shingles array<bigint>"))
    tasks = max(1, -(-dealt.count() // TASK_ROWS))
    # small clusters share tasks; a block of a large one has its own
    task = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(tasks))).otherwise(F.xxhash64("cluster", "block"))

    def within(table: pa.Table) -> pa.Table:
        reps, of = table["rep"].to_numpy(), table["cluster"].to_numpy() * 1_000_003 + table["block"].to_numpy()
        all_sets = _sets(table["shingles"])
        out = np.empty(len(reps), dtype=np.int64)
        order = np.argsort(of, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
            out[rows] = label(reps[rows], [all_sets[i] for i in rows], percent)
        return pa.table({"rep": reps, "component": out})

    first = sets.groupBy((task).alias("task"), (F.col("blocks") > 1).alias("whole")).applyInArrow(within, "rep bigint, component bigint")
    first = checkpoint(first.groupBy("rep").agg(F.min("component").alias("component")))
    if large.isEmpty():
        return first
    whole = sets.where("blocks > 1").select("rep", "cluster", "shingles")
    placed = checkpoint(large.join(first, "rep"))
    labels = _relabelled(first, _hub_links(whole, placed, percent))
    apart = checkpoint(_dealt(placed.drop("component", "block", "blocks").join(labels, "rep"), "cluster"))
    if apart.isEmpty():
        return labels
    return _relabelled(labels, _other_links(whole, apart, percent))


def _relabelled(first: DataFrame, links: DataFrame) -> DataFrame:
    """(rep, component) once ``links`` (a, b) between components are followed."""
    joined = components(links).select(F.col("node").alias("component"), F.col("component").alias("least"))
    return checkpoint(first.join(joined, "component", "left").select("rep", F.coalesce("least", "component").alias("component")))


def _hub_links(sets: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of components between the blocks of each cluster, from each block's sets and the cluster's hubs.

    Hubs are the first sets of the components with the most members. A block's sets move once, and the hubs to every block, so
    most blocks of a cluster of near copies become one component without any two of them meeting.
    """
    parts = placed.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    order = Window.partitionBy("cluster").orderBy(F.desc("n"), "component")
    hubs = parts.withColumn("at", F.row_number().over(order)).where(F.col("at") <= HUBS).select(F.col("component").alias("rep"), F.lit(True).alias("hub"))
    every = F.when(F.col("hub"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    cells = sets.join(placed.drop("cluster").join(hubs, "rep", "left"), "rep").select("*", F.explode(every).alias("i"))
    return _links(cells.select("cluster", "i", F.lit(-1).alias("j"), (F.col("i") != F.col("block")).alias("low"), "component", "shingles"), percent)


def _other_links(sets: DataFrame, apart: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the components of each cluster in ``apart``, exact: all sets but those of the main component meet all."""
    last = F.when(F.col("main"), F.col("others")).otherwise(F.col("blocks")) - 1
    cells = sets.drop("cluster").join(apart, "rep").select("*", F.explode(F.sequence(F.lit(0), last)).alias("other"))
    return _links(cells.select("cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                               (F.col("own") < F.col("other")).alias("low"), "component", "shingles"), percent)


def _links(cells: DataFrame, percent: int) -> DataFrame:
    """Linked components (a, b), from the ``low`` and the other sets of each cell (cluster, i, j), or from all of a cell with i = j."""

    def across(table: pa.Table) -> pa.Table:
        low, component, sets = table["low"].to_numpy(zero_copy_only=False), table["component"].to_numpy(), _sets(table["shingles"])
        x, y = np.flatnonzero(low), np.flatnonzero(~low)
        if table["i"][0] == table["j"][0]:
            x = y = np.arange(len(component))
        found = np.zeros((0, 2), dtype=np.int64)
        if len(x) and len(y):
            linked = similar([sets[i] for i in x], [sets[i] for i in y], percent)
            (parts_x, of_x), (parts_y, of_y) = (np.unique(component[z], return_inverse=True) for z in (x, y))
            met = np.zeros((len(parts_x), len(parts_y)), dtype=bool)
            for i, row in zip(of_x, linked, strict=True):
                met[i, of_y[row]] = True
            a, b = np.nonzero(met & (parts_x[:, None] != parts_y[None, :]))
            found = np.stack([parts_x[a], parts_y[b]], axis=1)
        return pa.table({"a": pa.array(found[:, 0], pa.int64()), "b": pa.array(found[:, 1], pa.int64())})

    return cells.groupBy("cluster", "i", "j").applyInArrow(across, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, k: int = K) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Links: 100 * intersection >= percent * union of the n-word shingle sets. ``component_id`` is the smallest doc_id that
    links reach, ``kept`` holds for the row with that id. Null and wordless texts have no shingles and no links. Rows that share a doc_id
    are one document, linked by either text. Rows with a null id are linked with nothing: their component is null, and they are kept.
    Other columns are ignored.
    """
    rows = checkpoint(sketches(docs, n, k))
    classes = checkpoint(rows.where("size > 0 and doc_id is not null").groupBy("size", "s1", "s2")
                         .agg(F.min("doc_id").alias("rep"), F.first("bits").alias("bits"), F.first("sketch").alias("sketch")))
    linked = linked_classes(docs, checkpoint(clusters(classes, percent, k)), n, percent)
    of_class = (classes.select("size", "s1", "s2", "rep").join(linked, "rep", "left")
                .select("size", "s1", "s2", F.coalesce("component", "rep").alias("component")))
    placed = (rows.select("doc_id", "size", "s1", "s2").join(of_class, ["size", "s1", "s2"], "left")
              .select("doc_id", F.col("size").alias("n_shingles"),
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")))
    return placed.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
