"""Prefix trie of conversations, with subtree sums by the Euler-tour technique.

A node is a distinct sequence of first turns; its conversations are the members. A node is named by its smallest member and its depth. Nodes with the
same smallest member make one vertical path, a chain, since the smallest member of a node is a member of its parent. Turns and prefixes travel as
hashes (128 bits, of every turn by content and place, joined by exclusive or), never as texts.

The tour has an enter and an exit arc per node. The successor of an arc is known where the next arc is of the same
chain; such runs are one element each: ``S(c)``, the enters of chain c down to its lowest node and the exits back up to the lowest node that other
chains hang on, and ``U(c, a)``, the exits from depth a up to the next such node. The elements are ranked as a list
(:mod:`candlehouse.llm.listrank`) with their numbers of arcs, leaves and savings. So each arc has its place in the tour and the sums before it, and what lies in
a subtree is the difference between a node's exit and enter.

No step gathers a group: members and children are aggregated, positions in a conversation and sums along a chain are taken in blocks, siblings are
linked in salted groups, and digests of members are fed from chunks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlehouse.llm.common import checkpoint, let
from candlehouse.llm.listrank import BLOCK, MIN, SUM, WALKED, XOR, list_rank, running

#: Children of one node that are linked in one window are about a SALTS-th of them.
SALTS = 256
#: Members whose ids differ only in so many low bits make one chunk of a digest.
CHUNK_BITS = 12
NODE = ["depth", "p1", "p2"]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, size): place in the conversation from 1, content as two 60-bit numbers, code points of the text.

    Rows are sorted over all partitions by range, numbered within each partition, and only conversations that reach over a border get
    an offset: one row per partition at most, hence broadcast.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
                                                              role.alias("role"), text.alias("text"), F.rand(7).alias("tie"))
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text"), F.asc("tie")]
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    number = lambda d, at: F.conv(F.substring(d, at, 15), 16, 10).cast("bigint")
    both = let(digest, lambda d: F.struct(number(d, 1).alias("a"), number(d, 16).alias("b")))
    ranged = rows.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order)
    # the place in the sorted partition; texts are shuffled this once
    placed = checkpoint(ranged.select("conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"),
                                      F.length("text").cast("bigint").alias("size"), both.alias("h"))
                        .select("conv_id", "part", "at", "size", "h.a", "h.b"))
    runs = placed.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.withColumn("offset", F.sum("n").over(earlier)).where("offset is not null").select("conv_id", "part", "offset")
    local = Window.partitionBy(F.struct("part", "conv_id")).orderBy("at")
    numbered = placed.withColumn("pos", F.row_number().over(local).cast("bigint"))
    return (numbered.join(F.broadcast(offsets), ["conv_id", "part"], "left")
            .select("conv_id", (F.col("pos") + F.coalesce("offset", F.lit(0))).alias("pos"), "a", "b", "size"))


def base_of(conv_id: Column) -> Column:
    return conv_id - conv_id % 100


def head_of(conv_id: Column) -> Column:
    """How many turns a conversation takes from its base."""
    return F.crc32(F.encode(conv_id.cast("string"), "UTF-8")) % 6


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations as in :func:`turns`, and (conv_id, n_turns) of all, those without any turn too."""
    c = F.col("conv_id")
    convs = own.groupBy("conv_id").agg(F.max("pos").alias("n"))
    first = own.where((F.col("pos") <= 5) & (c == base_of(c))).groupBy(c.alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "a", "b", "size"))).alias("first"))  # five at most
    taken = F.slice(F.coalesce("first", F.expr("array()")), F.lit(1), head_of(c).cast("int"))
    convs = checkpoint(convs.withColumn("base", base_of(c)).join(first, "base", "left").select(
        "conv_id", taken.alias("taken"), head_of(c).alias("head"), "n"))
    heads = convs.select("conv_id", F.explode("taken").alias("t")).select("conv_id", "t.*")
    # only where the base has too few turns do the own ones move up
    short = convs.where(F.size("taken") < F.col("head")).select("conv_id", (F.col("head") - F.size("taken")).alias("gap"))
    rest = own.where(F.col("pos") > head_of(c)).join(short, "conv_id", "left")
    rest = rest.withColumn("pos", F.col("pos") - F.coalesce("gap", F.lit(0))).drop("gap")
    n_turns = F.size("taken") + F.greatest(F.lit(0), F.col("n") - F.col("head"))
    return heads.unionByName(rest), convs.select("conv_id", n_turns.cast("bigint").alias("n_turns"))


def prefixes(sequence: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, depth, p1, p2, e1, e2, size): every prefix of every conversation, the empty one too; ``e`` is its last turn alone."""
    marks = {f"e{i}": F.xxhash64(F.lit(i), "a", "b", "pos") for i in (1, 2)}
    rows = sequence.withColumns(marks).withColumns({"p1": F.col("e1"), "p2": F.col("e2")}).drop("a", "b")
    found = running(rows, ["conv_id"], F.col("pos"), {"p1": XOR, "p2": XOR}, block).withColumnRenamed("pos", "depth")
    zero = F.lit(0).cast("bigint")
    empty = convs.select("conv_id", *[zero.alias(x) for x in ("depth", "p1", "p2", "e1", "e2", "size")])
    return found.select(*empty.columns).unionByName(empty)


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of nodes whose chunks come one behind the other; only a running digest is held."""
    now, digest = None, None
    done: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) if done else [[], [], [], []]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[*NODE, "ends_sha256"])

    for batch in batches:
        for *node, ids in zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids")], strict=True):
            if node != now:
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = node, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield flush()
        done.clear()
    if now is not None:
        done.append((*now, digest.hexdigest()))
        yield flush()


def ends(prefixes_: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, p1, p2, ends_sha256) of the nodes at which conversations end."""
    last = prefixes_.select(*NODE, "conv_id").join(convs.withColumnRenamed("n_turns", "depth"), ["conv_id", "depth"], "left_semi")
    chunk = F.struct(*NODE, F.shiftright("conv_id", CHUNK_BITS).alias("chunk"))
    chunks = last.groupBy(chunk.alias("k")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))  # 4096 different ids at most
    chunks = checkpoint(chunks.select("k.*", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids")))
    nodes = chunks.groupBy(*NODE).agg(F.count("*").alias("n"), F.min("ids").alias("ids"))
    one = nodes.where("n = 1").select(*NODE, F.sha2("ids", 256).alias("ends_sha256"))
    several = chunks.join(nodes.where("n > 1").select(*NODE), NODE, "left_semi")
    schema = "depth bigint, p1 bigint, p2 bigint, ends_sha256 string"
    fed = several.repartition(*NODE).sortWithinPartitions(*NODE, "chunk").select(*NODE, "ids").mapInArrow(_streamed, schema)
    return one.unionByName(fed)


def nodes_of(prefixes_: DataFrame) -> DataFrame:
    """One row per node: c (smallest member), depth, p1, p2, q1, q2 (its parent's), n_convs, save."""
    found = prefixes_.groupBy(*NODE).agg(F.min("conv_id").alias("c"), F.count("*").alias("n_convs"), F.min("size").alias("size"),
                                         F.min("e1").alias("e1"), F.min("e2").alias("e2"))
    return found.select("c", *NODE, F.col("p1").bitwiseXOR(F.col("e1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("e2")).alias("q2"),
                        "n_convs", ((F.col("n_convs") - 1) * F.col("size")).alias("save"))


def chains(nodes: DataFrame) -> DataFrame:
    """One row per chain: c, top and bottom depth, save, and (up, up - 1's depth) the node that it hangs on: null for the root's chain."""
    of = nodes.groupBy("c").agg(F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.sum("save").alias("save"),
                                F.min_by(F.struct("q1", "q2"), "depth").alias("q"))
    above = nodes.select(F.struct("depth", "p1", "p2").alias("k"), F.col("c").alias("up"))
    hang = of.where("top > 0").withColumn("k", F.struct((F.col("top") - 1).alias("depth"), F.col("q.q1").alias("p1"), F.col("q.q2").alias("p2")))
    columns = ["c", "top", "bottom", "save"]
    root = of.where("top = 0").select(*columns, F.lit(None).cast("bigint").alias("up"))
    return hang.join(above, "k").select(*columns, "up").unionByName(root)


def siblings(chain: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chains with ``sibling``, the next one on the same node, and the nodes with chains on them: c, a (depth), first, hanging.

    Siblings are linked within salted groups, and the last of a group to the first of the next one.
    """
    hanging = chain.where("up is not null").withColumn(
        "k", F.struct("up", (F.col("top") - 1).alias("a"), F.pmod(F.xxhash64("c"), F.lit(SALTS)).alias("salt")))
    groups = hanging.groupBy("k").agg(F.min("c").alias("least"), F.count("*").alias("n"))
    by_node = Window.partitionBy("k.up", "k.a").orderBy("k.salt")
    groups = checkpoint(groups.select("k", "least", "n", F.lead("least").over(by_node).alias("after")))
    following = F.lead("c").over(Window.partitionBy("k").orderBy("c"))
    linked = hanging.withColumn("sibling", following).join(groups.where("after is not null").select("k", "after"), "k", "left")
    linked = linked.withColumn("sibling", F.coalesce("sibling", "after")).drop("k", "after")
    root = chain.where("up is null").withColumn("sibling", F.lit(None).cast("bigint"))
    held = groups.groupBy(F.col("k.up").alias("c"), F.col("k.a").alias("a")).agg(
        F.min_by("least", "k.salt").alias("first"), F.sum("n").alias("hanging"))
    return linked.unionByName(root), held


def tour(chain: DataFrame, held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Elements of the tour for :func:`list_rank`, and the chains with ``low``, the lowest depth that chains hang on.

    A chain of depth d has at most d nodes with chains on them, each of which needs a conversation of that length: their number is
    at most the square root of twice the turns, so a window over them is no hot one.
    """
    of_chain = Window.partitionBy("c").orderBy("a")
    held = held.select("c", "a", "first", F.lag("a").over(of_chain).alias("up_a"), F.lag("first").over(of_chain).alias("up_first"))
    lowest = held.groupBy("c").agg(F.max("a").alias("low"), F.max_by("first", "a").alias("low_first"))
    chain = checkpoint(chain.join(lowest, "c", "left"))
    place = lambda c, a: F.struct(F.col(c).alias("c"), (F.lit(-1) if a is None else a).cast("bigint").alias("a"))
    after = (F.when(F.col("sibling").isNotNull(), place("sibling", None))
             .when(F.col("up").isNotNull(), place("up", F.col("top") - 1)))
    over = F.col("top") - 1
    leaf = F.when(F.col("low") == F.col("bottom"), 0).otherwise(1)
    down = chain.select(
        place("c", None).alias("id"), F.when(F.col("low").isNotNull(), place("low_first", None)).otherwise(after).alias("next"),
        (F.col("bottom") - over + F.col("bottom") - F.coalesce("low", over)).alias("arcs"), leaf.alias("leaves"), F.col("save").alias("saved"))
    up = held.join(chain.select("c", "top", "up", "sibling"), "c").select(
        place("c", F.col("a")).alias("id"), F.when(F.col("up_a").isNotNull(), place("up_first", None)).otherwise(after).alias("next"),
        (F.col("a") - F.coalesce("up_a", over)).alias("arcs"), F.lit(0).alias("leaves"), F.lit(0).alias("saved"))
    return down.unionByName(up), chain


def trie(conversations: DataFrame, walked: int = WALKED, block: int = BLOCK) -> DataFrame:
    """The nodes of the trie of the rebuilt conversations.

    ``conversations`` has conv_id, turn, role and text; other columns are not read. Turns are in the order of ``turn``, null first; rows of one turn in
    that of role and text, and repeated rows are turns of their own. A null role or text is empty. Rows without a conv_id belong to no conversation. Each
    conversation is rebuilt from the first turns of its base and its own later ones (:func:`rebuilt`). Result per node: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and enter and exit, the places of its arcs in the tour. Without
    conversations there is no node, not even the root. ``walked`` and ``block`` are the bounds of :mod:`candlehouse.llm.listrank`.
    """
    sequence, convs = rebuilt(checkpoint(turns(conversations)))
    every = checkpoint(prefixes(sequence, convs, block))
    nodes = checkpoint(nodes_of(every))
    chain, held = siblings(checkpoint(chains(nodes)))
    held = checkpoint(held)
    elements, chain = tour(chain, held)
    ranked = list_rank(elements, ["arcs", "leaves", "saved"], walked)
    at = lambda s: [F.col(x).alias(f"{s}_{x}") for x in ("arcs", "leaves", "saved")]
    down = ranked.where("id.a < 0").select(F.col("id.c").alias("c"), *at("s"))
    up = ranked.where("id.a >= 0").select(F.col("id.c").alias("c"), F.col("id.a").alias("a"), *at("u"))
    of_chain = chain.select("c", "top", "bottom", "up", "low", F.col("save").alias("whole")).join(down, "c")
    rows = nodes.select("c", *NODE, "n_convs", "save").join(held.select("c", F.col("a").alias("depth"), "hanging"), ["c", "depth"], "left")
    rows = rows.withColumn("own", F.col("save")).withColumn("a", F.when(F.col("hanging").isNotNull(), F.col("depth")))
    rows = running(rows, ["c"], F.col("depth"), {"save": SUM}, block)  # savings from the top to here
    rows = running(rows, ["c"], -F.col("depth"), {"a": MIN}, block)  # the next node from here down that chains hang on
    rows = rows.join(of_chain, "c").join(up, ["c", "a"], "left").join(ends(every, convs), NODE, "left")
    inside = F.col("a").isNull()  # the exit lies in S(c), else in U(c, a)
    exit_at = F.when(inside, F.col("s_arcs") + 2 * F.col("bottom") + 1 - F.col("top") - F.col("depth")).otherwise(
        F.col("u_arcs") + F.col("a") - F.col("depth"))
    leaves = F.when(inside, F.lit(1)).otherwise(F.col("u_leaves") - F.col("s_leaves"))
    saved = F.when(inside, F.col("s_saved") + F.col("whole")).otherwise(F.col("u_saved"))
    return rows.select(
        F.col("c").alias("conv_id"), "depth", F.when(F.col("depth") > F.col("top"), F.col("c")).otherwise(F.col("up")).alias("parent_conv_id"),
        "n_convs", ((F.col("depth") < F.col("bottom")).cast("bigint") + F.coalesce("hanging", F.lit(0))).alias("n_children"),
        leaves.cast("bigint").alias("n_leaves"), (saved - (F.col("s_saved") + F.col("save") - F.col("own"))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        (F.col("s_arcs") + F.col("depth") - F.col("top")).alias("enter"), exit_at.alias("exit"))
