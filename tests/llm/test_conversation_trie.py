"""The trie against a dictionary of all prefixes; the list ranking against walking."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from candlehouse.llm import conversation_trie as T
from candlehouse.llm import listrank
from llm.frames import with_clashes

TURNS = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in by.items()}
    new = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        new[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:]
    members = defaultdict(list)
    for c, v in new.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(m) - 1) * (len(k[-1][1]) if k else 0)
    out = []
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(new[c]) == len(k))))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def conversations(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for c in [rng.choice([1, 1, -1]) * rng.randrange(0, 1500) for _ in range(n)]:
        for t in range(rng.randrange(0, 9)):
            text = rng.choice(["hi", "hi", "hi", "ho", None, "é😀", f"x{rng.randrange(50)}", ""])
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), text))
    # long ones with a common start, one without turns behind its head, rows without an id
    return rows + [(5000, t // 2, "u", "y") for t in range(60)] + [(5001, t // 2, "u", "y") for t in range(50)] + [(5100, 1, "u", "y"), (None, 1, "u", "x")]


@pytest.mark.parametrize(("walked", "block", "salts", "bits"), [(8192, 1024, 256, 12), (16, 8, 3, 2)])
def test_equals_dictionary_of_prefixes(spark, monkeypatch, walked, block, salts, bits):
    """Once with the bounds of the query, once with such that every list, chain, family of siblings and digest is split."""
    monkeypatch.setattr(T, "SALTS", salts)
    monkeypatch.setattr(T, "CHUNK_BITS", bits)
    rows = conversations(walked)
    table = with_clashes(spark.createDataFrame(rows, TURNS)).repartition(7)
    found = T.trie(table, walked, block)
    got = [tuple(r) for r in found.select(*COLUMNS).collect()]
    assert sorted(got, key=lambda r: r[:2]) == brute(rows)
    arcs = sorted(x for r in found.select("enter", "exit").collect() for x in r)
    assert arcs == list(range(2 * len(got)))


def test_few_and_no_conversations(spark):
    assert T.trie(spark.createDataFrame([], TURNS)).collect() == []
    assert T.trie(spark.createDataFrame([(None, 1, "u", "x")], TURNS)).collect() == []
    for rows in ([(7, None, None, None)], [(7, 1, "u", "x" * 100_000), (8, 1, "u", "x" * 100_000), (8, 1, "u", "x" * 100_000)]):
        got = [tuple(r) for r in T.trie(spark.createDataFrame(rows, TURNS)).select(*COLUMNS).collect()]
        assert sorted(got, key=lambda r: r[:2]) == brute(rows)


def test_list_rank_of_several_lists(spark):
    rng = random.Random(5)
    rows, expected = [], {}
    for c in range(3):
        order = list(range(300 + c))
        rng.shuffle(order)
        total = [0, 0]
        for a, b in zip(order, [*order[1:], None]):
            own = [rng.randrange(5), rng.randrange(3)]
            rows.append(((c, a), None if b is None else (c, b), *own))
            expected[c, a] = tuple(total)
            total = [t + w for t, w in zip(total, own)]
    table = spark.createDataFrame(rows, "id struct<c:bigint,a:bigint>, next struct<c:bigint,a:bigint>, n bigint, s bigint")
    got = listrank.list_rank(table, ["n", "s"], walked=40)
    assert {tuple(r.id): (r.n, r.s) for r in got.collect()} == expected


def test_running_sums_in_blocks(spark):
    table = spark.range(100).select((F.col("id") % 3).alias("g"), (F.col("id") - 50).alias("at"), "id")
    got = listrank.running(table.withColumn("m", F.when(F.col("id") % 10 == 5, F.col("id"))), ["g"], -F.col("at"),
                           {"id": listrank.SUM, "m": listrank.MIN}, block=4)
    for r in got.collect():
        own = [i for i in range(100) if i % 3 == r.g and i - 50 >= r.at]
        assert r.id == sum(own) and r.m == min((i for i in own if i % 10 == 5), default=None)
