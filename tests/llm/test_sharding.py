import zlib
from collections import Counter

import pytest

from candlehouse.llm import sharding
from llm.frames import DOCS, awkward, with_clashes


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000, 4099])
def test_permutation_is_a_bijection_and_the_column_agrees(spark, n):
    from pyspark.sql import functions as F

    expected = [sharding.permute(i, n, 5) for i in range(n)]
    assert sorted(expected) == list(range(n))
    rows = spark.range(n).select("id", sharding.position(F.col("id"), n, 5).alias("p")).orderBy("id").collect()
    assert [r.p for r in rows] == expected


def test_shuffle_is_spread_and_seeded():
    n = 10_000
    a, b = ([sharding.permute(i, n, s) for i in range(n)] for s in (1, 2))
    assert sum(x == y for x, y in zip(a, b, strict=True)) < 20
    assert sum(abs(a[i] - a[i + 1]) < 100 for i in range(n - 1)) < 400
    assert max(Counter(p % 40 for p in a[:4000]).values()) < 140


def test_documents(spark):
    rows = awkward()
    docs = with_clashes(spark.createDataFrame(rows, DOCS))
    found = sharding.shard_documents(docs, shards=4).collect()
    again = sharding.shard_documents(docs.repartition(7), shards=4).collect()
    assert Counter(found) == Counter(again)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert sorted(r.row_number for r in found) == list(range(len(rows)))
    sizes = Counter(r.shard for r in found)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in found if r.shard == s) == list(range(n))


def test_many_equal_rows_and_no_rows(spark):
    docs = spark.range(10_000).selectExpr("cast(7 as bigint) as doc_id", "'same' as text")
    found = sharding.shard_documents(docs, shards=3)
    assert found.select("position").distinct().count() == 10_000
    assert sharding.shard_documents(docs.limit(0)).collect() == []


def test_columns_are_kept_and_results_replace_their_names(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, None, "y")], "id bigint, __n string, shard string")
    found = sharding.shard(rows, "id", 2)
    assert found.columns == ["id", "__n", "row_number", "position", "shard", "slot"]
    assert sorted(r.shard for r in found.collect()) == [0, 1]
