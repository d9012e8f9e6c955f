import math
import random

import pytest
from pyspark.sql import functions as F

from candlehouse.llm import topk


def brute(vectors, k, scale=64, every=3):
    whole = {}
    for i, v in vectors:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(scale * x) for x in v]
        whole[i] = min(whole.get(i, w), w)
    out = set()
    for q in whole:
        if q % every == 0:
            ranked = sorted((-max(1 - 2**63, min(2**63 - 1, sum(a * b for a, b in zip(whole[q], whole[c], strict=False)))), c)
                            for c in whole if c != q)
            out |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(ranked[:k])}
    return out


def run(spark, vectors, k):
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").withColumns({"id": F.lit("x"), "v": F.lit(1), "length": F.lit(2)})
    found = topk.top_k(topk.whole_vectors(df, "vec_id", "embedding"), F.col("id") % 3 == 0, k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return [tuple(r) for r in found.collect()]


def f32(x):
    import numpy as np
    return float(np.float32(x))


@pytest.mark.parametrize("blocks", [(8192, 2048, 1024, 4096), (16, 8, 4, 5)])
def test_against_brute_force(spark, monkeypatch, blocks):
    for name, value in zip(("BAND_ROWS", "QUERY_ROWS", "BLOCK", "SEEDS"), blocks, strict=True):
        monkeypatch.setattr(topk, name, value)
    rng = random.Random(blocks[0])
    vectors = [(i, [f32(rng.gauss(0, 1) * (0.1 + i % 7)) for _ in range(6)]) for i in range(150)]
    vectors += [(200 + i, [0.5] * 6) for i in range(60)]  # ties
    vectors += [(300, None), (301, []), (302, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (303, [math.nan] * 6), (304, [math.inf] * 6),
                (305, [1e30] * 6), (None, [1.0] * 6), (306, [0.0] * 6), (3, vectors[3][1]), (3, vectors[3][1]), (309, [2.0, 1.0])]
    found = run(spark, vectors, 5)
    assert len(found) == len(set(found))
    assert set(found) == brute(vectors, 5)


def test_fewer_candidates_than_k_and_none(spark):
    vectors = [(0, [1.0, 2.0]), (1, [3.0, 4.0])]
    assert run(spark, vectors, 20) == [(0, 1, 1, 64 * 64 * 11)]
    assert run(spark, [(0, [1.0])], 20) == []
    assert run(spark, [(1, [1.0]), (2, [1.0])], 20) == []
    assert run(spark, [(0, None)], 20) == []


def test_skipping_keeps_every_result(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    base = rng.normal(size=(500, 16)) * np.geomspace(8, 0.01, 16)
    x = np.floor(64 * base * rng.geometric(0.2, 500)[:, None])
    q = x[:40]
    squares, basis = np.linalg.eigh(x.T @ x)
    full = topk.search_cell(q, np.arange(40), np.full(40, -np.inf), x, np.arange(500), basis[:, ::-1], 16, 7)
    floor = full.floors()
    for lead in (1, 4):
        for low in (np.full(40, -np.inf), floor):
            part = topk.search_cell(q, np.arange(40), low, x, np.arange(500), basis[:, ::-1], lead, 7)
            assert (part.score == full.score).all() and (part.id == full.id).all()


def test_long_vectors_take_part(spark):
    """Scores beyond doubles, beyond 64 bits, of both signs, and against short vectors."""
    rng = random.Random(8)
    vectors = [(i, [f32(rng.gauss(0, 1)) for _ in range(4)]) for i in range(60)]
    vectors += [(60 + i, [f32(rng.gauss(0, 10.0**e)) for _ in range(4)]) for i, e in enumerate([5, 6, 7, 8, 9, 12, 15, 20, 30, 37] * 3)]
    vectors += [(90, [2e6] * 4), (93, [1e30] * 4), (96, [-1e30] * 4), (97, [1e30, -1e30, 0.0, 0.5])]
    assert set(run(spark, vectors, 7)) == brute(vectors, 7)


def test_thousands_of_bands_are_planned(spark, monkeypatch):
    monkeypatch.setattr(topk, "BAND_ROWS", 2)
    rng = random.Random(9)
    vectors = [(i, [f32(rng.gauss(0, 1) * (1 + i % 1000)), 1.0]) for i in range(0, 10_000)]
    rows = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>")
    found = topk.top_k(topk.whole_vectors(rows, "vec_id", "embedding"), F.col("id") == 3, 3)
    own = [math.floor(64 * x) for x in vectors[3][1]]
    ranked = sorted((-sum(a * math.floor(64 * b) for a, b in zip(own, v)), i) for i, v in vectors if i != 3)[:3]
    assert sorted((r["rank"], r.vec_id, r.score) for r in found.collect()) == [(n + 1, i, -s) for n, (s, i) in enumerate(ranked)]
