import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from candlehouse.llm import decontamination as D
from llm.frames import DOCS, awkward, sentence, with_clashes

ITEMS = "item_id bigint, text string"


def bag(words):
    return Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def likeness(a, b):
    shared = sum((a & b).values())
    return shared, sum(a.values()) + sum(b.values()) - shared


def brute(docs, items, percent=80):
    """(doc, item) -> greatest likeness over all windows of the item's size."""
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = {}
    for doc_id, text, *_ in docs:
        w = words(text)
        for item_id, item in items:
            m = words(item)
            if doc_id is None or len(m) < 5:
                continue
            for s in range(max(1, len(w) - len(m) + 1)):
                shared, whole = likeness(bag(w[s:s + len(m)]), bag(m))
                if whole and shared and 100 * shared >= percent * whole:
                    out[doc_id, item_id] = max(out.get((doc_id, item_id), 0), shared / whole)
    return out


def run(spark, docs, items, **kw):
    found = D.matches(with_clashes(spark.createDataFrame(docs, DOCS)), spark.createDataFrame(items, ITEMS).withColumn("bag", F.lit(1)), **kw)
    assert found.columns == ["doc_id", "item_id", "start", "size", "similarity", "distance", "windows"]
    return found.collect()


def cases(seed):
    rng = random.Random(seed)
    items = [(i, sentence(rng, rng.randint(12, 70), 300).capitalize() + ".") for i in range(25)]
    items += [(50, "too short item"), (51, None), (52, ""), (53, items[0][1]), (None, items[1][1]), (54, "a b a b a b a b a b a b")]
    docs = []
    for i in range(120):
        text = [sentence(rng, rng.randint(0, 80), 300)]
        if i % 3 == 0:
            w = items[rng.randrange(25)][1].split()
            kind = i % 5
            if kind == 1:
                w[rng.randrange(len(w))] = "changed"
            if kind == 2:
                w = w[:len(w) // 2]
            if kind == 3:
                w = [x.upper() + "," for x in w]
            if kind == 4:
                del w[0]
            text += [" ".join(w)]
        docs.append((i, "\n".join(text + [sentence(rng, rng.randint(0, 30), 300)]), "en", "s", 0))
    docs += [(500, items[3][1], None, None, None), (501, " ".join(x for _, x in items[:4]), None, None, None), (502, items[3][1] + " " + items[3][1], "", "", 0),
             (503, "a b a b a b a b a b", "", "", 0), (504, items[2][1], "", "", 0), (504, items[2][1], "", "", 0), (None, items[2][1], "", "", 0)]
    return docs + awkward(), items


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_windows(spark, seed):
    docs, items = cases(seed)
    expected = {k: v for k, v in brute(docs, [x for x in items if x[0] is not None]).items()}
    found = run(spark, docs, items)
    got = {(r.doc_id, r.item_id): r.similarity for r in found if r.item_id is not None}
    assert len([r for r in found if r.item_id is not None]) == len(got)
    assert set(got) == set(expected) and len(got) > 30
    assert all(abs(got[k] - expected[k]) < 0.08 and got[k] <= expected[k] + 1e-9 for k in got)
    assert all(r.distance <= D.RADIUS for r in found)


def test_without_the_filter(spark, monkeypatch):
    docs, items = cases(3)
    first = run(spark, docs, items)
    monkeypatch.setattr(D, "FILTER_SHINGLES", 0)
    assert Counter(run(spark, docs, items)) == Counter(first)


def test_no_documents_and_no_items(spark):
    docs, items = cases(4)
    assert run(spark, [], items) == []
    assert run(spark, docs, []) == []
    assert run(spark, docs, [(1, None), (2, "short")]) == []


def test_blocks_find_every_fingerprint_within_the_radius(spark):
    rng = random.Random(5)
    pairs = []
    for i in range(300):
        a, b = rng.getrandbits(64), 0
        for bit in rng.sample(range(64), rng.randint(0, 20)):
            b |= 1 << bit
        pairs.append((i, a - (1 << 63), (a ^ b) - (1 << 63)))
    df = spark.createDataFrame(pairs, "i int, p bigint, q bigint")
    met = (df.select("i", F.explode(D.blocks(F.col("p"), 20)).alias("k"))
           .join(df.select("i", F.explode(D.blocks(F.col("q"), 20)).alias("k")), ["i", "k"]).select("i").distinct().count())
    assert met == len(pairs)


def test_simhash_and_common(spark):
    rng = random.Random(6)
    rows = [([rng.getrandbits(63) for _ in range(n)] * 2, [5, 5, 7] + [rng.getrandbits(63)] * n, [5, 7, 7]) for n in (1, 2, 9)]
    for x, y, z, h, c in spark.createDataFrame(rows, "x array<bigint>, y array<bigint>, z array<bigint>").select(
            "x", "y", "z", D.simhash(F.col("x")), D.common(F.col("y"), F.col("z"))).collect():
        expected = sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in x) > len(x))
        assert h == expected and c == sum((Counter(y) & Counter(z)).values())


def test_runs_no_python_on_executors(spark, capsys):
    docs, items = cases(7)
    D.matches(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).explain("formatted")
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
