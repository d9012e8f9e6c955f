import random
import re

import numpy as np
import pytest

from candlehouse.llm import neardup as N
from candlehouse.llm.graph import components
from llm.frames import DOCS, awkward, sentence, with_clashes


def word_sets(rows, n):
    out = []
    for doc_id, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        out.append((doc_id, {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()))
    return out


def brute(rows, n, percent):
    sets = [(i, s) for i, s in word_sets(rows, n)]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = [(i, s) for i, s in sets if i is not None and s]
    for k, (i, s) in enumerate(known):
        for j, t in known[:k]:
            if 100 * min(len(s), len(t)) >= percent * max(len(s), len(t)):
                same = len(s & t)
                if 100 * same >= percent * (len(s) + len(t) - same):
                    a, b = sorted((root(i), root(j)))
                    parent[b] = a
    return sorted(((i is None, i or 0, len(s), None if i is None else root(i)) for i, s in sets), key=str)


def run(spark, rows, n, percent):
    docs = with_clashes(spark.createDataFrame(rows, DOCS))
    found = N.near_duplicates(docs, n, percent)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    out = found.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    return sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in out), key=str)


def edited(rng, text, k):
    w = text.split()
    for _ in range(k):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def corpus(seed):
    rng = random.Random(seed)
    texts = [sentence(rng, rng.randint(1, 120), 60) for _ in range(120)]
    passage = sentence(rng, 70)
    texts += [passage + " " + sentence(rng, rng.randint(1, 25)) for _ in range(60)]  # near or not, by length of the rest
    for base in texts[:20]:
        texts += [edited(rng, base, rng.randint(0, 4)) for _ in range(4)]
    chain = sentence(rng, 100)
    for _ in range(12):  # each near the last, the ends far apart
        texts.append(chain)
        chain = edited(rng, chain, 2)
    texts += ["Same TEXT here"] * 5 + ["same text here", "a b", "A  B", "a", "a a a a a a", "a a a a"]
    rng.shuffle(texts)
    return [(i * 3 % 1009, t, "en", "s", 0) for i, t in enumerate(texts)]


@pytest.mark.parametrize("n,percent,seed", [(3, 85, 1), (5, 80, 2), (3, 85, 3)])
def test_against_brute_force(spark, n, percent, seed):
    rows = corpus(seed)
    assert run(spark, rows, n, percent) == brute(rows, n, percent)


def test_long_lists_and_clusters_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 4)
    monkeypatch.setattr(N, "TASK_ROWS", 16)
    monkeypatch.setattr(N, "COLUMNS", 50)
    rows = corpus(4)
    assert run(spark, rows, 3, 85) == brute(rows, 3, 85)


def test_awkward_documents(spark):
    rows = awkward()
    assert run(spark, rows, 3, 85) == brute(rows, 3, 85)


def test_rows_that_share_an_id_are_one_document(spark):
    rng = random.Random(6)
    a, b = sentence(rng, 50), sentence(rng, 50)
    rows = [(5, a, "", "", 0), (5, b, "", "", 0), (7, a, "", "", 0), (9, b, "", "", 0), (1, sentence(rng, 50), "", "", 0)]
    assert [(i, c) for _, i, _, c in run(spark, rows, 3, 85)] == [(1, 1), (5, 5), (5, 5), (7, 5), (9, 5)]


def test_no_documents(spark):
    assert run(spark, [], 3, 85) == []
    assert run(spark, [(1, None, None, None, None)], 3, 85) == [(False, 1, 0, 1)]


def test_sketch_parts():
    assert N.needed(85) < N.needed(95) <= 32 and N.needed(80) >= 8
    rng = random.Random(7)
    text = sentence(rng, 300, 10_000)
    x, y = N.shingles([text, edited(rng, text, 8)], 3)
    same = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert same > 0.8 and (np.diff(x.astype(np.int64)) > 0).all()
    unequal = sum(bin(int(a) & (1 << 64) - 1).count("1") for a in N.signature(x) ^ N.signature(y))
    assert 0 < unequal <= min(N.RANGES - N.equal_bits(85), (1 - same) / (1 + same) * (len(x) + len(y)))


def test_words_across_slices_and_languages(monkeypatch):
    from candlehouse.llm import words

    texts = ["É déjà  vu\tx\x0by", "", "a" * 100, "one two three four five six seven"] * 3
    whole = N.shingles(texts, 2)
    monkeypatch.setattr(words, "SLICE", 7)
    for a, b, t in zip(whole, N.shingles(texts, 2), texts, strict=True):
        assert (a == b).all()
        assert len(a) == len(word_sets([(0, t)], 2)[0][1])


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    assert {(r.node, r.component) for r in components(df).collect()} == set(label.items())


def test_a_large_cluster_of_near_copies_is_joined_by_hubs(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 8)
    rng = random.Random(11)
    base = sentence(rng, 150, 5000)
    rows = [(i, edited(rng, base, 2), "en", "s", 0) for i in range(300)]
    met = []
    other = N._other_links
    monkeypatch.setattr(N, "_other_links", lambda sets, apart, percent: met.append(apart.count()) or other(sets, apart, percent))
    assert {r[3] for r in run(spark, rows, 3, 85)} == {0}
    assert not met  # no two blocks exchanged their sets


@pytest.mark.parametrize("seed", [1, 2])
def test_dealt_members_meet_unless_both_are_main(spark, monkeypatch, seed):
    monkeypatch.setattr(N, "BLOCK", 4)
    rng = random.Random(seed)
    rows = [(g, r, rng.choice([0, 0, 0, 0, 1, 2, r]) if g else 5) for g in range(3) for r in range(g * 100, g * 100 + 60)]
    members = spark.createDataFrame(rows, "g int, rep bigint, component bigint")
    dealt = {(r.g, r.rep): r for r in N._dealt(members, "g").collect()}
    assert {g for g, _ in dealt} == {1, 2} and len(dealt) == 120
    for (g, a), x in dealt.items():
        assert 0 <= x.own < x.blocks and (x.own >= x.others) == x.main
        for (h, b), y in dealt.items():
            if g == h and a < b and x.component != y.component:
                low = min(x, y, key=lambda r: r.own)
                assert not low.main and low.own < low.others
