"""Ranked lexical search against scoring every document by the formula."""

import math
import random
import re
from collections import Counter

import pytest

from candlehouse.llm import lexical
from llm.frames import DOCS, awkward, sentence, with_clashes

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def split(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k):
    counts = [(i, Counter(split(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in counts]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for item, text in items:
        if item is not None and text is not None:
            asked.setdefault(item, set()).update(split(text))
    out = []
    for item, terms in asked.items():
        scores = []
        for (doc, c), length in zip(counts, lengths):
            score = 0
            for t in terms & set(c):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * (100 - 50 + (50 * length * n) // total)))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=lambda r: r[:2])


def found(docs, items, k):
    return sorted((tuple(r) for r in lexical.rank_documents(docs, items, k).collect()), key=lambda r: r[:2])


ITEMS = "item_id bigint, text string"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_scoring_all_documents(spark, monkeypatch, seed):
    """Rare and common words, ties, copies; small blocks, many parts and a large first share, so that every bound is at work."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "né", "A1", "the"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i // 2 * 2 if i % 9 == 0 else i, " ".join(rng.choices(words, weights, k=rng.randrange(1, 30)))) for i in range(500)]
    docs += [(1000 + i, docs[7][1]) for i in range(60)]
    items = [(i, "; ".join(rng.choices(words, k=rng.randrange(1, 8)))) for i in range(30)] + [(900, "unheard of"), (901, "w0 w1 the")]
    monkeypatch.setattr(lexical, "BLOCK_ROWS", 64)
    monkeypatch.setattr(lexical, "PART_TERMS", 40)
    monkeypatch.setattr(lexical, "SHARES", 5)
    frames = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), spark.createDataFrame(items, ITEMS)
    assert found(*frames, 10) == brute(docs, items, 10)


def test_awkward_rows(spark):
    rows = awkward()
    items = [(1, next(r[1] for r in rows if r[0] is None and r[1])), (2, "two WORDS"), (2, "one"), (3, None), (4, ""), (None, "one"), (5, "façade œuvre 42"), (6, "zzz")]
    docs = [(r[0], r[1]) for r in rows]
    frames = with_clashes(spark.createDataFrame(rows, DOCS)), with_clashes(spark.createDataFrame(items, ITEMS))
    result = found(*frames, 50)
    assert result == brute(docs, items, 50)
    assert any(r[2] is None for r in result)
    none = frames[0].limit(0)
    assert found(none, frames[1], 50) == [] and found(frames[0], frames[1].limit(0), 50) == []
    assert lexical.rank_documents(none, frames[1]).columns == ["item_id", "rank", "doc_id", "score"]


def test_terms_stop_creating_accumulators():
    """A term whose bound cannot lift a document over the threshold makes no accumulator."""
    rng = random.Random(4)
    texts = ["rare rare rare common"] * 20 + [f"common {sentence(rng, 5)}" for _ in range(2000)]
    vocabulary = {b"rare": 0, b"common": 1}
    stats = lexical.Statistics(len(texts), sum(len(split(t)) for t in texts), lexical._counted(texts, vocabulary)[0])
    stats.df = lexical.np.array([20, 2020])
    block = lexical.Block(texts, vocabulary, stats, stats.weights())
    touched = []
    kept = block._survivors
    block._survivors = lambda made, *a: touched.append(sum(map(len, made))) or kept(made, *a)
    at, score = block.search(lexical.np.array([0, 1]), 10, 0)
    assert touched == [20] and sorted(at) == list(range(20)) and len(set(score)) == 1
    assert not block.scores.any() and not block.seen.any()
