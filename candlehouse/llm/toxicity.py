"""Toxicity by a factorization machine over hashed terms.

    f(x) = w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

The pairwise part learns that two terms matter together (an insult and the mention of a group) where each alone says little. Terms
are 64-bit hashes of lower-cased words and of word beginnings, so inflected and compound forms count too. x_i grows with
the logarithm of the share of the document's words that are term i, so long documents are not toxic for their length.

All terms that two documents of the labelled sample share are learned; the penalties hold back those that tell little, and documents held back
tell how far the scores shrank by them. Texts are hashed on the executors. The weights are learned on the driver from the terms of the sample, which
is bounded by ``PER_CLASS`` documents and ``CLASS_TERMS`` terms of each class; scoring covers every text whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlehouse.llm import words
from candlehouse.llm.common import checkpoint, sample_ids, texts_of

#: Labelled documents of each class in the sample, and different terms of all of them together (12 bytes each); documented bounds.
PER_CLASS, CLASS_TERMS = 3000, 8 << 20
FACTORS = 8
PREFIXES = (4, 6)
#: x of a term is log2(1 + its share of the document's words / FULL_SHARE).
FULL_SHARE = 0.01
EPOCHS, BATCH, RATE = 40, 32, 0.1
#: Penalties, which alone decide how much a term weighs.
L2W, L2V = 1e-3, 3e-2
#: Of each class, one document in so many is held back once, to learn by how much the penalties shrink the scores.
HELD = 5


def term_rows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, x) for each text's different terms, sorted by text."""
    found = words.hash_words([words.encoded([t.lower()])[0] for t in texts], words.MARKS, PREFIXES)
    n = np.diff(found.first)
    text = np.concatenate([found.text, *[found.text[found.prefix[p] != 0] for p in PREFIXES]])
    term = np.concatenate([found.hash, *[found.prefix[p][found.prefix[p] != 0] for p in PREFIXES]])
    order = np.lexsort((term, text))
    text, term = text[order], term[order]
    new = np.append(True, (text[1:] != text[:-1]) | (term[1:] != term[:-1])) if len(text) else np.zeros(0, dtype=bool)
    heads = np.flatnonzero(new)
    count, text, term = np.diff(np.append(heads, len(text))), text[heads], term[heads]
    share = np.log2(1 + count / np.maximum(n[text], 1) / FULL_SHARE) if len(text) else np.zeros(0)
    return text, term, share


@dataclass
class Machine:
    terms: np.ndarray  # sorted hashes
    w0: float
    w: np.ndarray
    v: np.ndarray

    def logits(self, doc: np.ndarray, term: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        """Of ``n`` documents, given their terms' places in ``terms``."""
        linear = np.bincount(doc, self.w[term] * x, n)
        pair = np.zeros(n)
        for f in range(self.v.shape[1]):
            vx = self.v[term, f] * x
            pair += np.bincount(doc, vx, n) ** 2 - np.bincount(doc, vx**2, n)
        return self.w0 + linear + pair / 2

    def score(self, texts: list[str]) -> np.ndarray:
        text, term, x = term_rows(texts)
        at = np.searchsorted(self.terms, term)
        known = at < len(self.terms)
        known[known] = self.terms[at[known]] == term[known]
        z = self.logits(text[known], at[known], x[known], len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def packed(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text its different terms and their strengths."""
    out = []
    for at in range(0, len(texts), 64):
        part = texts[at:at + 64]
        text, term, x = term_rows(part)
        ends = np.searchsorted(text, np.arange(len(part) + 1))
        out += [(term[a:b], x[a:b].astype(np.float32)) for a, b in zip(ends, ends[1:], strict=False)]
    return out


def learn(texts: list[str], labels: list[int], stands_for: tuple[float, float] = (1, 1), seed: int = 11) -> Machine:
    """Fit on whole texts: see :func:`learn_terms`."""
    return learn_terms(packed(texts), labels, stands_for, seed)


def learn_terms(sample: list[tuple[np.ndarray, np.ndarray]], labels: list[int], stands_for: tuple[float, float] = (1, 1),
                seed: int = 11) -> Machine:
    """Fit on the sample (terms and strengths of each document; the list is used up) by mini-batch AdaGrad on the log loss with l2 penalties. All
    terms of two or more documents take part. A document of class 0 or 1 ``stands_for`` so many labelled ones, so the classes weigh by their true share.
    """
    y = np.array(labels, dtype=float)
    weight = np.where(y == 1, *stands_for[::-1]).astype(float)
    rng = np.random.default_rng(seed)
    if not len(y) or y.min() == y.max():  # one class or none: its share is all there is to know
        share = ((weight * y).sum() + 0.5) / (weight.sum() + 2)
        return Machine(np.zeros(0, np.uint64), float(np.log(share / (1 - share))), np.zeros(0), np.zeros((0, FACTORS)))
    weight /= weight.mean()
    every = np.concatenate([t for t, _ in sample])
    every.sort()
    terms = every[1:][every[1:] == every[:-1]]  # those of two documents or more
    del every
    terms = terms[np.append(True, terms[1:] != terms[:-1])] if len(terms) else terms
    kept = []
    while sample:  # each document's own arrays go as they are taken over
        term, strength = sample.pop()
        place = np.searchsorted(terms, term).astype(np.int32)
        known = place < len(terms)
        known[known] = terms[place[known]] == term[known]
        kept.append((place[known], strength[known]))
    kept.reverse()
    first = np.append(0, np.cumsum([len(p) for p, _ in kept]))
    at, x = (np.concatenate(p) for p in zip(*kept, strict=True))
    del kept
    rows = rng.permutation(len(y))
    back = np.concatenate([rows[y[rows] == value][::HELD] for value in (0, 1) if (y == value).sum() >= 2 * HELD] or [rows[:0]])
    m = _descend(rows, first, at, x, y, weight, terms, rng)
    if len(np.unique(y[back])) == 2:
        part = _descend(rows[~np.isin(rows, back)], first, at, x, y, weight, terms, rng)
        b = _Batch(back, first, at, x, y, weight)
        stretch, shift = _calibration(part.logits(b.row, b.used[b.local], b.x, len(back)), b.y, b.weight)
        m = Machine(m.terms, float(shift + stretch * m.w0), stretch * m.w, np.sqrt(stretch) * m.v)
    return m


def _descend(rows: np.ndarray, first: np.ndarray, at: np.ndarray, x: np.ndarray, y: np.ndarray, weight: np.ndarray,
             terms: np.ndarray, rng: np.random.Generator) -> Machine:
    """A machine for the documents ``rows``, whose terms ``at`` and strengths ``x`` lie between their places in ``first``."""
    batches = [_Batch(part, first, at, x, y, weight) for part in np.array_split(rows, -(-len(rows) // BATCH))]
    k, share = len(terms), np.average(y[rows], weights=weight[rows])
    seen = np.bincount(np.concatenate([b.used for b in batches]), minlength=k)
    rare = (len(batches) / np.maximum(seen, 1)).astype(np.float32)  # a penalty is due at every step, but paid when the term occurs
    m = Machine(terms, float(np.log(share / (1 - share))), np.zeros(k, np.float32), rng.normal(0, 0.05, (k, FACTORS)).astype(np.float32))
    g0, gw, gv = 1e-2, np.full(k, 1e-2, np.float32), np.full((k, FACTORS), 1e-2, np.float32)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(batches)):
            b = batches[i]
            w, v = m.w[b.used], m.v[b.used]
            vx = v[b.local] * b.x[:, None]
            sums = b.by_row(vx)
            pair = ((sums**2).sum(axis=1) - b.by_row((vx**2).sum(axis=1))) / 2
            logit = m.w0 + b.by_row(w[b.local] * b.x) + pair
            e = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - b.y) * b.weight / len(b.y)).astype(np.float32)
            ex = e[b.row] * b.x
            dw = b.by_term(ex) + L2W * rare[b.used] * w
            dv = b.by_term(ex[:, None] * (sums[b.row] - vx)) + L2V * rare[b.used, None] * v
            d0 = float(e.sum())
            g0 += d0 * d0
            gw[b.used] += dw**2
            gv[b.used] += dv**2
            m.w0 -= RATE * d0 / np.sqrt(g0)
            m.w[b.used] = w - RATE * dw / np.sqrt(gw[b.used])
            m.v[b.used] = v - RATE * dv / np.sqrt(gv[b.used])
    m.w0 = float(m.w0)
    return m


def _calibration(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(stretch, shift) of logits that fit labels not learned from best; near (1, 0) where these say little."""
    design = np.stack([z, np.ones(len(z))], axis=1)
    prior, hold = np.array([1.0, 0.0]), np.diag([1 / 9, 1 / 9])
    c = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ c, -30, 30)))
        slope = design.T @ (weight * (p - y)) + hold @ (c - prior)
        c = c - np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + hold, slope).clip(-1, 1)
    return max(float(c[0]), 0.1), float(c[1])


class _Batch:
    """Documents that are learned from together: their terms by document, and the order that gathers them by term."""

    def __init__(self, rows: np.ndarray, first: np.ndarray, at: np.ndarray, x: np.ndarray, y: np.ndarray, weight: np.ndarray):
        n = first[rows + 1] - first[rows]
        span = np.repeat(first[rows] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        self.y, self.weight, self.x, self.row = y[rows], weight[rows], x[span], np.repeat(np.arange(len(rows), dtype=np.int32), n)
        self.filled, self.starts = np.flatnonzero(n), (np.cumsum(n) - n)[n > 0]
        self.used, local = np.unique(at[span], return_inverse=True)
        self.local = local.astype(np.int32)
        self.order = np.argsort(self.local, kind="stable").astype(np.int32)
        self.heads = np.searchsorted(self.local[self.order], np.arange(len(self.used)))

    def by_row(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.y), *values.shape[1:]), values.dtype)
        if len(self.filled):
            out[self.filled] = np.add.reduceat(values, self.starts, axis=0)
        return out

    def by_term(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values[self.order], self.heads, axis=0) if len(self.heads) else np.zeros((0, *values.shape[1:]))


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, per_class: int = PER_CLASS, class_terms: int = CLASS_TERMS) -> Machine:
    """Learn ``labels.toxic`` (0 or 1; other rows are left out) of the documents for which ``learnable`` (on doc_id) holds.

    A document with both labels counts as toxic. Null texts are learned as empty. Of a class of more than ``per_class`` documents, or more than
    ``class_terms`` terms in these, those whose hash of the id is smallest are learned, one at least; they weigh as much as all of the class.
    """
    known = (labels.select("doc_id", "toxic").where(learnable & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).join(docs.select("doc_id"), "doc_id", "left_semi"))
    known = checkpoint(known)
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    chosen = None
    for value in (0, 1):
        part = sample_ids(known.where(F.col("toxic") == value), "doc_id", per_class).withColumn("toxic", F.lit(value))
        chosen = part if chosen is None else chosen.unionAll(part)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, texts in words.grouped(whole):
                found = packed(texts)
                n = pa.array([len(t) for t, _ in found], pa.int64())
                lists = [pa.array([v.view(np.int64) if v.dtype == np.uint64 else v for v in column], pa.list_(kind))
                         for column, kind in zip(zip(*found, strict=True), (pa.int64(), pa.float32()), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), n, *lists],
                                                 names=["doc_id", "toxic", "n", "terms", "strengths"])

    texts = texts_of(docs, chosen)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    rows = checkpoint(texts.mapInArrow(hashed, f"doc_id {id_type}, toxic int, n bigint, terms array<bigint>, strengths array<float>"))
    so_far = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(so_far), F.lit(0))
    bounded = rows.select("doc_id", "toxic", "n", before.alias("before"))  # per_class short rows in a window at most
    bounded = bounded.where((F.col("before") == 0) | (F.col("before") + F.col("n") <= class_terms)).select("doc_id", "toxic")
    rows = rows.join(F.broadcast(bounded.select("doc_id")), "doc_id", "left_semi")
    # terms of one document say nothing, and stay where they are
    pairs = rows.select("doc_id", F.explode(F.arrays_zip("terms", "strengths")).alias("t")).select("doc_id", "t.terms", "t.strengths")
    shared = pairs.groupBy("terms").agg(F.count("*").alias("n")).where("n > 1").select("terms")
    by_doc = pairs.join(shared, "terms").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("terms", "strengths"))).alias("t"))
    found = (bounded.join(by_doc, "doc_id", "left").orderBy("doc_id")
             .select("toxic", F.col("t.terms").alias("terms"), F.col("t.strengths").alias("strengths")).toArrow().combine_chunks())
    labels_ = found.column("toxic").to_pylist()
    stands_for = tuple(sizes.get(value, 0) / max(1, labels_.count(value)) for value in (0, 1))
    sample = []
    for t, x in zip(*(found.column(c).combine_chunks() for c in ("terms", "strengths")), strict=True):
        term = t.values.to_numpy().view(np.uint64) if t.is_valid else np.zeros(0, np.uint64)
        order = np.argsort(term)
        sample.append((term[order], x.values.to_numpy()[order] if t.is_valid else np.zeros(0, np.float32)))
    del found
    return learn_terms(sample, labels_, tuple(max(1.0, s) for s in stands_for))


def score(docs: DataFrame, machine: Machine, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) of every row with score, 0 to 1. Null counts as the empty text. No row is dropped."""
    return scored(docs, machine.score, keep)


def scored(docs: DataFrame, scorer, keep: list[str] | None = None) -> DataFrame:
    """Rows with ``scorer`` (texts to scores) applied to batches of whole texts; a column named score is replaced."""
    names = [c for c in (keep if keep is not None else docs.columns) if c != "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, texts in words.grouped(whole, "__text"):
                columns = [batch.column(f"c{i}") for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(scorer(texts).astype(float))],
                                                 names=[*[f"c{i}" for i in range(len(names))], "score"])

    work = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col("text").alias("__text"))
    types = T.StructType([*work.drop("__text").schema.fields, T.StructField("score", T.DoubleType())])
    out = work.mapInArrow(run, types)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "score")
