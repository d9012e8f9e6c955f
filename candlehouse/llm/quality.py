"""Quality by positive-unlabelled learning.

The sample holds trusted positives (documents labelled good) and unlabelled web text (any documents; their labels are
not read). With pi the share of good documents among the unlabelled and l the logistic loss, the classifier f minimises the
non-negative unbiased risk

    pi E_p[l(f)] + max(0, E_u[l(-f)] - pi E_p[l(-f)])

whose second part estimates the risk on negatives that nobody labelled. Where a batch makes it negative, the step goes
the other way and undoes the over-fitting. pi is estimated before: a first classifier tells positives from unlabelled text, and the least ratio
of the two upper tails over all thresholds (those with enough positives above) is the share of unlabelled text that looks positive.

A document is described by the shape of its text: kinds of characters and words, repetition, and how often typical
function words come. The sample is bounded by ``PER_KIND`` documents of each kind; scoring covers every text whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlehouse.llm import words
from candlehouse.llm.common import sample_ids, texts_of
from candlehouse.llm.toxicity import scored

#: Documents of each kind (positive, unlabelled) in the sample; a documented bound.
PER_KIND = 4000
HIDDEN = 24
EPOCHS = 60
#: Positives above a threshold that the class prior's estimate needs.
TAIL = 0.2

_LETTER = words.byte_set(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_UPPER = words.byte_set(bytes(range(65, 91)))
_DIGIT = words.byte_set(b"0123456789")
_SENTENCE = words.byte_set(b".,;:?'\"-()")
_RUN = re.compile(rb"([^\w\s])\1+")


def features(text: str) -> list[float]:
    """Numbers that describe one whole text; finite for every text."""
    data = words.encoded([text])[0]
    raw = np.frombuffer(data, dtype=np.uint8)
    n = max(len(raw), 1)
    kinds = np.bincount(raw, minlength=256)
    share = lambda table: float(kinds[table].sum()) / n
    found = words.hash_words([data], words.SPACES)
    h, size = found.hash, found.size
    k = max(len(h), 1)
    values, counts = np.unique(h, return_counts=True)
    again = float((h[1:] == h[:-1]).mean()) if len(h) > 1 else 0.0
    pairs = words.scramble(h[:-1]) + h[1:] if len(h) > 1 else h[:0]
    lines = [x for x in data.split(b"\n") if x.strip()]
    # words of marks alone, words that hold a mark other than at a sentence's pauses
    odd = kinds[~_LETTER & ~_DIGIT & ~_SENTENCE & ~words.SPACES].sum()
    ends = data.count(b". ") + data.count(b".\n") + data.endswith(b".")
    return [
        np.log1p(len(h)), share(_LETTER), share(_UPPER), share(_DIGIT), share(_SENTENCE), np.sqrt(odd / n), odd / k,
        data.count(b"|") / k, data.count(b"!") / k, sum(len(m[0]) for m in _RUN.finditer(data)) / n,
        again, float(len(values)) / k, np.log1p(len(values)) / np.log1p(k), float(counts.max()) / k if len(h) else 0.0,
        len(np.unique(pairs)) / max(len(pairs), 1), float(size.mean()) / 10 if len(h) else 0.0,
        float(size.std()) / 10 if len(h) else 0.0, len(set(lines)) / max(len(lines), 1), len(lines) / k,
        ends / k, len(zlib.compress(data, 1)) / n if n > 64 else 0.5,
        float(np.sort(counts)[-5:].sum()) / k if len(h) else 0.0,
    ]


def matrix(texts: list[str]) -> np.ndarray:
    return np.array([features(t) for t in texts], dtype=float).reshape(len(texts), -1)


@dataclass
class Net:
    """One hidden layer over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(matrix(texts)), -30, 30)))


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


def negative_risk(fp: np.ndarray, fu: np.ndarray, prior: float) -> float:
    """The estimated risk on negatives, from the logits of positive and unlabelled rows."""
    return float(np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean())


def slopes(fp: np.ndarray, fu: np.ndarray, prior: float | None) -> np.ndarray:
    """Derivative by each logit of what a step goes down: the unbiased risk, or where the risk on negatives is below 0, that risk's
    negative. With ``prior`` None, of the plain loss that tells the two kinds apart."""
    if prior is None:
        return np.concatenate([-_sigmoid(-fp) / len(fp), _sigmoid(fu) / len(fu)])
    if negative_risk(fp, fu, prior) >= 0:
        return np.concatenate([-prior * (_sigmoid(-fp) + _sigmoid(fp)) / len(fp), _sigmoid(fu) / len(fu)])
    return np.concatenate([prior * _sigmoid(fp) / len(fp), -_sigmoid(fu) / len(fu)])


def train(p: np.ndarray, u: np.ndarray, prior: float | None, epochs: int = EPOCHS, seed: int = 5) -> Net:
    """Minimise the risk above by Adam; with ``prior`` None, tell positives from unlabelled rows instead."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([p, u])
    net = Net(both.mean(axis=0), both.std(axis=0) + 1e-6, rng.normal(0, 0.3, (both.shape[1], HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, 0.3, HIDDEN), 0.0)
    zp, zu = (np.clip((m - net.mean) / net.scale, -6, 6) for m in (p, u))
    params = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params]
    step, size = 0, 256
    rounds = max(1, max(len(p), len(u)) // size)
    for epoch in range(epochs):
        for _ in range(rounds):
            a, b = zp[rng.integers(0, len(zp), size)], zu[rng.integers(0, len(zu), size)]
            x = np.concatenate([a, b])
            hidden = np.tanh(x @ params[0] + params[1])
            f = hidden @ params[2] + params[3][0]
            fp, fu = f[:size], f[size:]
            d = slopes(fp, fu, prior)
            dh = d[:, None] * params[2] * (1 - hidden**2)
            grads = [x.T @ dh + 1e-3 * params[0], dh.sum(axis=0), hidden.T @ d + 1e-3 * params[2], np.array([d.sum()])]
            step += 1
            rate = 0.01 * (0.5 + 0.5 * np.cos(np.pi * epoch / epochs)) + 1e-4
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                params[i] = params[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Net(net.mean, net.scale, params[0], params[1], params[2], float(params[3][0]))


def class_prior(p: np.ndarray, u: np.ndarray) -> float:
    """Share of positives among unlabelled rows, from the tails of a first classifier, each half scored by the other's."""
    ratios = []
    for k in (0, 1):
        net = train(p[k::2], u[k::2], None, epochs=12)
        sp, su = np.sort(net.logits(p[1 - k::2])), np.sort(net.logits(u[1 - k::2]))
        cuts = np.unique(sp)
        above_p = 1 - np.searchsorted(sp, cuts) / len(sp)
        above_u = 1 - np.searchsorted(su, cuts) / len(su)
        ok = above_p >= TAIL
        spread = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(len(sp)) + 1 / np.sqrt(len(su)))  # Hoeffding, both tails
        best = np.argmin((above_u + spread)[ok] / above_p[ok])
        ratios.append(above_u[ok][best] / above_p[ok][best])
    return float(np.clip(np.mean(ratios), 0.05, 0.98))


def learn(positive: list[str], unlabelled: list[str]) -> Net:
    """Fit from texts: see :func:`learn_features`."""
    return learn_features(matrix(positive), matrix(unlabelled))


def learn_features(p: np.ndarray, u: np.ndarray) -> Net:
    """Fit from the numbers of positive and unlabelled texts. With too few of either, nothing can be told and every text scores 0.5."""
    if len(p) < 4 or len(u) < 4:
        width = len(features(""))
        return Net(np.zeros(width), np.ones(width), np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
    return train(p, u, class_prior(p, u))


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, per_kind: int = PER_KIND) -> Net:
    """Trusted positives are the documents labelled 1 (and never 0), unlabelled ones any; both where ``learnable`` (on doc_id) holds.

    The numbers of each text are taken on the executors; ``per_kind`` short rows of each kind come to the driver at most.
    """
    trusted = (labels.select("doc_id", "quality").where(learnable & F.col("quality").isin(0, 1))
               .groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1"))

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, texts in words.grouped(whole):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([features(t) for t in texts], pa.list_(pa.float64()))],
                                                 names=["doc_id", "features"])

    kinds, width = [], len(features(""))
    for ids in (sample_ids(trusted, "doc_id", per_kind, seed=3), sample_ids(docs.where(learnable), "doc_id", per_kind, seed=4)):
        texts = texts_of(docs, ids)
        found = texts.mapInArrow(described, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, features array<double>")
        rows = found.orderBy("doc_id").toArrow().column("features").to_pylist()
        kinds.append(np.array(rows, dtype=float).reshape(len(rows), width))
    return learn_features(*kinds)


def score(docs: DataFrame, net: Net, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) of every row with score, 0 to 1, higher for better text. Null counts as empty; no row is dropped."""
    return scored(docs, net.score, keep)
