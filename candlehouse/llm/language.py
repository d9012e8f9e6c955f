"""Language identification by mixture inference.

A document is a mixture of languages: each of its character trigrams comes from language l with probability pi_l and is then
drawn from l's trigram distribution. Expectation-maximisation estimates the proportions pi of every document. The set of its
languages is chosen by penalised likelihood: languages are taken in the order of their proportions, one more
as long as the log-likelihood gains more than ``PENALTY`` per doubling of the document's trigrams.

Distributions are learned from texts with a language label: at most about ``PER_LANGUAGE`` documents of each language,
those whose hashed ids fall below that language's threshold. Trigrams are hashed to ``buckets`` and counted on the executors;
the driver gets languages times buckets numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 4096
#: Documents of one language that its distribution is learned from, in expectation; a documented bound.
PER_LANGUAGE = 2000
PENALTY = 4.0
STEPS = 12
#: Characters that are turned into trigrams at a time.
CHUNK = 1 << 20
#: Languages of one document at most that are told apart; the rest of its text goes to the nearest of these.
MOST = 4
UNKNOWN = "und"


def trigram_counts(texts: list[str], buckets: int) -> np.ndarray:
    """A row of trigram counts for each text. Letters are lower-cased, all between two words counts as one blank."""
    counts = np.zeros((len(texts), buckets), dtype=np.float32)
    for i, text in enumerate(texts):
        for at in range(0, len(text), CHUNK):  # windows that cross a cut are covered by the overlap of two
            part = text[at:at + CHUNK + 2].lower()
            code = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
            letter = (code >= 192) | ((code >= 97) & (code <= 122)) | (code == 170) | (code == 181) | (code == 186)
            code = np.where(letter, code, 32)
            code = np.concatenate([[32], code, [32]]) if at == 0 and len(text) <= CHUNK else code
            code = code[np.append(True, (code[1:] != 32) | (code[:-1] != 32))] if len(code) else code
            if len(code) < 3:
                continue
            h = code[:-2] * 7919 + code[1:-1] * 104729 + code[2:] * 1299709
            h ^= h >> 13
            counts[i] += np.bincount((h * 2654435761 >> 7) % buckets, minlength=buckets)
    return counts


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray  # languages x buckets
    p: np.ndarray

    @classmethod
    def from_counts(cls, counts: dict[str, np.ndarray], buckets: int) -> Model:
        names = sorted(counts)
        table = np.array([counts[n] for n in names], dtype=np.float64).reshape(-1, buckets)
        background = table.sum(axis=0) + 0.5
        background /= background.sum()
        p = (table + 50 * background) / (table.sum(axis=1, keepdims=True) + 50)
        return cls(names, np.log(p), p)

    def proportions(self, counts: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """EM over the languages in ``use`` (documents x languages): proportions and log-likelihoods."""
        p = self.p.astype(np.float32)
        total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
        pi = use / use.sum(axis=1, keepdims=True)
        for _ in range(STEPS):
            pi = pi * ((counts / np.maximum(pi @ p, 1e-30)) @ p.T) / total
            pi /= np.maximum(pi.sum(axis=1, keepdims=True), 1e-30)
        return pi, (counts * np.log(np.maximum(pi @ p, 1e-30))).sum(axis=1)

    def infer(self, counts: np.ndarray) -> np.ndarray:
        """Proportions of the languages of the chosen sets (documents x languages); others are 0."""
        n, k = len(counts), len(self.languages)
        single = counts @ self.log_p.T.astype(np.float32)
        best = np.zeros((n, k), dtype=np.float32)
        if k == 1:
            return best + 1
        everything, _ = self.proportions(counts, np.ones((n, k), dtype=np.float32))
        by_share = np.argsort(-everything, axis=1, kind="stable")
        first = np.argmax(single, axis=1)
        best[np.arange(n), first] = 1
        value = single[np.arange(n), first]
        cost = PENALTY * np.log2(2 + counts.sum(axis=1))
        open_ = np.arange(n)
        for size in range(2, min(MOST, k) + 1):
            # a set of one more language is tried only where EM gives its last member a share that could pay
            open_ = open_[everything[open_, by_share[open_, size - 1]] > 0.02]
            if not len(open_):
                break
            use = np.zeros((len(open_), k), dtype=np.float32)
            use[np.arange(len(open_))[:, None], by_share[open_, :size]] = 1
            pi, likelihood = self.proportions(counts[open_], use)
            net = likelihood - (size - 1) * cost[open_]
            better = net > value[open_]
            open_, pi, net = open_[better], pi[better], net[better]
            best[open_] = pi
            value[open_] = net
        return best


def fit(docs: DataFrame, learnable: Column, buckets: int = BUCKETS, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from the texts and languages of the rows for which ``learnable`` holds; rows with a null of either are left out.

    Languages are counted over all these rows; each gives those documents whose hashed id falls below per_language / count.
    """
    known = docs.where(learnable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # one row for each language
    if not sizes:
        return Model([], np.zeros((0, buckets)), np.zeros((0, buckets)))
    share = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, per_language / n)))])
    place = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.where(place < share[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for lang, text in zip(langs, texts, strict=True):
                own = sums.setdefault(lang, np.zeros(buckets))
                own += trigram_counts([text], buckets)[0]
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                              pa.array(own[at])], names=["lang", "bucket", "n"])

    summed = chosen.mapInArrow(count, "lang string, bucket int, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = {lang: np.zeros(buckets) for lang in sizes}
    for r in summed.collect():  # languages x buckets at most
        counts[r["lang"]][r["bucket"]] = r["n"]
    return Model.from_counts(counts, buckets)


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) of every row with lang_pred, score and mixture.

    ``lang_pred`` has the largest share in the chosen set (ties: the first by name), ``score`` is that share and ``mixture`` the
    shares of the whole set. Null texts, texts without any letter, and all texts if no language could be
    learned, are ``und`` with score 0 and an empty mixture. No row is dropped; columns
    named like the three new ones are replaced.
    """
    names = [c for c in (keep if keep is not None else docs.columns) if c not in ("lang_pred", "score", "mixture")]
    buckets = model.p.shape[1]
    rows_at_once = max(1, (1 << 20) // buckets)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, rows_at_once):
                batch = whole.slice(at, rows_at_once)
                texts = batch.column("__text").to_pylist()
                lettered = [has_letter(t) and bool(model.languages) for t in texts]
                pi = model.infer(trigram_counts([t if ok else "" for t, ok in zip(texts, lettered, strict=True)], buckets)) \
                    if model.languages else np.zeros((len(texts), 1))
                top = pi.argmax(axis=1)
                pred = [model.languages[i] if ok else UNKNOWN for i, ok in zip(top, lettered, strict=True)]
                score = np.where(lettered, np.clip(pi.max(axis=1).astype(float), 0, 1), 0.0)
                mixture = [[(model.languages[j], float(row[j])) for j in np.flatnonzero(row > 0)] if ok else []
                           for row, ok in zip(pi, lettered, strict=True)]
                columns = [batch.column(f"c{i}") for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(pred, pa.string()), pa.array(score),
                     pa.array(mixture, pa.map_(pa.string(), pa.float64()))],
                    names=[*[f"c{i}" for i in range(len(names))], "lang_pred", "score", "mixture"])

    work = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col("text").alias("__text"))
    types = T.StructType([*work.drop("__text").schema.fields, T.StructField("lang_pred", T.StringType()),
                          T.StructField("score", T.DoubleType()), T.StructField("mixture", T.MapType(T.StringType(), T.DoubleType()))])
    out = work.mapInArrow(predict, types)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "lang_pred", "score", "mixture")
