"""Ranked lexical search: term-at-a-time with a limit on new accumulators, over document blocks.

Two passes over the documents, none of which shuffles them:

1. statistics: documents with a term, all their terms, and the document frequency of every query term;
2. search: each task inverts its documents block by block and runs all items against a block, a term at a time, rarest first over the
   whole corpus. A term's bound is its highest contribution in the block. While the bounds of the terms to come
   together can reach the item's threshold, terms may create accumulators. From then on no document without one can
   get into the result, the accumulators that cannot get there either are dropped, and the rest of the terms only update
   the survivors, exactly.

An item's threshold in a block is the largest of the kth partial score there, the kth score of the task's blocks so far, and the kth score of
a first round over one share of the documents. So the tasks of the second round, over the rest, return few rows per item
however many there are. A threshold decides what is skipped and never what is found; ties at it are kept.

Items come in parts of bounded size to the driver and go to the executors as a broadcast; more items mean more passes.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlehouse.llm.common import checkpoint

#: Documents of a block, and bytes of text after which a block ends early; a longer text is a block by itself.
BLOCK_ROWS, BLOCK_BYTES = 8192, 32 << 20
#: Terms (with repeats over items) of a part of the items; an item with more is a part by itself.
PART_TERMS = 1 << 20
#: The first round searches one document in so many.
SHARES = 256

#: Bytes of terms: letters and digits of ASCII, lower-cased, and all bytes of other characters. Others part terms.
_TERM = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: str) -> list[bytes]:
    """Maximal runs of letters, digits and non-ASCII characters, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM).split()


@dataclass
class Part:
    """Some items: ``vocabulary`` numbers their terms; terms of item i are ``of[start[i]:start[i + 1]]``."""

    items: np.ndarray
    vocabulary: dict[bytes, int]
    of: np.ndarray
    start: np.ndarray


@dataclass
class Statistics:
    """Of all documents: how many have a term, terms with repeats, and document frequencies of a part's terms."""

    n: int
    length: int
    df: np.ndarray

    def weights(self) -> np.ndarray:
        return np.floor(1000 * np.log((2 * self.n + 2) / (2 * self.df + 1))).astype(np.int64)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the different terms of each item, over all rows that carry its id. Rows without an id or text give none."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = sorted(set(terms(text)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(found), pa.int64()), pa.array(found, pa.binary())], names=["item_id", "term"])

    rows = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("bigint"), "text")
    return rows.mapInArrow(split, "item_id bigint, term binary").distinct()


def parts(items: DataFrame, bound: int = PART_TERMS) -> Iterator[Part]:
    """The items in parts of about ``bound`` terms, dealt by a hash of the id. Each comes to the driver by itself."""
    found = checkpoint(item_terms(items))
    n = max(1, -(-found.count() // bound))
    for k in range(n):
        table = found.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).orderBy("item_id", "term").toArrow()
        if not table.num_rows:
            continue
        ids = table.column("item_id").to_numpy()
        words = table.column("term").to_pylist()
        vocabulary = {w: i for i, w in enumerate(sorted(set(words)))}
        items_, start = np.unique(ids, return_index=True)
        yield Part(items_, vocabulary, np.array([vocabulary[w] for w in words], np.int32), np.append(start, len(ids)))


def _blocks(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[dict[str, list]]:
    """Rows of a task in blocks that are bounded in rows and in bytes of text."""
    block, held = {c: [] for c in columns}, 0
    for batch in batches:
        texts = batch.column("text")
        for at in range(0, batch.num_rows, 64):
            piece = batch.slice(at, 64)
            for c in columns:
                block[c] += piece.column(c).to_pylist()
            held += texts.slice(at, 64).nbytes
            if held > BLOCK_BYTES or len(block["text"]) >= BLOCK_ROWS:
                yield block
                block, held = {c: [] for c in columns}, 0
    if block["text"]:
        yield block


def _counted(texts: list[str | None], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(term, document, occurrences) of the vocabulary's terms, by term and document, and the length of each document."""
    lengths, keys, counts = np.zeros(len(texts), np.int64), [], []
    width = len(vocabulary) + 1
    get = vocabulary.get
    for d, text in enumerate(texts):
        words = terms(text) if text else []
        lengths[d] = len(words)
        if words:
            found = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
            own, n = np.unique(found[found >= 0], return_counts=True)
            keys.append(own * len(texts) + d)
            counts.append(n)
    if not keys:
        none = np.zeros(0, np.int64)
        return none, none, none, lengths
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    assert width * max(1, len(texts)) < 1 << 62
    return key[order] // len(texts), key[order] % len(texts), count[order], lengths


def statistics(docs: DataFrame, part: Part) -> Statistics:
    """One pass; each task returns one row per query term it has met and one with its own totals."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(part.vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pickle.loads(shared.value)
        df, n, length = np.zeros(len(vocabulary), np.int64), 0, 0
        for block in _blocks(batches, ["text"]):
            term, _, _, lengths = _counted(block["text"], vocabulary)
            df += np.bincount(term, minlength=len(vocabulary))
            n, length = n + int((lengths > 0).sum()), length + int(lengths.sum())
        met = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(met, [-1, -2]), pa.int64()), pa.array(np.append(df[met], [n, length]), pa.int64())], names=["term", "n"])

    found = docs.select("text").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    totals = {r.term: r.n for r in found.collect()}  # one row per term of the part, which its bound limits
    df = np.zeros(len(part.vocabulary), np.int64)
    for t, n in totals.items():
        if t >= 0:
            df[t] = n
    return Statistics(totals.get(-1, 0), totals.get(-2, 0), df)


class Block:
    """Inverted lists of a block of documents with the contributions of each posting."""

    def __init__(self, texts: list[str | None], vocabulary: dict[bytes, int], stats: Statistics, weights: np.ndarray):
        term, self.document, tf, lengths = _counted(texts, vocabulary)
        m = 50 + (50 * lengths * stats.n) // max(1, stats.length)
        self.share = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[self.document]))
        self.rows = len(texts)
        self.first = np.searchsorted(term, np.arange(len(vocabulary) + 1))
        self.bound = np.zeros(len(vocabulary), np.int64)
        if len(term):
            there = np.flatnonzero(np.diff(self.first))
            self.bound[there] = np.maximum.reduceat(self.share, self.first[:-1][there])
        self.scores = np.zeros(len(texts), np.int64)
        self.seen = np.zeros(len(texts), bool)

    def search(self, wanted: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores that can be among the ``k`` best, of scores of at least ``least``. ``wanted`` are the item's terms, rarest first."""
        wanted = wanted[self.bound[wanted] > 0]
        bounds = self.bound[wanted]
        rest = np.append(np.cumsum(bounds[::-1])[::-1], 0)  # rest[i]: bound of the terms from i on
        scores, document, share, first = self.scores, self.document, self.share, self.first
        made: list[np.ndarray] = []  # documents with an accumulator, each once
        n, live, threshold = 0, None, least
        for i, t in enumerate(wanted):
            rows = slice(first[t], first[t + 1])
            docs, add = document[rows], share[rows]
            if live is None and rest[i] < threshold:
                live = self._survivors(made, rest[i], threshold)
            if live is None:
                scores[docs] += add
                new = docs[~self.seen[docs]]
                self.seen[new] = True
                made.append(new)
                n += len(new)
                if rest[i + 1] and n >= k:
                    partial = scores[np.concatenate(made)]
                    threshold = max(threshold, int(np.partition(partial, n - k)[n - k]))
            else:
                at = np.searchsorted(docs, live)
                at[at == len(docs)] = 0
                hit = docs[at] == live
                scores[live[hit]] += add[at[hit]]
        if live is None:
            live = self._survivors(made, 0, threshold)
        found = scores[live].copy()
        for docs in made:
            scores[docs], self.seen[docs] = 0, False
        if len(found) > k:
            least = max(least, int(np.partition(found, -k)[-k]))
        good = (found >= max(1, least))
        return live[good], found[good]

    def _survivors(self, made: list[np.ndarray], rest: int, threshold: int) -> np.ndarray:
        if not made:
            return np.zeros(0, np.int64)
        docs = np.concatenate(made)
        return docs[self.scores[docs] + rest >= threshold]


RESULT = "item_id bigint, doc_id bigint, score bigint"


def search(docs: DataFrame, part: Part, stats: Statistics, k: int, least: np.ndarray) -> DataFrame:
    """(item_id, doc_id, score): of each task, what can be among the ``k`` best of an item, given that ``k`` documents reach ``least``."""
    weights = stats.weights()
    order = [w[np.lexsort((w, stats.df[w]))] for w in (part.of[a:b] for a, b in zip(part.start, part.start[1:], strict=False))]
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps((part, stats, weights, order, least)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stats, weights, order, least = pickle.loads(shared.value)
        least = least.copy()
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(order)  # of each item: place in ids, score
        ids: list[int | None] = []
        for rows in _blocks(batches, ["doc_id", "text"]):
            block = Block(rows["text"], part.vocabulary, stats, weights)
            for i, wanted in enumerate(order):
                at, score = block.search(wanted, k, int(least[i]))
                if not len(at):
                    continue
                at, score = np.concatenate([held[i][0], at + len(ids)]), np.concatenate([held[i][1], score])
                if len(score) > k:
                    least[i] = max(least[i], np.partition(score, len(score) - k)[len(score) - k])
                    at, score = at[score >= least[i]], score[score >= least[i]]
                held[i] = at, score
            ids += rows["doc_id"]
        docs_ = pa.array(ids, pa.int64())
        for i, (at, score) in enumerate(held):
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), part.items[i])), docs_.take(pa.array(at)), pa.array(score)], names=["item_id", "doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, RESULT)


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each item with their rank: highest score first, equal scores by ascending doc_id, those without one last."""
    place = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of the highest score above 0 for each item; fewer, if there are fewer.

    ``docs`` has doc_id and text, ``items`` has item_id and text; other columns are not read. Every row of ``docs`` is a document,
    rows that repeat an id too; one without an id counts, and is ranked behind those of its score. A null text has no terms. Rows of
    ``items`` that share an id are one item with all their terms; rows without an id are none. An item without a
    term in any document has no result, and without documents or items the result is empty.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], T.StructType.fromDDL("item_id bigint, rank int, doc_id bigint, score bigint"))
    share = F.pmod(F.xxhash64("doc_id", F.length("text"), F.lit(3)), F.lit(SHARES))
    for part in parts(items):
        stats = statistics(docs, part)
        if not stats.n:
            continue
        first = checkpoint(best(search(docs.where(share == 0), part, stats, k, np.zeros(len(part.items), np.int64)), k).drop("rank"))
        kth = first.groupBy("item_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
        known = {r.item_id: r.least for r in kth.collect()}  # one row per item of the part
        least = np.array([known.get(int(i), 0) for i in part.items], np.int64)
        rest = search(docs.where(share != 0), part, stats, k, least)
        out = out.unionByName(best(first.unionByName(rest), k))
    return out
