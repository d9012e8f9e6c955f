"""Best-fit packing of documents into sequences of fixed capacity, planned by non-negative least squares.

Documents become token ids with one separator behind them; longer ones are cut into pieces of the capacity. Only the
histogram of piece lengths (``capacity`` numbers at most) goes to the driver. There

1. patterns of few documents whose lengths add up to the capacity are enumerated (all pairs, and triples spread
   evenly over the lengths),
2. ``min ||W(Ax - h)||`` over x >= 0 gives repeat counts x for the patterns A and the histogram h; rows are
   weighted by length, since long pieces are hard to place later,
3. counts are rounded, never taking more pieces of a length than there are,
4. the residual is packed by best fit, longest first, on the histogram: pieces of one length go together into all sequences
   with the same free space, so the work follows the distinct lengths and not the documents.

The plan is a list of intervals: the pieces of length l with ranks r0..r1 lie in sequences s0, s0 + 1, ... It has at most a few
rows per pattern and length, whatever the input. Ranks within a length are numbered in buckets, so a length that holds a third of all pieces
is spread over many tasks.
"""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlehouse.llm.common import checkpoint, small_batches
from candlehouse.llm.words import grouped

CAPACITY = 2048
#: Pieces of one length that are numbered together.
BUCKET_ROWS = 4096
#: Enumerated triples at most; pairs come on top.
TRIPLES = 6000
#: Words, and parts of words, whose ids a worker remembers: about 150 MB.
REMEMBERED, REMEMBERED_PARTS = 1 << 19, 1 << 18

#: ASCII characters that a tokenizer may drop or take as white space other than Python does.
CONTROLS = [chr(c) for c in (*range(32), 127) if chr(c) not in "\t\n\r"]


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 stands for itself, the rest from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {b: chr(b) for b in own}
    for i, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + i)
    return letters


class Encoder:
    """Token ids as little-endian unsigned 32-bit numbers, the same as the tokenizer's own for every text.

    A tokenizer that lower-cases, cuts a text by a pattern that takes no white space, and turns each part into ids by itself
    gives a text the ids of its words in turn. So words and their parts are encoded once per worker and remembered.
    That holds for the characters in ``plain``; other texts, texts that hold a special token, and
    tokenizers of another build are encoded as a whole.
    """

    TRIAL = "Hello, world's 42 \u00fcn\u00efc\u00f6de\u2026 d'accord!!! (x_y) \u00bd\u00e9t\u00e9 A\tB\n\nIt'll ## --"

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = regex.compile("[\t\n\r\x20-\x7e\xa0-\u024f\u2010-\u2027\u2030-\u205e]*")
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        build = json.loads(self.tokenizer.to_str())
        cut = (build.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        pattern = (cut[0].get("pattern") or {}).get("Regex")
        self.by_word = False
        if pattern and cut[0].get("invert") and cut[0].get("behavior") == "Removed":
            self.pattern = regex.compile(pattern)
            self.by_word = b"".join(map(self._word, self.TRIAL.split())) == self.ids(self.TRIAL)

    def ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a word without white space, remembered."""
        parts, out = self.parts, []
        for part in self.pattern.findall(word.lower()):
            ids = parts.get(part)
            if ids is None:
                spelled = part if part.isascii() else "".join([self.letters[b] for b in part.encode()])
                ids = parts[part] = b"".join([t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(spelled)])
            out.append(ids)
        ids = self.known[word] = b"".join(out)
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        for memory, most in ((self.known, REMEMBERED), (self.parts, REMEMBERED_PARTS)):
            if len(memory) > most:
                memory.clear()
        known, new, out = self.known, self._word, []
        for text in texts:
            if not self._simple(text):
                out.append(self.ids(text))
                continue
            words = text.split()
            for word in set(words).difference(known):
                new(word)
            out.append(b"".join([known[w] for w in words]))
        return out

    def _simple(self, text: str) -> bool:
        return (self.by_word and (text.isascii() or self.plain.fullmatch(text) is not None and unicodedata.is_normalized("NFC", text))
                and not any(c in text for c in CONTROLS) and not any(s in text for s in self.special))


ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and vocabulary."""
    if path not in ENCODERS:
        ENCODERS[path] = Encoder(path)
    return ENCODERS[path]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, separator: int = 0, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids, if asked for).

    Null text counts as empty: such a document is its separator alone. Every row of ``docs`` is a document of its own, repeated
    ids too. ``vocabulary`` is a path that every executor can read. Only doc_id and text are read.
    """
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<bigint>" if keep_ids else "")
    end = int(separator).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary)
        for batch in batches:
            for part, texts in grouped(batch):
                rows = defaultdict(list)
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), code.encode(texts), strict=True):
                    ids += end
                    for k, byte in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[byte:byte + 4 * capacity]
                        rows["doc_id"].append(doc_id)
                        rows["piece"].append(k)
                        rows["start"].append(byte // 4)
                        rows["length"].append(len(own) // 4)
                        rows["ids_crc32"].append(zlib.crc32(own))
                        if keep_ids:
                            rows["ids"].append(np.frombuffer(own, dtype="<u4").astype(np.int64))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types, strict=False)], names=list(rows))

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def patterns(counts: np.ndarray, capacity: int, most: int = TRIPLES) -> np.ndarray:
    """Triples (a <= b <= c, a = 0 for pairs) of lengths in use that add up to the capacity."""
    used = np.flatnonzero(counts)
    used = used[(used > 0) & (used < capacity)]
    there = np.zeros(capacity + 1, dtype=bool)
    there[used] = True
    low = used[2 * used <= capacity]
    pairs = low[there[capacity - low]]
    out = [np.stack([np.zeros_like(pairs), pairs, capacity - pairs], axis=1)]
    triples = []
    for c in used[3 * used >= capacity]:
        rest = capacity - c
        b = used[(used <= c) & (2 * used >= rest) & (used < rest)]
        a = rest - b
        ok = there[a]
        triples.append(np.stack([a[ok], b[ok], np.full(ok.sum(), c)], axis=1))
    found = np.concatenate(triples) if triples else np.zeros((0, 3), dtype=np.int64)
    if len(found) > most:
        # the most plentiful first: a pattern repeats as often as its rarest member at best
        plenty = np.minimum(np.minimum(counts[found[:, 0]], counts[found[:, 1]]), counts[found[:, 2]])
        spread = (found[:, 0] * 7919 + found[:, 1] * 104729) % 65537
        found = found[np.lexsort((spread, -plenty))[:most]] if plenty.max() > 1 else found[np.argsort(spread, kind="stable")[:most]]
    return np.concatenate([*out, found]).astype(np.int64)


def nnls(rows: np.ndarray, weights: np.ndarray, h: np.ndarray, steps: int = 400) -> np.ndarray:
    """x >= 0 that minimises ||W(Ax - h)||, A's columns being the patterns in ``rows``: accelerated projected gradient."""
    w2 = weights**2 * (np.arange(len(h)) > 0)
    ax = lambda x: sum(np.bincount(rows[:, i], x, len(h)) for i in range(rows.shape[1]))
    at = lambda r: sum((w2 * r)[rows[:, i]] for i in range(rows.shape[1]))
    v = np.ones(len(rows))
    for _ in range(20):
        v = at(ax(v))
        v /= np.linalg.norm(v)
    step = 1 / (1.05 * np.linalg.norm(at(ax(v))) + 1e-12)
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - step * at(ax(y) - h))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if np.dot(y - new, new - x) > 0:  # overshoot: start the acceleration anew
            t_new = 1.0
        y, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    return x


def plan(counts: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Groups of equal sequences: ([(length, how many of it)], how many sequences). Every piece is in exactly one."""
    left = counts.astype(np.int64).copy()
    groups: list[tuple[list[tuple[int, int]], int]] = []
    if left[capacity]:
        groups.append(([(capacity, 1)], int(left[capacity])))
        left[capacity] = 0
    triples = patterns(left, capacity)
    if len(triples):
        h = left.astype(float)
        h[0] = 0
        x = nnls(triples, np.sqrt(np.arange(capacity + 1) / capacity), h)
        for k in np.argsort(-x, kind="stable"):
            need = defaultdict(int)
            for length in triples[k]:
                if length:
                    need[int(length)] += 1
            times = min(int(round(x[k])), *(int(left[length]) // n for length, n in need.items()))
            if times > 0:
                for length, n in need.items():
                    left[length] -= n * times
                groups.append((sorted(need.items()), times))
    # residual: free space -> sequences (their members, how many) with that much
    open_: dict[int, list[tuple[list[tuple[int, int]], int]]] = defaultdict(list)
    free = np.zeros(capacity + 1, dtype=bool)
    for length in range(capacity - 1, 0, -1):
        n = int(left[length])
        while n:
            fits = np.flatnonzero(free[length:])
            room = length + int(fits[0]) if len(fits) else capacity
            members, there = open_[room].pop() if len(fits) else ([], -(-n // (capacity // length)))
            free[room] = bool(open_[room])
            each = min(room // length, n)
            take = min(there, n // each)
            if take < there and len(fits):
                open_[room].append((members, there - take))
                free[room] = True
            open_[room - each * length].append(([*members, (length, each)], take))
            free[room - each * length] = True
            n -= take * each
    for members_and_count in chain.from_iterable(open_.values()):
        groups.append(members_and_count)
    return groups


def intervals(groups: list[tuple[list[tuple[int, int]], int]]) -> np.ndarray:
    """Rows (length, first rank, pieces per sequence, first sequence, offset), sorted by length and rank."""
    used: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for members, times in groups:
        offset = 0
        for length, each in members:
            out.append((length, used[length], each, sequence, offset))
            used[length] += each * times
            offset += each * length
        sequence += times
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 5)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (rows of :func:`pieces`, or any with doc_id, piece and length from 1 to the capacity) with sequence_id and offset.

    Offsets in a sequence leave no gap from 0. Empty input gives an empty result. The rows are written once to the
    shared folder, so that they keep their order while they are counted and numbered; that order deals them to
    buckets, hence repeated ids don't meet in one.
    """
    cut = checkpoint(cut)
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in cut.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["count"]
    table = intervals(plan(counts, capacity))
    buckets = cut.sparkSession.createDataFrame(
        [(int(k), int(-(-n // BUCKET_ROWS))) for k, n in enumerate(counts) if n], "length bigint, __buckets bigint")
    dealt = (cut.withColumn("__row", F.monotonically_increasing_id()).join(F.broadcast(buckets), "length")
             .withColumn("__bucket", F.pmod(F.xxhash64("__row"), F.col("__buckets"))))
    per = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy("length", "__bucket").count()
              .select("length", "__bucket", F.coalesce(F.sum("count").over(per), F.lit(0)).alias("__first")))
    within = Window.partitionBy("length", "__bucket").orderBy("__row")
    ranked = (dealt.withColumn("__in", F.row_number().over(within) - 1).join(starts, ["length", "__bucket"])
              .withColumn("__rank", F.col("__first") + F.col("__in")).drop("__in", "__first", "__bucket", "__buckets", "__row"))
    names = [c for c in cut.columns]
    key = table[:, 0] * (1 << 48) + table[:, 1] if len(table) else np.zeros(0, dtype=np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("__rank").to_numpy(zero_copy_only=False).astype(np.int64)
            own = table[np.searchsorted(key, length * (1 << 48) + rank, side="right") - 1]
            j = rank - own[:, 1]
            columns = [batch.column(c) for c in names]
            columns += [pa.array(own[:, 3] + j // own[:, 2]), pa.array(own[:, 4] + j % own[:, 2] * length)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """The place of every piece of ``docs``; see :func:`pieces` and :func:`pack`. The texts are encoded once."""
    return pack(pieces(docs, vocabulary, capacity), capacity)
