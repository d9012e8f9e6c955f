"""Words of many texts as 64-bit hashes, computed by numpy over whole batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed at a time. A single longer word is hashed as a whole.
SLICE = 1 << 19
#: Texts of a batch that are handled together, by bytes; a longer text goes alone.
GROUP = 2 << 20

U = np.uint64
MASK = (1 << 64) - 1


def _powers(n: int) -> np.ndarray:
    return np.concatenate([[U(1)], np.cumprod(np.full(n - 1, 0x9E3779B97F4A7C15, dtype=U), dtype=U)]) if n else np.zeros(0, U)


def _byte_values() -> np.ndarray:
    """A fixed 64-bit number for each byte, from the splitmix64 sequence."""
    return scramble(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))


def scramble(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finisher: a bijection on 64-bit numbers that spreads all bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def byte_set(members: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[np.frombuffer(members, dtype=np.uint8)] = True
    return table


#: Bytes between words of the contract `[^\\x20\\x09-\\x0D]+`.
SPACES = byte_set(b"\x20\x09\x0a\x0b\x0c\x0d")
#: All ASCII but letters and digits; bytes of other characters belong to words.
MARKS = byte_set(bytes(b for b in range(128) if not chr(b).isalnum()))


@dataclass
class Words:
    """Words of several texts in order: ``text`` is each word's text (ascending), ``hash`` its hash."""

    text: np.ndarray
    hash: np.ndarray
    size: np.ndarray
    first: np.ndarray  # of each text: its first word; one more entry closes the last
    prefix: dict[int, np.ndarray]


_VALUES = _byte_values()
_POWERS = _powers(4096)


def hash_words(texts: Sequence[bytes], between: np.ndarray, prefixes: Sequence[int] = ()) -> Words:
    """Hashes of the words of ``texts``, and of their first so many bytes (of words longer than that; else 0).

    ``between`` marks the bytes that separate words and must hold the line feed.
    """
    joined = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    starts_of, hashes, sizes, pre = [], [], [], {p: [] for p in prefixes}
    at = 0
    while at < len(joined):
        stop = min(at + SLICE, len(joined))
        if stop < len(joined):  # cut behind a separator: the last in reach, else the next
            gaps = np.flatnonzero(between[joined[at:stop]])
            while not len(gaps):
                reach = min(stop + SLICE, len(joined))
                gaps = np.flatnonzero(between[joined[stop:reach]])[:1] + (stop - at)
                stop = reach
            stop = at + int(gaps[-1]) + 1
        part = joined[at:stop]
        inside = np.flatnonzero(~between[part])
        if len(inside):
            new = np.empty(len(inside), dtype=bool)
            new[0] = True
            np.not_equal(np.diff(inside), 1, out=new[1:])
            heads = np.flatnonzero(new)
            lengths = np.diff(np.append(heads, len(inside)))
            place = np.arange(len(inside)) - np.repeat(heads, lengths)
            longest = int(lengths.max())
            powers = _POWERS if longest <= len(_POWERS) else _powers(longest)
            terms = _VALUES[part[inside]] * powers[place]
            hashes.append(scramble(np.add.reduceat(terms, heads) + lengths.astype(U)))
            starts_of.append(inside[heads] + at)
            sizes.append(lengths)
            for p in prefixes:
                own = np.add.reduceat(np.where(place < p, terms, U(0)), heads)
                pre[p].append(np.where(lengths > p, scramble(own ^ U(p * 0xD6E8FEB86659FD93 & MASK)), U(0)))
        at = stop
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, dtype=kind)
    where = join(starts_of, np.int64)
    text = np.searchsorted(ends, where, side="right")
    first = np.searchsorted(text, np.arange(len(texts) + 1))
    return Words(text, join(hashes, U), join(sizes, np.int64), first, {p: join(v, U) for p, v in pre.items()})


def grouped(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of ``batch`` with their texts (null: empty) of about GROUP bytes at most."""
    texts = batch.column(column)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    at, size = 0, 0
    for i, n in enumerate([2 * x for x in sizes] + [None]):  # None: the end
        if i > at and (n is None or size + n > GROUP):
            yield batch.slice(at, i - at), [x or "" for x in texts.slice(at, i - at).to_pylist()]
            at, size = i, 0
        size += n or 0
    pa.default_memory_pool().release_unused()


def encoded(texts: Sequence[str]) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts]


def ascii_lower(data: bytes) -> bytes:
    """``bytes.lower`` changes A-Z alone."""
    return data.lower()
