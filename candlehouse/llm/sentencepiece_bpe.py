"""Exact token ids of merge-type (BPE) sentencepiece models by backtracking, and the way back.

A merge-type encoder starts from single characters and joins, again and again, the neighbouring pair whose join is the piece of the
highest score, the leftmost of equals. A sequence of pieces is its result for their joined text if and only if that holds
for every two neighbours: up to the first merge across a border, the merges inside two neighbours are the same ones in the same
order as in the text of these two alone. So a text is encoded from left to right: take the longest piece that fits (an Aho-Corasick
automaton finds it), keep it if it goes with the piece before (found by merging the two anew, remembered per pair), else try the next
shorter one, and step back where none is left. Each prefix has one encoding only, so a position that has failed once is marked in a bitfield
and never entered again: the work is linear in the text, also where it has no white space.

Where no piece of the model holds two characters side by side, a text can be cut between them: before a space, mostly, and inside a word before
or behind signs. Words and their parts are encoded once per worker and remembered in bounded tables.
"""

from __future__ import annotations

import codecs
from array import array
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Mark of a space in pieces; a fixed value of the model format.
SPACE = "▁"
#: Entries of each of a worker's tables (words, parts, pairs of pieces) and of its predecessor at most; longer words are not remembered.
REMEMBERED, WORD = 3 << 17, 64
#: Texts that are converted together.
ROWS = 256


def _replace_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("candlehouse-replace-byte", _replace_byte)


class Memory(dict):
    """A bounded table: when it is full it becomes the old one, of which what is asked for again moves on."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= WORD:
            self[key] = value
        return value


class Encoder:
    """Encoder and decoder of one model file. Only models of plain pieces with byte fallback are taken."""

    TRIAL = ["", " ", "Hello, world's 42  ünïcöde…\n\n\tx", "a" * 40 + " " * 40 + "\U0001f600<s>▁"]

    def __init__(self, path: str):
        import ahocorasick
        import regex
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        if any(model.is_unused(i) for i in every):
            raise ValueError(f"{path} has unused pieces, which a plain merge-type encoder does not know")
        self.bytes = {int(model.id_to_piece(i)[1:-1], 16): i for i in every if model.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError(f"{path} has no byte fallback")
        plain = [i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.ids = {model.id_to_piece(i): i for i in plain}
        self.scores = {piece: model.get_score(i) for piece, i in self.ids.items()}
        self.fits = Memory(lambda pair: self.merge("".join(pair)) == list(pair))
        self.words, self.parts, self.numbers = Memory(self.word), Memory(self.part), Memory(self._numbers)
        joined = [p for p in self.ids if len(p) > 1]
        reachable = [p for p in joined if self.merge(p) == [p]]
        self.automaton = ahocorasick.Automaton()
        for piece in [*reachable, *(p for p in self.ids if len(p) == 1)]:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        #: shorter[p]: the longest piece that begins p, itself apart
        known = set(reachable) | {p for p in self.ids if len(p) == 1}
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in known), None) for p in known}
        #: characters that stand side by side in some piece
        self.together = {p[i:i + 2] for p in joined for i in range(len(p) - 1)}
        self.by_word = not any(pair[1] == SPACE != pair[0] for pair in self.together)
        self.spaced = regex.compile(f"{SPACE}+[^{SPACE}]*")
        self.letters = [self._letter(i) for i in every]
        self.strips = model.normalize("a").startswith(SPACE)
        for text in self.TRIAL:
            if self.encode(text) != model.encode(text) or self.decode(self.encode(text)) != model.decode(model.encode(text)):
                raise ValueError(f"{path} is not a merge-type model with plain pieces")

    def _letter(self, i: int) -> str:
        """What a piece gives in a decoded text; a byte above 127 as a lone surrogate until all bytes are together."""
        if self.model.is_byte(i):
            byte = int(self.model.id_to_piece(i)[1:-1], 16)
            return chr(byte) if byte < 128 else chr(0xDC00 + byte)
        if self.model.is_control(i):
            return ""
        return self.model.decode([i]) if self.model.is_unknown(i) else self.model.id_to_piece(i).replace(SPACE, " ")

    def _numbers(self, piece: str) -> bytes:
        """A piece's id as a 32-bit number of this machine; of a character without a piece, those of its bytes."""
        found = self.ids.get(piece)
        return array("i", [self.bytes[b] for b in piece.encode()] if found is None else [found]).tobytes()

    def merge(self, text: str) -> list[str]:
        """The definition: pieces of a short text by merging."""
        pieces, scores = list(text), self.scores
        while True:
            best, at = None, -1
            for i in range(len(pieces) - 1):
                score = scores.get(pieces[i] + pieces[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return pieces
            pieces[at:at + 2] = [pieces[at] + pieces[at + 1]]

    def word(self, key: str) -> bytes:
        """Ids of a space and ``key``."""
        return self.part(SPACE + key) if key.isalpha() else self.run(SPACE + key)

    def run(self, text: str) -> bytes:
        """Ids of a text, cut where no piece can span."""
        together = self.together
        ends = [i for i in range(1, len(text)) if text[i - 1:i + 1] not in together]
        if not ends:
            return self.part(text)
        cut = [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)], strict=True)]
        return b"".join([self.words[one[1:]] if one[0] == SPACE and one[1:].isalpha() else self.parts[one] for one in cut])

    def part(self, text: str) -> bytes:
        """Ids of a part by backtracking. Characters without a piece of their own stand alone and become bytes."""
        n, longest = len(text), {}
        for end, piece in self.automaton.iter(text):  # of one end the longest comes first, so of one start the longest comes last
            longest[end - len(piece) + 1] = piece
        failed, marked = bytearray(n // 8 + 1), False
        pieces: list[str] = []
        before, at, piece = None, 0, longest.get(0, text[0])
        fits, shorter = self.fits, self.shorter
        while True:
            while piece is not None:
                end = at + len(piece)
                if not (marked and failed[end >> 3] >> (end & 7) & 1) and (before is None or fits[before, piece]):
                    break
                piece = shorter.get(piece)
            if piece is None:  # nothing goes on from here: step back
                failed[at >> 3] |= 1 << (at & 7)
                marked = True
                piece = pieces.pop()
                before = pieces[-1] if pieces else None
                at -= len(piece)
                piece = shorter.get(piece)
                continue
            pieces.append(piece)
            before, at = piece, end
            if at == n:
                return b"".join([self.numbers[piece] for piece in pieces])
            piece = longest.get(at) or text[at]

    def packed(self, text: str) -> bytes:
        """Ids of a text as 32-bit numbers of this machine."""
        text = self.model.normalize(text)
        if not self.by_word or not text.startswith(SPACE):
            return self.run(text) if text else b""
        keys = text.split(SPACE)[1:]
        if "" in keys:  # a run of spaces goes with the word behind it
            keys = [run[1:] for run in self.spaced.findall(text)]
        words = self.words
        return b"".join([words[key] for key in keys])

    def encode(self, text: str) -> list[int]:
        return array("i", self.packed(text)).tolist()

    def decode(self, ids) -> str:
        """Any ids to text: bytes together where they make characters, each other byte as U+FFFD."""
        letters = self.letters
        text = "".join([letters[i] for i in ids])
        if self.strips and text.startswith(" ") and self._first_is_plain(ids):
            text = text[1:]
        try:
            text.encode()
        except UnicodeEncodeError:
            text = text.encode(errors="surrogateescape").decode(errors="candlehouse-replace-byte")
        return text

    def _first_is_plain(self, ids) -> bool:
        """Whether the first letters come from a plain piece: a space that is a byte stays."""
        first = next(i for i in ids if self.letters[i])
        return not self.model.is_byte(first) and not self.model.is_unknown(first)


ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and model."""
    if path not in ENCODERS:
        ENCODERS[path] = Encoder(path)
    return ENCODERS[path]


def _mapped(docs: DataFrame, keep: list[str], value: str, added: str, convert) -> DataFrame:
    """``keep`` and a column that ``convert`` makes of ``value``, in parts of a batch, so that few converted texts are held."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), F.col(value))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                yield pa.RecordBatch.from_arrays([part.column(0), convert(part.column(1))], names=["kept", added])

    kind = {"ids": "array<int>", "decoded": "string"}[added]
    schema = f"kept {rows.schema['kept'].dataType.simpleString()}, {added} {kind}"
    return rows.mapInArrow(run, schema).select("kept.*", added)


def encode(docs: DataFrame, model: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``ids`` (array of int) of every whole ``text``, without begin or end ids.

    A null text counts as empty and has no ids; every row stays, repeated ones too. ``model`` is a path that every executor can
    read. Only ``keep`` and ``text`` are read; ``keep`` must not hold ``ids``.
    """
    def convert(texts: pa.Array) -> pa.Array:
        code = encoder(model)
        return _lists([code.packed(t or "") for t in texts.to_pylist()])

    return _mapped(docs, keep, "text", "ids", convert)


def _lists(ids: list[bytes]) -> pa.Array:
    """Arrow lists of packed 32-bit numbers, without a Python number for each."""
    offsets = array("i", [0, *accumulate(len(one) // 4 for one in ids)])
    flat = b"".join(ids)
    return pa.ListArray.from_arrays(pa.Array.from_buffers(pa.int32(), len(offsets), [None, pa.py_buffer(offsets)]),
                                    pa.Array.from_buffers(pa.int32(), len(flat) // 4, [None, pa.py_buffer(flat)]))


def decode(encoded: DataFrame, model: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``decoded``, the text of the ids in ``ids``; null ids give an empty text."""
    def convert(ids: pa.Array) -> pa.Array:
        code = encoder(model)
        numbers, ends = ids.values.to_numpy(), ids.offsets.to_numpy()  # a null list has equal ends
        return pa.array([code.decode(numbers[a:b].tolist()) for a, b in zip(ends, ends[1:], strict=False)], pa.string())

    return _mapped(encoded, keep, "ids", "decoded", convert)
