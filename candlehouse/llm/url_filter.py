"""URL rules as globs, matched all at once by a bit-parallel wildcard automaton (multiword Shift-And).

Every glob is a run of bits in one row of 64-bit words: a start bit, then one bit for each character or ``?``.
Reading character c turns the states S of a URL into

    (S << 1) & enter[c]  |  S & stay[c]

where ``enter[c]`` has the bits whose character is c, and ``stay[c]`` the bits followed by a star that takes c. One such step
serves all globs; numpy runs it for all URLs of a batch, so the cost is URL characters times words, whatever the rules hold.

Globs: ``?`` one character but ``/``; ``*`` any run without ``/``; ``**`` any run. All else stands for itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Characters of a batch that are matched at a time.
BLOCK = 1 << 20


@dataclass(frozen=True)
class Rule:
    """``verdict`` for the host (with its subdomains) and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    def globs(self) -> list[str]:
        quoted = self.host + self.path
        if set("*?") & set(quoted):
            raise ValueError("a host rule holds no wildcards")
        return [f"{quoted}**", f"*.{quoted}**"]


class Automaton:
    """All ``globs`` in one state row. ``matches`` tells for each URL the first glob (in the given order) that takes it whole, or -1."""

    def __init__(self, globs: Sequence[str]):
        tokens = [self._tokens(g) for g in globs]
        literals = sorted({c for t in tokens for c, _ in t if c is not None and c != ""} | {"/"})
        self.codes = np.array([ord(c) for c in literals], dtype=np.uint32)
        other = len(literals)  # the class of all characters that no glob names
        bits = sum(1 + len(t) for t in tokens)
        self.words = max(1, -(-bits // 64))
        self.enter = np.zeros((other + 1, self.words), dtype=np.uint64)
        self.stay = np.zeros((other + 1, self.words), dtype=np.uint64)
        self.start = np.zeros(self.words, dtype=np.uint64)
        self.final: list[tuple[int, np.uint64]] = []
        slash, at = literals.index("/"), 0

        def put(mask: np.ndarray, classes, bit: int) -> None:
            mask[classes, bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

        everything = np.arange(other + 1)
        no_slash = everything[everything != slash]
        for glob, run in zip(globs, tokens, strict=True):
            self.start[at // 64] |= np.uint64(1) << np.uint64(at % 64)
            lead = self._lead(glob)
            if lead:
                put(self.stay, everything if lead == 2 else no_slash, at)
            for c, star in run:
                at += 1
                put(self.enter, no_slash if c == "" else literals.index(c), at)
                if star:
                    put(self.stay, everything if star == 2 else no_slash, at)
            self.final.append((at // 64, np.uint64(1) << np.uint64(at % 64)))
            at += 1

    @staticmethod
    def _lead(glob: str) -> int:
        return 0 if not glob.startswith("*") else 2 if glob.startswith("**") else 1

    @staticmethod
    def _tokens(glob: str) -> list[tuple[str, int]]:
        """(character, or "" for ``?``; 0, 1 or 2 for no star, ``*``, ``**`` behind it)."""
        out, i = [], 0
        while i < len(glob):
            stars = 0
            while i < len(glob) and glob[i] == "*":
                stars, i = stars + 1, i + 1
            if stars and out:
                out[-1] = (out[-1][0], max(out[-1][1], min(stars, 2)))
            if i < len(glob):
                out.append(("" if glob[i] == "?" else glob[i], 0))
                i += 1
        return out

    def matches(self, urls: Sequence[str]) -> np.ndarray:
        result = np.full(len(urls), -1, dtype=np.int32)
        lengths = np.array([len(u) for u in urls], dtype=np.int64)
        order = np.argsort(lengths, kind="stable")
        at = 0
        while at < len(order):  # URLs of like length together; a block holds at most BLOCK characters, or one URL
            end = at + 1
            while end < len(order) and (end + 1 - at) * lengths[order[end]] <= BLOCK:
                end += 1
            rows = order[at:end]
            result[rows] = self._block([urls[i] for i in rows], lengths[rows])
            at = end
        return result

    def _block(self, urls: list[str], lengths: np.ndarray) -> np.ndarray:
        width = int(lengths[-1]) if len(lengths) else 0
        classes = np.full((len(urls), width), len(self.codes), dtype=np.int64)
        text = np.frombuffer("".join(urls).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        where = np.minimum(np.searchsorted(self.codes, text), len(self.codes) - 1)
        classes[np.arange(width) < lengths[:, None]] = np.where(self.codes[where] == text, where, len(self.codes))
        state = np.tile(self.start, (len(urls), 1))
        one, top = np.uint64(1), np.uint64(63)
        for i in range(width):
            live = np.searchsorted(lengths, i, side="right")  # shorter ones come first and are done
            s, c = state[live:], classes[live:, i]
            moved = s << one
            moved[:, 1:] |= s[:, :-1] >> top
            state[live:] = (moved & self.enter[c]) | (s & self.stay[c])
        found = np.full(len(urls), -1, dtype=np.int32)
        for k in range(len(self.final) - 1, -1, -1):
            word, bit = self.final[k]
            found[(state[:, word] & bit) != 0] = k
        return found


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_after(url), r"\A[^/?#]*", 0), UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def _after(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")


def judge(pages: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    The longest rule (host and path) that fits decides, ties going to the longer host and then to ``block``; where none
    fits, rule is null and the verdict is ``default``. Null, empty and hostless URLs have an empty host and path and fit no rule.
    Rows keep their number and all their columns, except that columns named like the four new ones are replaced.
    """
    names = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    ranked = sorted(rules, key=lambda r: (-len(r.host + r.path), -len(r.host), r.verdict != "block", r.host))
    globs = [(g, i) for i, r in enumerate(ranked) for g in r.globs()]

    @F.pandas_udf("int")
    def first_rule(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = Automaton([g for g, _ in globs])
        owner = np.array([i for _, i in globs] + [-1], dtype=np.int32)  # -1 picks the last
        for urls in parts:
            yield pd.Series(owner[automaton.matches(urls.tolist())])

    rules_ = F.array(*[F.lit(r.host + r.path) for r in ranked]) if ranked else F.array().cast("array<string>")
    verdicts = F.array(*[F.lit(r.verdict) for r in ranked]) if ranked else F.array().cast("array<string>")
    fits = F.col("first") >= 0

    def of_rule(values: Column) -> Column:  # element_at never sees a null index, which Spark 4.1 reads as the last
        return F.when(fits, F.element_at(values, F.greatest(F.col("first"), F.lit(0)) + 1))

    at = F.col(f"`{url}`")
    return (pages.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), host_of(at).alias("host"), path_of(at).alias("path"))
            .withColumn("first", first_rule(F.concat("host", "path")))
            .select("row.*", "host", "path", of_rule(rules_).alias("rule"), F.coalesce(of_rule(verdicts), F.lit(default)).alias("verdict")))
