"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use for their results or their inner work.
CLASHING = ["score", "lang_pred", "host", "rule", "shard", "slot", "size", "row", "rep", "value", "kept", "component", "sequence_id",
            "start", "length", "h", "c0", "k", "url", "html", "quality", "toxic"]


def sentence(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def awkward(seed: int = 1) -> list[tuple]:
    """Nulls in every column, empty, blank, tiny and very long texts, ties and repeated rows."""
    rng = random.Random(seed)
    long = sentence(rng, 60_000, 5000)
    plain = [(i, sentence(rng, 40 + i), "en", "s", 1) for i in range(12)]
    return [
        (100, None, "en", "s", None), (101, "", "en", None, 0), (102, " \n\t ", None, "s", 3), (103, "one", "en", "s", 3),
        (104, "Two words", "en", "s", 9), (105, "42 !!! ???", "en", "s", 9), (106, long, "en", "s", len(long)),
        (107, "z" * 200_000, "de", "s", 200_000), (None, plain[3][1], None, None, None), (None, None, None, None, None),
        (108, plain[4][1], "en", "s", 1), (108, plain[4][1], "en", "s", 1), (109, plain[4][1], "en", "s", 1),
        (110, "Été déjà à l'œuvre, naïve façade \u3042\u3044 \U0001f600", "fr", "s", 1), *plain,
    ]


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(f"mine:{c}") for c in CLASHING if c not in df.columns})
