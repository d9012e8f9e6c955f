"""Backtracking encoder and decoder against the library."""

import random

import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

from candlehouse.llm import sentencepiece_bpe as S
from llm.frames import DOCS, awkward, with_clashes

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [" ", "  ", "   ", "▁", "a", "b", "the", "ing", "\n", "\t", "\x00", "\x01", "\x7f", "\x85", "\xa0", "é", "é", "😀", "한", "国", "<s>",
         "</s>", "<0x0A>", "<unk>", "1", "2024", "!", "...", "​", "", "zz", "=", "--", "ा", "ш", "　"]


@pytest.fixture(scope="module")
def code():
    return S.Encoder(MODEL)


@settings(max_examples=1500, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(PARTS), max_size=40).map("".join)))
@example("")
@example(" " * 33 + "a")
@example("▁▁ ▁")
def test_ids_and_text_of_the_library(text):
    code = S.encoder(MODEL)
    ids = code.model.encode(text)
    assert code.encode(text) == ids
    assert code.decode(ids) == code.model.decode(ids)


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 262), st.just(28_705)), max_size=12))
def test_any_ids_decode_as_in_the_library(ids):
    code = S.encoder(MODEL)
    assert code.decode(ids) == code.model.decode(ids)


def test_long_texts_without_a_space(code):
    rng = random.Random(3)
    for text in ["z" * 50_000, " " * 20_001, "ab" * 30_000, "".join(rng.choice("abcdefgh") for _ in range(60_000))]:
        ids = code.model.encode(text)
        assert code.encode(text) == ids and code.decode(ids) == text


def test_part_is_the_only_sequence_whose_neighbours_fit(code):
    """The definition (merging) for words, and the tables stay bounded."""
    rng = random.Random(8)
    for _ in range(300):
        word = "▁" + "".join(rng.choice("etaoinshr") for _ in range(rng.randrange(1, 14)))
        merged = [code.ids[p] for p in code.merge(word)]
        assert S.array("i", code.part(word)).tolist() == merged


def test_tables_are_bounded(monkeypatch):
    code = S.Encoder(MODEL)
    monkeypatch.setattr(S, "REMEMBERED", 50)
    rng = random.Random(2)
    for _ in range(50):
        text = " ".join("".join(rng.choice("abcdexyz.") for _ in range(7)) for _ in range(20)) + "q" * 100
        assert code.encode(text) == code.model.encode(text)
    for table in (code.words, code.parts):
        assert len(table) <= 50 and len(table.old) <= 50 and all(len(key) <= S.WORD for key in table)


def test_other_kinds_of_models_are_refused(monkeypatch):
    import sentencepiece

    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "is_unused", lambda self, i: i == 7)
    with pytest.raises(ValueError, match="unused"):
        S.Encoder(MODEL)


def test_awkward_rows(spark, code):
    rows = awkward()
    docs = with_clashes(spark.createDataFrame(rows, DOCS)).withColumn("decoded", docs_column())
    encoded = S.encode(docs, MODEL, ["doc_id", "score"])
    assert encoded.columns == ["doc_id", "score", "ids"]
    got = encoded.collect()
    assert len(got) == len(rows) and {r.score for r in got} == {"mine:score"}
    expected = sorted((str(r[0]), code.model.encode(r[1] or "")) for r in rows)
    assert sorted((str(r.doc_id), r.ids) for r in got) == expected
    texts = S.decode(encoded, MODEL, ["doc_id"]).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in texts) == sorted((str(r[0]), r[1] or "") for r in rows)
    assert S.decode(S.encode(docs.limit(0), MODEL, ["doc_id"]), MODEL, ["doc_id"]).collect() == []


def docs_column():
    from pyspark.sql import functions as F

    return F.lit("mine")
