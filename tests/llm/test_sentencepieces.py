"""Ids and decoded texts against the sentencepiece library."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from stintlab.llm import sentencepieces
from stintlab.llm.sentencepieces import MODEL, PieceTable, encode
from tests.conftest import rows

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))


@pytest.fixture(scope="module")
def pieces():
    return PieceTable()


def ids_of(pieces, text):
    return [i for word in pieces.marked_words(text) for i in pieces.word_ids(word)]


def test_made_texts(library, pieces):
    draw = random.Random(13)
    all_pieces = [library.id_to_piece(i) for i in range(3, library.get_piece_size())]
    kinds = [
        lambda: "".join(draw.choice(all_pieces) for _ in range(draw.randrange(9))),
        lambda: "".join(draw.choice("abcdefgh  \n\t\0éß日本語😀▁.,'\r̀﻿\xa0") for _ in range(draw.randrange(25))),
        lambda: " " * draw.randrange(60) + draw.choice(["", "a", "the", "\n"]) + " " * draw.randrange(40) + "x",
        lambda: "".join(draw.choice(["er", "in", "th", "he", "an", "ing", " ", "s", "a", "e"]) for _ in range(draw.randrange(12))),
        lambda: draw.choice("ab ▁") * draw.randrange(70),
    ]
    for k in range(10_000):
        text = kinds[k % len(kinds)]()
        assert ids_of(pieces, text) == library.encode(text), repr(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_any_text(library, pieces, text):
    text = text.encode("utf-8", "ignore").decode()
    assert ids_of(pieces, text) == library.encode(text)


def test_a_words_prefixes_have_one_last_piece(library, pieces):
    """Of the pieces that end at a place, one alone is compatible with the piece before it."""
    for word in ("▁interconnectedness", "▁" * 33 + "the", "aaaaaaaaaaaaaaaaa", "日本語テキスト", "▁unbelievably.Whatever"):
        for n in range(1, len(word) + 1):
            ids = pieces.word_ids(word[:n])
            fitting = []
            for piece in {library.id_to_piece(i) for i in range(259, 32_000)}:
                if word[:n].endswith(piece):
                    before = pieces.word_ids(word[: n - len(piece)])
                    if not before or pieces.compatible(before[-1], library.piece_to_id(piece)):
                        fitting.append(library.piece_to_id(piece))
            assert fitting == ids[-1:]


def test_long_words_take_linear_time(library, pieces):
    text = "abcdefghij" * 30_000
    assert ids_of(pieces, text) == library.encode(text)


@pytest.mark.parametrize("remembered", [0, 50, 300_000])
def test_given_documents(spark, library, monkeypatch, remembered):
    """All texts, whether the memories are full or not."""
    monkeypatch.setattr(sentencepieces, "REMEMBERED_WORDS", remembered)
    monkeypatch.setattr(sentencepieces, "REMEMBERED_PAIRS", remembered)
    monkeypatch.setattr(sentencepieces, "_AT_ONCE", 5_000)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    if remembered < 300_000:
        docs = spark.read.parquet(f"{SF.replace('0.01', '0.001')}/documents.parquet")
    expected = {}
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode(r["text"] or "")
        expected[r["doc_id"]] = (ids, library.decode(ids))
    got = {r["doc_id"]: (r["ids"], r["decoded"]) for r in encode(docs).collect()}
    assert got == expected


def test_awkward_documents(spark, library, awkward, nothing):
    assert encode(nothing).collect() == []
    expected = []
    for r in awkward.collect():
        ids = library.encode(r["text"] or "")
        expected.append((r["doc_id"], ids, library.decode(ids)))
    assert sorted(map(str, rows(encode(awkward)))) == sorted(map(str, expected))


def test_other_models_are_refused():
    with pytest.raises((OSError, RuntimeError, ValueError)):
        PieceTable(public_tokenizers.path("byte_bpe_50k.tiktoken"))
