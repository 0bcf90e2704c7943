"""Packed ids against the named tokenizer at its default setting, added tokens included."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from stintlab.llm.packing import pack
from stintlab.llm.tokens import ADDED, PieceTokens


def test_packing_takes_the_tokenizers_added_tokens(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()} == ADDED
    draw = random.Random(8)
    parts = ["<|endoftext|>", "<|endoftext|", "|>", " ", "  ", "\n", "\n\n", "\t", "a", " b", "'s", "don't", "é", "日本", "."]
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y ", *(
        "".join(draw.choice(parts) for _ in range(draw.randrange(1, 12))) for _ in range(1000)
    )]
    tokens = PieceTokens(added=ADDED)
    expected = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for text, ids in zip(texts, expected, strict=True):
        assert np.frombuffer(tokens.id_bytes(text), "<u4").tolist() == ids, repr(text)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pack(docs).collect():
        own = [*expected[r["doc_id"]], 2]
        assert (r["start"], r["length"]) == (0, len(own)), texts[r["doc_id"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
