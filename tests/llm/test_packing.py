"""Token ids against the tokenizer, bounds against exact packing, and whole results."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stintlab.llm.packing import best_fit, lower_bound, pack
from stintlab.llm.tokens import PieceTokens
from tests.llm.conftest import LONG

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_ids_are_the_tokenizers(spark, reference):
    draw = random.Random(1)
    parts = ["it's", "'s", " 's", " ", "  ", "\n", "\n\n", " \n", "\t", "é", " ", " x", "don't stop", "12,5", "a1", "日本",
             "😀", "<|endoftext|>", "\x1c", "\x85", "word", ".", "...", "\r\n", "ß", "é", "—"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(12))) for _ in range(3000)]
    texts += [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    tokens = PieceTokens()
    for text, expected in zip(texts, reference.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(tokens.id_bytes(text), "<u4").tolist() == expected.ids, repr(text)


def fewest(lengths, capacity):
    best = len(lengths)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + lengths[i] <= capacity:
                place(i + 1, [*bins[:b], bins[b] + lengths[i], *bins[b + 1 :]])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best


def test_bound_never_exceeds_the_fewest():
    draw = random.Random(3)
    met = 0
    for _ in range(150):
        capacity = draw.choice([10, 16, 24])
        lengths = sorted((draw.randrange(1, capacity + 1) for _ in range(draw.randrange(1, 9))), reverse=True)
        bound, exact = lower_bound(np.array(lengths), capacity), fewest(lengths, capacity)
        assert bound <= exact, lengths
        met += bound == exact
    assert met > 140


def test_best_fit_by_the_book():
    draw = random.Random(4)
    for _ in range(50):
        lengths = np.array([draw.randrange(1, 101) for _ in range(60)])
        bins, offsets, fill = best_fit(lengths, 100)
        book, places = [], {}
        for i in np.argsort(-lengths, kind="stable"):
            fits = [b for b in range(len(book)) if book[b] + lengths[i] <= 100]
            b = max(fits, key=lambda b: book[b]) if fits else len(book)
            if not fits:
                book.append(0)
            book[b] += lengths[i]
            places[i] = b
        assert len(fill) == len(book) and sorted(fill) == sorted(book)
        assert all((bins[i] == bins[j]) <= (offsets[i] != offsets[j]) for i, j in itertools.combinations(range(60), 2))


def check(packed, capacity):
    by_sequence = {}
    for r in packed:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for members in by_sequence.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_whole_documents_come_back(spark, reference):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    packed = pack(docs).collect()
    n = check(packed, 1024)
    assert n <= lower_bound(np.array([r["length"] for r in packed])) + 1
    ids = {r["doc_id"]: [*reference.encode(r["text"] or "", add_special_tokens=False).ids, 2] for r in docs.collect()}
    seen = {}
    for r in sorted(packed, key=lambda r: (r["doc_id"], r["piece"])):
        own = ids[r["doc_id"]]
        assert r["start"] == seen.get(r["doc_id"], 0)
        assert r["ids_crc32"] == zlib.crc32(np.array(own[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
        assert r["length"] == 1024 or r["piece"] == 0
        seen[r["doc_id"]] = r["start"] + r["length"]
    assert seen == {k: len(v) for k, v in ids.items()}


def test_pools_exchange(spark):
    """Small pools leave gaps; exchanging brings them near the bound of the whole."""
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") * 37 % 130).cast("int")).alias("text"))
    alone = check(pack(docs, capacity=128, pieces_per_pool=20, rounds=0).collect(), 128)
    packed = pack(docs, capacity=128, pieces_per_pool=20).collect()
    together = check(packed, 128)
    bound = lower_bound(np.array([r["length"] for r in packed]), 128)
    assert bound <= together < alone
    assert len(packed) == len({(r["doc_id"], r["piece"]) for r in packed})


def test_awkward_documents(spark, awkward, nothing):
    packed = pack(awkward).collect()
    check(packed, 1024)
    assert sum(r["doc_id"] == 1 for r in packed) == 2
    assert [(r["start"], r["length"]) for r in packed if r["doc_id"] == 2] == [(0, 1)]
    assert sum(r["length"] for r in packed if r["doc_id"] == 5) == len(PieceTokens().id_bytes(LONG)) // 4 + 1
    assert pack(nothing).count() == 0
