"""Segments against all stretches, odds and parameters, and held-out documents."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from stintlab.llm.queries import QUERIES
from stintlab.llm import toxicity
from stintlab.llm.toxicity import (
    COST,
    LEAST_DOCUMENTS,
    TokenScores,
    evidence,
    find_toxic,
    maximal_segments,
    tail,
    tokens,
    word_keys,
    word_score,
)
from tests.llm.conftest import LONG


def all_maximal(scores):
    """By the definition: the best stretch, then the same left and right of it."""
    if len(scores) == 0 or max(scores) <= 0:
        return []
    n = len(scores)
    height = np.concatenate([[0], np.cumsum(scores)])
    best = max(((height[b] - height[a], -(b - a), -a) for a in range(n) for b in range(a + 1, n + 1)))
    total, length, start = best[0], -best[1], -best[2]
    left = all_maximal(scores[:start])
    right = [(a + start + length, b + start + length, s) for a, b, s in all_maximal(scores[start + length :])]
    return [*left, (start, start + length, total), *right]


def test_segments_are_the_maximal_ones():
    draw = random.Random(1)
    for _ in range(400):
        scores = np.array([draw.choice([-3, -2, -1, 1, 2, 3, 5]) + draw.random() for _ in range(draw.randrange(0, 25))])
        got = maximal_segments(scores)
        expected = all_maximal(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in expected]
        assert [s for *_, s in got] == pytest.approx([s for *_, s in expected])


def test_segments_in_linear_time():
    n = 300_000
    for scores in (np.linspace(1, 2, n), -np.linspace(-2, -1, n), np.tile([1.0, -2.0], n // 2), np.tile([1.0, -0.5], n // 2)):
        maximal_segments(scores)


def test_slope_solves_its_equation():
    rows = {b"vile": (50, 40, 1), b"the": (900, 90, 700), b"cat": (300, 30, 240), b"vi*": (60, 41, 3)}
    total_toxic, total_clean, rate = 201, 944, 0.15
    model = TokenScores(list(rows), np.array(list(rows.values())), total_toxic, total_clean, rate)
    assert model.of_word(b"vile") > 1 > 0 > model.of_word(b"the") == -COST
    assert model.of_word(b"never") == -COST
    total = 0.0
    for key, (n_all, _, n_clean) in rows.items():
        share = (n_clean + rate * n_all) / (total_clean + total_toxic)
        if key in model.odds:
            total += share * np.exp(model.slope * (model.odds[key] - COST))
    rest = 1 - sum((rows[k][2] + rate * rows[k][0]) / (total_clean + total_toxic) for k in model.odds)
    assert total + rest * np.exp(-model.slope * COST) == pytest.approx(1, abs=1e-6)


def test_longer_beginnings_come_first():
    odds = {b"abcd*": 3.0, b"abcdef*": 4.0, b"abcdefgh": 5.0}
    assert word_score(b"abcdefgh", odds) == 5.0 - COST
    assert word_score(b"abcdefxy", odds) == 4.0 - COST
    assert word_score(b"abcdx", odds) == 3.0 - COST
    assert word_score(b"abcd", odds) == -COST  # a whole word is not its own beginning


def test_keys_in_few_toxic_documents_do_not_count():
    keys = [b"rare", b"frequent"]
    for n, counting in ((LEAST_DOCUMENTS - 1, []), (30, [b"rare"])):
        counts = np.array([(n, n, 0), (4000, 400, 3600)])
        assert list(TokenScores(keys, counts, 5000, 45_000, 0.1).odds) == counting


def test_counts_by_force(spark, monkeypatch):
    """Exact keys over all documents, whether memories are full or not."""
    draw = random.Random(5)
    words = ["the", "of", "horrid", "horridly", "horrible", "ünder", "a", "zz9", "abcdefghijkl"]
    rows = [(i, " ".join(draw.choice(words) for _ in range(draw.randrange(12))), i % 2) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    expected, n_words = Counter(), 0
    by_label = {0: Counter(), 1: Counter()}
    for _, text, toxic in rows:
        found = set(tokens(text))
        n_words += len(found)
        keys = {k for w in found for k in word_keys(w)}
        expected.update(keys)
        by_label[toxic].update(keys)
    for remembered in (200_000, 3):
        monkeypatch.setattr(toxicity, "_REMEMBERED", remembered)
        keys = [*sorted(expected), b"absent"]
        counts, total = toxicity.corpus_counts(docs, keys)
        assert dict(zip(keys, counts.tolist(), strict=True)) == {**expected, b"absent": 0}
        assert total == n_words
        got = {r["key"] and bytes(r["key"]): r for r in toxicity.sample_counts(docs.select("text", "toxic")).collect()}
        assert got.pop(None)["words"] == sum(len(set(tokens(t))) for _, t, x in rows if x)
        assert {k: (r["n_toxic"], r["n_clean"]) for k, r in got.items()} == {
            k: (by_label[1][k], by_label[0][k]) for k in expected
        }


def test_scores_by_force(spark):
    """The whole query in plain Python from the words that count: segments, evidence, tail."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    sample = toxicity.teaching_sample(docs, labels)
    model = toxicity.learn(docs, sample)
    taught = {r["doc_id"]: r["toxic"] for r in sample.collect()}
    strength, found = {}, {}
    for r in docs.select("doc_id", "text").collect():
        scores = np.array([word_score(w, model.odds) for w in tokens(r["text"])])
        segments = all_maximal(scores) if len(scores) < 900 else maximal_segments(scores)
        strength[r["doc_id"]] = evidence(len(scores), [s for *_, s in segments], model.slope, model.scale)
        lowest = np.log(max(model.scale * len(scores), 1e-9) / toxicity.EXPECTED)
        found[r["doc_id"]] = [(a, b) for a, b, s in segments if model.slope * s >= lowest]
    clean = np.array([strength[d] for d, toxic in taught.items() if toxic == 0])
    u, share, rate = tail(clean)
    for r in find_toxic(docs, labels).collect():
        x = strength[r["doc_id"]]
        rare = x * (-np.log(share) / u if u > 0 else 0.0) if x <= u else (x - u) * rate - np.log(share)
        score = 1 / (1 + np.exp(-(rare + np.log(toxicity.CLEAN_ERRORS) + np.log(0.7 / 0.3))))
        assert r["score"] == pytest.approx(score, abs=1e-9)
        assert [(p["from"], p["to"]) for p in r["passages"]] == found[r["doc_id"]]


def test_evidence_and_tail():
    assert evidence(100, [], 1.0, 0.1) == 0.0
    assert evidence(100, [9.0], 1.0, 0.1) == pytest.approx(9 - np.log(10))
    assert evidence(100, [9.0, 9.0], 1.0, 0.1) == pytest.approx(18 - 2 * np.log(10) + np.log(2))
    drawn = np.random.default_rng(1).exponential(2.0, 20_000)
    u, share, rate = tail(drawn)
    assert share == pytest.approx(0.1, abs=0.01) and rate == pytest.approx(0.5, rel=0.1)
    assert tail(np.array([])) == (0.0, 1.0, 1.0)


def test_tokens():
    assert tokens("Ünï-CODE, x9y\tİ 42 !!") == ["ünï".encode(), b"code", b"x", b"y", "i̇".encode()]
    assert tokens(None) == tokens("  ") == []


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op10_toxic_segments"](spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = got.filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    toxic, clean = held[held["toxic"] == 1]["score"], held[held["toxic"] == 0]["score"]
    assert np.mean([(t > c) + 0.5 * (t == c) for t in toxic for c in clean]) > 0.85
    assert (held[held["toxic"] == 0]["predicted"] == 1).mean() < 0.05
    assert held["score"].between(0, 1).all()


def test_awkward_documents(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 0), (None, 1), (99, 1), (2, None), (3, 7), (6, 1)], "doc_id long, toxic int")
    got = find_toxic(awkward, labels)
    assert got.count() == awkward.count()
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert by_id[2]["n_tokens"] == 0 and by_id[2]["score"] < 0.7
    assert by_id[5]["n_tokens"] == len(tokens(LONG))
    assert find_toxic(nothing, labels).count() == 0
    assert {r["predicted"] for r in find_toxic(awkward, labels.limit(0)).collect()} == {0}
