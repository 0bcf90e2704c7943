"""Phrases against counting all runs of words in plain Python."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stintlab.llm import collocations
from stintlab.llm.collocations import mine_phrases
from stintlab.staging import settle, shared_folder
from tests.conftest import rows


def by_force(table, least, most_words=4, top=2000, covered=80, scale=2_000_000):
    counts = defaultdict(Counter)
    for lang, text in table:
        own = counts["und" if lang is None else lang]
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, most_words + 1):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    found = []
    for lang, own in counts.items():
        n = sum(f for p, f in own.items() if len(p) == 1)
        candidates = {p: f for p, f in own.items() if len(p) > 1 and f >= least}
        over = Counter()
        for q, f in candidates.items():
            for k in range(2, len(q)):
                for i in range(len(q) - k + 1):
                    over[q[i : i + k]] = max(over[q[i : i + k]], f)
        listed = []
        for p, a in candidates.items():
            if 100 * over[p] >= covered * a and over[p]:
                continue
            score, _, cut = min((scale * a // (own[p[:k]] + own[p[k:]]), k, k) for k in range(1, len(p)))
            listed.append((-score, -a, " ".join(p).encode(), own[p[:cut]], own[p[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(listed)[:top], start=1):
            found.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(found)


def made(seed, n=300):
    draw = random.Random(seed)
    words = ["new", "york", "city", "the", "a", "of", "São", "Paulo", "x-y", "É", "é", "😀"]
    weights = [5, 5, 3, 9, 9, 8, 2, 2, 1, 1, 1, 1]
    ends = [*" " * 12, "  ", "\t", ". ", ", ", "\n", "\x0b", "! ", "; ", "\xa0"]
    table = []
    for _ in range(n):
        text = "".join(draw.choices(words, weights)[0] + draw.choice(ends) for _ in range(draw.randrange(30)))
        if draw.random() < 0.3:
            text += "Once upon a time there was. Once upon a time"
        table.append((draw.choice(["en", "en", "de", None, "und"]), text.upper() if draw.random() < 0.1 else text))
    return table


def got(df):
    names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[c] for c in names) for r in df.collect())


@pytest.mark.parametrize("sent, most_buckets", [(32 << 20, 20_000), (0, 20_000), (0, 3), (32 << 20, 1), (2000, 5)])
def test_by_force(spark, monkeypatch, sent, most_buckets):
    """With a bucket and with many, with frequent phrases sent and shuffled."""
    monkeypatch.setattr(collocations, "MOST_BYTES_SENT", sent)
    monkeypatch.setattr(collocations, "MOST_BUCKETS", most_buckets)
    table = made(1)
    docs = spark.createDataFrame(table, "lang string, text string").repartition(7)
    expected = by_force(table, 6)
    assert got(mine_phrases(docs, least=6)) == expected
    assert {r[0] for r in expected} == {"en", "de", "und"}
    assert {len(r[2].split(" ")) for r in expected} == {2, 3, 4}


@pytest.mark.parametrize("options", [{"most_words": 2}, {"most_words": 3, "top": 5}, {"covered_percent": 30}, {"most_words": 6, "covered_percent": 101}])
def test_options_by_force(spark, options):
    table = made(2, 120)
    docs = spark.createDataFrame(table, "lang string, text string")
    names = {"covered_percent": "covered"}
    expected = by_force(table, 4, **{names.get(k, k): v for k, v in options.items()})
    assert got(mine_phrases(docs, least=4, **options)) == expected
    assert expected


def test_overlaps_and_a_long_piece(spark):
    """A phrase that follows itself counts at every place; one piece holds most of all words."""
    table = [("en", "na " * 40_000 + "batman"), ("en", "la la. la la, la"), (None, "la la la")]
    docs = spark.createDataFrame(table, "lang string, text string")
    assert got(mine_phrases(docs, least=2)) == by_force(table, 2)


def test_counts_beyond_64_bits():
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    a, left, right = 4 * 10**18, 5 * 10**18, 6 * 10**18
    df = spark.range(1).select(*[F.lit(v).cast("long").alias(c) for c, v in zip("alr", (a, left, right), strict=True)])
    score = df.select(collocations._score(F.col("a"), F.col("l"), F.col("r"), 2_000_000)).first()[0]
    assert score == 2_000_000 * a // (left + right)


def test_places_leave_one_out_behind_each_piece(spark):
    docs = spark.createDataFrame([("en", "A b, c. d e f"), (None, ""), ("de", None), ("en", ";g\th")], "lang string, text string")
    found = collocations.places(collocations.pieces(docs.coalesce(1))).collect()
    assert [(r["lang"], r["word"]) for r in found] == [
        ("en", "a"), ("en", "b"), ("en", "d"), ("en", "e"), ("en", "f"), ("en", "g"), ("en", "h"),
    ]
    at = [r["at"] for r in found]
    assert [b - a == 1 for a, b in itertools.pairwise(at)] == [True, False, True, True, False, True]


def test_rounds_join_without_a_shuffle(spark):
    """Occurrences go from the texts into buckets, and from there into pairs, where they are;
    they are written without being sorted by bucket."""
    docs = settle(spark.createDataFrame(made(3), "lang string, text string").repartition(6))
    words = collocations.places(collocations.pieces(docs))
    rows = words.select(collocations._part(), "at", F.xxhash64("word").alias("phrase"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    kept = collocations._bucketed(rows, 5, True)
    with collocations._by_parts(spark):
        plan = collocations._followed(kept)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert "Exchange" not in plan
    assert kept.count() == rows.count()


def test_texts_are_split_once(spark):
    docs = spark.createDataFrame(made(3), "lang string, text string")
    for made_of in (collocations.words, collocations.places):
        plan = made_of(collocations.pieces(docs))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") <= 2


def test_the_sessions_options_come_back(spark):
    before = {name: spark.conf.get(name, None) for name in collocations._OPTIONS}
    with collocations._by_parts(spark):
        assert {name: spark.conf.get(name) for name in before} == collocations._OPTIONS
    assert {name: spark.conf.get(name, None) for name in before} == before


def test_awkward_documents(spark, awkward, nothing):
    for docs in (awkward.withColumnRenamed("source", "lang"), nothing.withColumnRenamed("source", "lang")):
        table = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]
        assert got(mine_phrases(docs, least=2)) == by_force(table, 2)
    assert rows(mine_phrases(nothing.withColumnRenamed("source", "lang"))) == []


def test_neighbours_are_read_in_order(spark, monkeypatch):
    """The first round needs no join of places: words come with the one behind them, as places have it."""
    docs = settle(spark.createDataFrame(made(4), "lang string, text string").repartition(3))
    found = collocations.neighbours(collocations.pieces(docs))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Join" not in plan
    assert plan.count("split(") <= 2
    at = {(r["at"]): (r["lang"], r["word"]) for r in collocations.places(collocations.pieces(docs)).collect()}
    expected = sorted((*word, at[place + 1][1]) for place, word in at.items() if place + 1 in at)
    assert sorted((r["lang"], r["word"], r["next"]) for r in found.collect()) == expected
    joined = []
    followed = collocations._followed
    monkeypatch.setattr(collocations, "_followed", lambda rows: joined.append(1) or followed(rows))
    mine_phrases(docs, least=4)
    assert len(joined) == collocations.MOST_WORDS - 2


def test_relations_go_when_they_are_read(spark):
    """What is left are tables of phrases, none of places, in the folder and in the catalog."""
    folder = Path(shared_folder(spark))
    files, tables = set(folder.iterdir()), {t.name for t in spark.catalog.listTables()}
    assert got(mine_phrases(spark.createDataFrame(made(5), "lang string, text string"), least=4))
    left = set(folder.iterdir()) - files
    assert left
    for path in left:
        assert "at" not in spark.read.parquet(str(path)).columns
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_only_ascii_letters_are_lowered(spark):
    """Not those that lower() changes as well, in a piece with others or alone."""
    text = "ABC Zz, ÀB\u0130 \u212aX \u1e9e \u01c5 \u2160 \u24b6 \u03a3C \U00010400 XYZ. \u212a; É"
    found = collocations.words(collocations.pieces(spark.createDataFrame([("en", text)], "lang string, text string")))
    expected = re.sub("[A-Z]", lambda m: m.group().lower(), text)
    assert [r["word"] for r in found.collect()] == re.findall(r"[^ .,;]+", expected)


def test_words_of_one_hash_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(collocations, "_hash", lambda lang, word: (F.length(word) % 3).cast("long"))
    table = made(6, 100)
    docs = spark.createDataFrame(table, "lang string, text string")
    assert got(mine_phrases(docs, least=4)) == by_force(table, 4)
