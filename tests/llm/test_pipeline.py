"""Each stage of the pipeline against plain Python over a small table, and all in a row."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from xxhash import xxh64_intdigest

import corpus_pipeline
from stintlab.llm import quality
from stintlab.llm.common import table
from stintlab.llm.mixing import mix
from stintlab.llm.pii import find_spans, learn_field
from stintlab.staging import settle

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def documents(spark):
    """The given documents, and copies, near copies and personal data planted among them."""
    given = table(spark, SF, "documents")
    listed = [tuple(r[c] for c in COLUMNS) for r in given.collect()]
    draw = random.Random(17)
    long = [r for r in listed if r[1] and len(r[1].split()) > 150]
    planted = []
    for k, row in enumerate(draw.sample(long, 6)):
        words = row[1].split(" ")
        words[len(words) // 2] = "replaced"
        planted.append((10_000 + 2 * k, row[1], *row[2:]))
        planted.append((10_001 + 2 * k, " ".join(words), *row[2:]))
    for k, row in enumerate(draw.sample(long, 5)):
        text = f"{row[1]} Write to user{k}@mail{k}.example.com or 10.1.{k}.7, +1 555 010 99{k}0."
        planted.append((20_000 + k, text, *row[2:]))
    planted += [(30_000, None, None, None, None), (30_001, "", "en", "web", 0), (None, "No id here.", "en", "web", 11)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(*r[:4], None if r[1] is None else len(r[1])) for r in [*listed, *planted]]
    return settle(spark.createDataFrame(rows, schema))


def listed(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()), key=lambda r: [(v is None, str(v)) for v in r])


def test_stages_are_the_pipelines():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "personal_data", "mixing", "packing",
    ]


def test_quality_rejects_what_scores_low(spark, documents):
    labels = table(spark, SF, "labels")
    known = quality.features(documents).join(labels.select("doc_id", "quality"), "doc_id")
    ranking = quality.learn(known)

    def accepted(text):
        values = np.array(quality.text_features(text))
        z = np.clip((values - ranking.mean) / ranking.spread, -8, 8)
        odds = (z @ ranking.weights - ranking.threshold) / ranking.unit + np.log(0.7 / 0.3)
        return 1 / (1 + np.exp(-odds)) >= 0.7

    rows = listed(documents)
    expected = [r for r in rows if accepted(r[1])]
    got = listed(STAGES["quality"](spark, documents, SF))
    assert got == expected
    assert 0.5 * len(rows) < len(got) < len(rows)
    # By labels: what is dropped is mostly marked bad.
    marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
    kept = {r[0] for r in got}
    dropped = [marks[r[0]] for r in rows if r[0] in marks and r[0] not in kept]
    assert dropped and np.mean(dropped) < 0.2


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxh64_intdigest(run.encode(), 42) for run in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_one_of_each_group_stays(spark, documents):
    rows = listed(documents)
    prints = [fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 2:
            group[find(j)] = find(i)
    groups = defaultdict(list)
    for i, row in enumerate(rows):
        groups[find(i)].append(row)
    expected = [min(g, key=lambda r: (r[0] is None, r[0])) for g in groups.values()]
    got = listed(STAGES["near_duplicates"](spark, documents, SF))
    assert [r[0] for r in got] == sorted((r[0] for r in expected), key=lambda v: (v is None, str(v)))
    assert set(got) <= set(rows)
    assert not {10_000 + 2 * k for k in range(6)} & {r[0] for r in got}
    assert len(got) < len(rows) - 6


def test_personal_data_is_masked(spark, documents):
    field = learn_field(documents)

    def masked(text):
        if not text:
            return text
        names = ["EMAIL", "IP", "CARD", "PHONE"]
        inside = [None] * len(text)
        for number, (kind, start, end) in enumerate(sorted(find_spans(text, field)[1], key=lambda s: (s[1], -s[2]))):
            for i in range(start, end):
                inside[i] = inside[i] or (number, names[kind])
        out = []
        for place, run in itertools.groupby(range(len(text)), key=inside.__getitem__):
            out.append(f"[{place[1]}]" if place else "".join(text[i] for i in run))
        return "".join(out)

    rows = listed(documents)
    expected = []
    for doc_id, text, lang, source, _ in rows:
        new = masked(text)
        expected.append((doc_id, new, lang, source, None if new is None else len(new)))
    got = listed(STAGES["personal_data"](spark, documents, SF))
    assert got == sorted(expected, key=lambda r: [(v is None, str(v)) for v in r])
    texts = {r[0]: r[1] for r in got}
    for k in range(5):
        assert texts[20_000 + k].endswith(" Write to [EMAIL] or [IP], [PHONE].")
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    assert any(email.search(r[1] or "") for r in rows)
    assert not any(email.search(r[1] or "") for r in got)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_sources_are_mixed(spark, documents):
    """Whole copies and a cut one of each document, as many words as the mix takes of it."""
    rows = listed(documents)
    taken = {r["doc_id"]: r["taken"] for r in mix(documents).collect()}
    got = defaultdict(list)
    for r in listed(STAGES["mixing"](spark, documents, SF)):
        got[r[0]].append(r)
    sizes, totals = Counter(), Counter()
    for doc_id, text, lang, source, _ in rows:
        own, copies = words_of(text), sorted(got[doc_id], key=lambda r: -len(r[1]))
        whole, rest = divmod(taken[doc_id], len(own)) if own else (0, 0)
        assert len(copies) == whole + (rest > 0)
        assert all(c[1] == text for c in copies[:whole])
        for cut in copies[whole:]:
            assert text.startswith(cut[1]) and words_of(cut[1]) == own[:rest]
        assert all((c[2], c[3], c[4]) == (lang, source, len(c[1])) for c in copies)
        sizes[source] += len(own)
        totals[source] += sum(len(words_of(c[1])) for c in copies)
        assert taken[doc_id] <= 3 * len(own)
    # Targets by hand: weights 1, 2, 3 by source, none above three times its size.
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    left, free, target = float(sum(sizes.values())), set(order), {}
    while True:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] > 3 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over
    target |= {s: unit * weight[s] for s in free}
    for s in order:
        assert totals[s] == pytest.approx(target[s], abs=max(64, 0.02 * target[s]))
    assert sum(totals.values()) != sum(sizes.values()) or any(totals[s] != sizes[s] for s in order)


def pieces_by_hand(rows, capacity=1024):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % capacity or capacity
        starts = [0, *range(first, len(ids), capacity)]
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            out.append((doc_id, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return sorted(out, key=str)


def check_packed(packed, rows):
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed]
    assert sorted(got, key=str) == pieces_by_hand(rows)
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 1024
    fill = sum(r["length"] for r in packed)
    assert len(sequences) <= -(-fill // 1024) * 1.05 + 2


def test_sequences_are_packed(spark, documents):
    packed = STAGES["packing"](spark, documents, SF).collect()
    check_packed(packed, [(r[0], r[1]) for r in listed(documents)])


def test_all_stages_in_a_row(spark, documents):
    """Each stage's result is the next one's input, down to the sequences."""
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, settle(stage(spark, docs, SF))
        assert sorted(docs.columns) == sorted(before.columns)
        assert docs.count() > 0 and listed(docs) != listed(before)
    name, last = corpus_pipeline.STAGES[-1]
    check_packed(last(spark, docs, SF).collect(), [(r[0], r[1]) for r in listed(docs)])


def test_the_pipeline_runs_its_stages(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, SF))
    plain = ["doc_id", "piece", "start", "length", "ids_crc32"]
    expected = sorted(map(str, docs.select(plain).collect()))
    assert sorted(map(str, corpus_pipeline.run(spark, SF).select(plain).collect())) == expected
    assert docs.agg(F.countDistinct("doc_id")).first()[0] > 50
