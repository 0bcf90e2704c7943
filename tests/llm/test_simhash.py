"""Fingerprints against a bit-by-bit count, links and components against all pairs."""

from __future__ import annotations

import random

import xxhash
from pyspark.sql import functions as F

from stintlab.llm.simhash import components, fingerprint, keep_one_each, links, near_duplicates
from tests.conftest import rows
from tests.llm.conftest import LONG


def counted(text):
    """The definition, one bit at a time."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(blank, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def test_fingerprint_is_the_count():
    texts = [None, "", " \t", "a", "A b", "Ünï ÇODÉ mixed", "x y z", "x y z w q", "a\x1cb c d",
             "the same the same the same", "one two three four\nfive SIX seven"]
    for text in texts:
        assert fingerprint(text) == counted(text)
    words = LONG.split(" ")
    assert fingerprint(LONG) == counted(" ".join(words))


def test_shingle_hash_is_the_sql_hash(spark):
    value = spark.sql("SELECT xxhash64('only two')").first()[0]
    assert fingerprint("Only\tTwo") == value


def pairs_by_force(values, bits):
    return sorted((max(a, b), min(a, b)) for i, a in enumerate(values) for b in values[:i]
                  if (a ^ b).bit_count() <= bits and a != b)


def signed(v):
    v &= (1 << 64) - 1
    return v - (1 << 64) if v >> 63 else v


def dense(seed, n):
    """Clusters in which every kind of two-bit difference occurs, and unrelated values."""
    draw = random.Random(seed)
    values = set()
    for _ in range(12):
        centre = draw.getrandbits(64)
        for _ in range(n):
            v = centre
            for b in draw.sample(range(64), draw.choice([0, 1, 1, 2, 2, 3])):
                v ^= 1 << b
            values.add(signed(v))
    values |= {signed(draw.getrandbits(64)) for _ in range(100)} | {0, -1, 1, signed(1 << 63)}
    return sorted(values)


def test_links_find_every_pair(spark):
    values = dense(1, 25)
    nodes = spark.createDataFrame([(v,) for v in values], "fp long")
    for bits in (0, 1, 2):
        unsigned = {signed(v): v & ((1 << 64) - 1) for v in values}
        expected = sorted(
            (max(a, b), min(a, b)) for i, a in enumerate(values) for b in values[:i]
            if (unsigned[a] ^ unsigned[b]).bit_count() <= bits
        )
        assert sorted(tuple(r) for r in links(nodes, bits).collect()) == expected


def test_components_by_force(spark):
    draw = random.Random(3)
    edges = [(i + 1, i) for i in range(60)] + [(1000, 70 + i) for i in range(40)]
    edges += [tuple(sorted(draw.sample(range(200, 400), 2), reverse=True)) for _ in range(120)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    expected = {n: find(n) for n in list(root) if find(n) != n}
    df = spark.createDataFrame(edges, "hi long, lo long").distinct()
    assert {r["node"]: r["root"] for r in components(df).collect()} == expected
    assert components(df.limit(0)).count() == 0


def test_awkward_documents(spark, awkward, nothing):
    found = near_duplicates(awkward)
    got = rows(found.select("doc_id", "component_id"))
    assert got == [(1, 1), (1, 1), (2, 2), (3, 2), (4, 2), (5, 5), (6, 1), (7, 7), (None, 2), (None, None)]
    assert near_duplicates(nothing).count() == 0
    kept = keep_one_each(awkward, found)
    assert sorted(kept.columns) == sorted(awkward.columns)
    assert rows(kept.select("doc_id")) == [(1,), (2,), (5,), (7,), (None,)]


def test_copies_in_one_hot_group(spark):
    copies = spark.range(5000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "the very same text in a third of all rows").otherwise(
            F.concat(F.lit("text number "), "id", F.lit(" has its own words "), F.md5(F.col("id").cast("string")))
        ).alias("text"),
    )
    found = near_duplicates(copies)
    assert found.filter("doc_id % 3 = 0 AND component_id <> 0").count() == 0
    assert found.count() == 5000
