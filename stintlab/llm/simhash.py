"""Near duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint is cut into two segments of 32 bits. If two fingerprints differ in at most
two bits, one of these holds:

- a segment is equal, and the other differs in at most two bits, so that one of its three
  parts is equal too;
- both segments differ in exactly one bit, so that the second fingerprint's first segment
  lies in the Hamming ball of radius one around the first's, and half of the other segment
  is equal.

Every fingerprint stands in a table under the keys of these cases, and looks up its own keys
and those of the ball. Adding a part of the other segment to each key keeps the lists short
where many documents share a segment. The ball is enumerated only around segments with an
even number of set bits: neighbours at distance one have an odd number. What the table
returns is kept only if the complete distance is small enough.

Only different fingerprints are compared, so copies cost nothing here, and each fingerprint
has at most 2,080 others within two bits, whatever the size of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from stintlab.llm.common import map_batches, row_key, text_hash
from stintlab.staging import settle

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
# Shingles hashed and counted at once, which bounds the memory of a long text.
_AT_ONCE = 50_000


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text, as a signed number; 0 if it has no word.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` cuts at the six ASCII white-space
    characters only.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, _AT_ONCE):
        count = min(_AT_ONCE, n - start)
        columns = [words[start + i : start + i + count] for i in range(shingle_words)]
        shingles = zip(*columns, strict=True) if len(words) >= shingle_words else [words]
        hashes = np.fromiter(
            (xxh64_intdigest(b" ".join(s), SEED) for s in shingles), np.uint64, count
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp) for every row of ``docs``."""

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle_words) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(found, pa.int64())],
                ["doc_id", "text_hash", "fp"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long"), text_hash().alias("text_hash"), F.col("text").cast("string")
    )
    return map_batches(rows, change, "doc_id long, text_hash long, fp long")


def _key(kind: int, segment: Column, part: Column) -> Column:
    """Case, a whole segment and up to 16 bits of the other in one number."""
    return F.lit(kind << 48).bitwiseOR(F.shiftleft(segment, 16)).bitwiseOR(part)


def _bits(segment: Column, low: int, n: int) -> Column:
    return F.shiftright(segment, low).bitwiseAND(F.lit((1 << n) - 1))


def _equal_segment_keys(a: Column, b: Column) -> list[Column]:
    thirds = ((0, 11), (11, 11), (22, 10))
    return [
        _key(3 * side + i, whole, _bits(other, *third))
        for side, (whole, other) in enumerate(((a, b), (b, a)))
        for i, third in enumerate(thirds)
    ]


def _half_keys(a: Column, b: Column) -> list[Column]:
    return [_key(6 + i, a, _bits(b, 16 * i, 16)) for i in range(2)]


def links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (hi, lo) of different values of ``fp`` that differ in at most ``max_bits`` bits.

    ``nodes`` has each fingerprint once.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the keys find differences of at most two bits")
    a = F.shiftrightunsigned("fp", 32)
    b = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    even = F.bit_count(a) % 2 == 0
    ball = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.lit(31)),
            lambda i: F.array(
                *_half_keys(a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)), b)
            ),
        )
    )
    same = F.array(*_equal_segment_keys(a, b))
    stored = F.when(even, same).otherwise(F.concat(same, F.array(*_half_keys(a, b))))
    sought = F.when(even, F.concat(same, ball)).otherwise(same)
    left = nodes.select(F.explode(sought).alias("key"), F.col("fp").alias("x"))
    right = nodes.select(F.explode(stored).alias("key"), F.col("fp").alias("y"))
    near = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= max_bits
    # A pair with an equal segment meets twice; one of the two is enough.
    once = (F.col("key") >= F.lit(6 << 48)) | (F.col("x") < F.col("y"))
    pairs = left.join(right, "key").filter(near & once)
    return pairs.select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (hi, lo); root is the component's least node.

    Alternates the large-star and small-star steps, which leave at most as many edges as
    there were, until nothing changes. Every round is written, so that a lost executor
    does not bring back the rounds before.
    """

    def state(df: DataFrame) -> tuple:
        mixed = F.xxhash64("hi", "lo").cast("decimal(38,0)")
        return tuple(df.agg(F.count("*"), F.sum(mixed)).first())

    current = settle(edges)
    before = state(current)
    while before[0]:
        ends = current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            current.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = ends.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        large = (
            current.join(least, current["lo"] == least["u"])
            .select("hi", F.col("m").alias("lo"))
            .distinct()
        )
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").select(
            F.explode(F.array("hi", "lo")).alias("hi"), F.col("m").alias("lo")
        )
        current = settle(small.filter(F.col("hi") != F.col("lo")).distinct())
        after = state(current)
        if after == before:
            break
        before = after
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def near_duplicates(
    docs: DataFrame, max_bits: int = MAX_BITS, shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, root) for every row of ``docs`` (doc_id, text).

    A null or empty text, or one without a word, has fingerprint 0 and links like any
    other. ``component_id`` is the least doc_id reached over links; a null doc_id is never
    the least unless there is no other. ``root`` names the component even then, by its least
    fingerprint. Repeated rows each come back with their
    component. Other columns of ``docs`` are not looked at. No rows give no rows.
    """
    rows = settle(fingerprints(docs, shingle_words))
    nodes = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    stars = components(links(nodes, max_bits))
    rooted = nodes.join(stars, nodes["fp"] == stars["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    first = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows.join(rooted.join(first, "root").select("fp", "root", "component_id"), "fp").select(
        "doc_id", "text_hash", "fp", "component_id", "root"
    )


def keep_one_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row of ``docs`` per component of ``found``: that with the least doc_id (null last),
    and of those that share it the one whose text hashes lowest."""
    chosen = (
        found.groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("row"))
        .select("row.doc_id", "row.text_hash")
        .select(row_key("doc_id").alias("_doc"), F.col("text_hash").alias("_text"))
    )
    keyed = docs.withColumns({"_doc": row_key("doc_id"), "_text": text_hash()})
    # The join leaves rows where dropping equal ones needs them: one shuffle of the texts.
    kept = keyed.join(chosen, ["_doc", "_text"], "left_semi").dropDuplicates(["_doc", "_text"])
    return kept.drop("_doc", "_text")


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
