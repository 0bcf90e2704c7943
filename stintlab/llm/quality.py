"""Document quality by Bradley-Terry pairwise ranking.

A document's strength is a linear function of features of its text. From pairs of a
document labelled good and one labelled bad it is learned that the first wins with
probability 1 / (1 + exp(-difference of strengths)): logistic loss on feature differences.
All labelled documents are learned from. Both kinds are numbered by the hash of their ids and dealt
evenly to blocks; all pairs inside a block count, so that the work grows with the documents and not
with their square. Documents of the rarer kind go to several blocks where there are fewer of them
than blocks. The threshold is the quantile of all labelled documents' strengths at the share of
bad ones among them. What is added up are whole numbers, so that the order does not matter.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlab.llm.common import map_batches
from stintlab.operators.ranking import with_rows_before
from stintlab.staging import settle

# Pairs in a block, at most.
PAIRS = 1 << 16
RIDGE = 1e-3
# Steps of the fit, at most, and the step that ends it.
STEPS, SMALL_STEP = 30, 1e-6
# Bins that values are counted by to find one by its rank.
BINS = 4096
# Units in which pairs' sums and a value's place between the least and the greatest are added up.
_SUM_UNIT, _PLACE_UNIT = float(1 << 32), float(1 << 53)
ACCEPT = 0.7
FEATURES = 16
_WORDS_AT_ONCE = 100_000
_PUNCTUATION = bytes(string.punctuation, "ascii")
_UPPER, _DIGITS = bytes(string.ascii_uppercase, "ascii"), bytes(string.digits, "ascii")


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def text_features(text: str | None) -> list[float]:
    """Shares and logarithms that describe a whole text; none depends on its language."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n, size = len(words), len(raw)
    counts = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    marks = size - len(raw.translate(None, _PUNCTUATION))
    uppers = size - len(raw.translate(None, _UPPER))
    digits = size - len(raw.translate(None, _DIGITS))
    letters = len(raw.translate(None, _PUNCTUATION + _DIGITS + b" \t\n\r\x0b\x0c"))
    odd = marks - sum(raw.count(c) for c in (b".", b",", b"'", b"-"))
    heavy = all_upper = repeats = pairs = 0
    for start in range(0, n, _WORDS_AT_ONCE):
        some = words[start : start + _WORDS_AT_ONCE + 1]
        own = some[:_WORDS_AT_ONCE]
        # Marks at a word's end that prose has singly at most.
        heavy += sum(w[-2:-1] in _PUNCTUATION_SET and w[-1:] in _PUNCTUATION_SET for w in own)
        all_upper += sum(w.isupper() for w in own)
        repeats += sum(map(bytes.__eq__, some, some[1:]))
        pairs += len(some) - 1
    return [
        np.log1p(n),
        _share(marks, size),
        _share(odd, size),
        _share(uppers, letters),
        _share(digits, size),
        _share(len(counts), n),
        _share(max(counts.values(), default=0), n),
        _share(letters, n),
        _share(heavy, n),
        _share(all_upper, n),
        _share(repeats, max(pairs, 1)),
        _share(counts.get(b"|", 0), n),
        _share(raw.count(b"."), n),
        _share(len(set(lines)), len(lines)),
        np.log1p(_share(size, len(lines))),
        # Words beyond the first of each kind, less so in long texts of natural language.
        _share(n - len(counts), max(n, 1) ** 0.5),
    ]


_PUNCTUATION_SET = {bytes([c]) for c in _PUNCTUATION}


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, features) for every row of ``docs`` (doc_id, text)."""

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_features(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.list_(pa.float64()))],
                ["doc_id", "features"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(rows, change, "doc_id long, features array<double>")


def _pair_sums(better: np.ndarray, worse: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Slope and, behind it, curvature of the log-likelihood, summed over all pairs of rows."""
    ahead = (better @ weights)[:, None] - (worse @ weights)[None, :]
    p = 1 / (1 + np.exp(np.minimum(ahead, 30)))
    q = p * (1 - p)
    slope = better.T @ p.sum(axis=1) - worse.T @ p.sum(axis=0)
    across = better.T @ q @ worse
    curve = (better.T * q.sum(axis=1)) @ better + (worse.T * q.sum(axis=0)) @ worse
    return np.concatenate([slope, (curve - across - across.T).ravel()])


def _whole(sums: np.ndarray) -> np.ndarray:
    """Whole numbers of any size, to be added up in any order."""
    return np.rint(sums * _SUM_UNIT).astype(np.int64).astype(object)


def _fit(total: Callable[[np.ndarray], list[int]], pairs: int) -> np.ndarray:
    """The weights by Newton's method; ``total`` gives all blocks' sums at some weights."""
    weights = np.zeros(FEATURES)
    for _ in range(STEPS):
        sums = np.array([int(v) / (pairs * int(_SUM_UNIT)) for v in total(weights)])
        slope, curve = sums[:FEATURES], sums[FEATURES:].reshape(FEATURES, FEATURES)
        step = np.linalg.solve(curve + RIDGE * np.eye(FEATURES), slope - RIDGE * weights)
        weights = weights + step
        if np.abs(step).max() < SMALL_STEP:
            break
    return weights


def _n_blocks(good: int, bad: int, pairs: int) -> int:
    return -(-max(good, bad) // max(1, math.isqrt(pairs)))


def _dealt(block: int, n: int, blocks: int) -> range:
    """Which of ``n`` documents of a kind are in a block, one at least."""
    first = block * n // blocks
    return range(first, max(first + 1, (block + 1) * n // blocks))


class Ranking:
    """Weights over standardised features and the threshold of acceptance.

    Learned from arrays here, and from tables by ``learn``. Blocks have ``pairs`` pairs at most.
    """

    def __init__(self, x: np.ndarray, good: np.ndarray, pairs: int = PAIRS):
        x = x.reshape(-1, FEATURES)
        self.mean, self.spread = np.zeros(FEATURES), np.ones(FEATURES)
        self.weights = np.zeros(FEATURES)
        self.threshold, self.unit = 0.0, 1.0
        # With one kind of label there is no pair; its share decides for all.
        self.share = float(good.mean()) if len(x) else 1.0
        if good.all() or not good.any():
            return
        self.standardise(x.mean(axis=0), x.std(axis=0))
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        better, worse = z[good], z[~good]
        blocks = _n_blocks(len(better), len(worse), pairs)
        parts = [
            (better[list(_dealt(k, len(better), blocks))], worse[list(_dealt(k, len(worse), blocks))])
            for k in range(blocks)
        ]
        self.weights = _fit(
            lambda weights: sum(_whole(_pair_sums(b, w, weights)) for b, w in parts),
            sum(len(b) * len(w) for b, w in parts),
        )
        strength = np.sort(z @ self.weights)
        cut = len(worse)
        self.decide(strength[cut - 1], strength[cut], np.std(strength))

    def standardise(self, mean: np.ndarray, spread: np.ndarray) -> None:
        self.mean, self.spread = mean, np.where(spread > 1e-12, spread, 1.0)

    def decide(self, below: float, above: float, unit: float) -> None:
        """Set the threshold between two strengths and the unit that strengths are measured in."""
        self.threshold, self.unit = float((below + above) / 2), float(max(unit, 1e-9))
        self.share = float("nan")

    def standardised(self, values: Column) -> list[Column]:
        return [
            F.greatest(
                F.lit(-8.0),
                F.least(F.lit(8.0), (values[i] - F.lit(float(m))) / F.lit(float(s))),
            )
            for i, (m, s) in enumerate(zip(self.mean, self.spread, strict=True))
        ]

    def strength(self, values: Column) -> Column:
        terms = [z * F.lit(float(w)) for z, w in zip(self.standardised(values), self.weights, strict=True)]
        return sum(terms[1:], terms[0])

    def score(self, values: Column) -> Column:
        """0 to 1, and ``ACCEPT`` at the threshold."""
        if not np.isnan(self.share):
            return F.when(values.isNotNull(), F.lit(self.share)).otherwise(self.share)
        at_threshold = float(np.log(ACCEPT / (1 - ACCEPT)))
        raised = (self.strength(values) - self.threshold) / self.unit + at_threshold
        return 1 / (1 + F.exp(-raised))


def _mean_and_spread(rows: DataFrame, values: list[Column]) -> tuple[np.ndarray, np.ndarray]:
    """Of each value over all rows, the same in whatever order they are added."""
    ends = rows.agg(*[F.min(v) for v in values], *[F.max(v) for v in values]).first()
    least, most = np.array(ends, float).reshape(2, -1)
    wide = np.where(most > least, most - least, 1.0)
    places = [(v - F.lit(float(a))) / F.lit(float(w)) for v, a, w in zip(values, least, wide, strict=True)]
    sums = [
        F.sum(F.rint(p * F.lit(_PLACE_UNIT)).cast("decimal(20,0)"))
        for p in [*places, *[p * p for p in places]]
    ]
    found = rows.agg(F.count("*"), *sums).first()
    means = np.array([int(v) / (found[0] * int(_PLACE_UNIT)) for v in found[1:]])
    first, second = means[: len(values)], means[len(values) :]
    return least + first * wide, np.sqrt(np.maximum(second - first**2, 0)) * wide


def _ranked_pair(values: DataFrame, n: int) -> tuple[float, float]:
    """The ``n``-th smallest ``v``, counted from 1, and the one after it (itself, if it is last).

    Values are counted by bin between bounds, which then close in on the bin that has the rank.
    """
    least, most = values.agg(F.min("v"), F.max("v")).first()
    before = 0
    while least < most:
        place = (F.col("v") - F.lit(least)) / F.lit(most - least)
        # The greatest has a bin of its own, so that bounds close in with every round.
        bin_ = F.when(F.col("v") == F.lit(most), BINS).otherwise(
            F.least(F.lit(BINS - 1), F.floor(place * BINS)).cast("int")
        )
        inside = values.filter(F.col("v").between(least, most))
        counts = inside.groupBy(bin_.alias("bin")).agg(F.count("*"), F.min("v"), F.max("v"))
        for _, count, low, high in sorted(map(tuple, counts.collect())):
            if before + count >= n:
                least, most = low, high
                break
            before += count
    upto, following = values.agg(
        F.count(F.when(F.col("v") <= F.lit(least), 1)), F.min(F.when(F.col("v") > F.lit(least), F.col("v")))
    ).first()
    return least, least if upto > n or following is None else following


def _in_blocks(marked: DataFrame, ranking: Ranking, good: int, bad: int, pairs: int) -> DataFrame:
    """(better, worse): the standardised features of each block's documents, one after another."""
    placed = marked.withColumns({"_hash": F.xxhash64("doc_id"), "_one": F.lit(1)})
    numbered = with_rows_before(placed, ["good"], ["_hash", "doc_id", "features"], "_one", "_nth")
    n, blocks = F.when(F.col("good"), good).otherwise(bad).cast("long"), _n_blocks(good, bad, pairs)
    # The same blocks as ``_dealt`` gives, by document.
    last = F.call_function("div", (F.col("_nth") + 1) * blocks - 1, n)
    first = F.least(F.call_function("div", F.col("_nth") * blocks + n - 1, n), last)
    dealt = numbered.select(
        F.explode(F.sequence(first, last)).alias("block"), "good", "_nth",
        F.array(*ranking.standardised(F.col("features"))).alias("z"),
    )

    def side(kind: Column) -> Column:
        listed = F.sort_array(F.collect_list(F.when(kind, F.struct("_nth", "z"))))
        return F.flatten(F.transform(listed, lambda row: row["z"]))

    return dealt.groupBy("block").agg(
        side(F.col("good")).alias("better"), side(~F.col("good")).alias("worse")
    ).drop("block")


def _block_total(blocks: DataFrame, weights: np.ndarray) -> list[int]:
    """The sums of all pairs of all blocks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _whole(np.zeros(FEATURES * (FEATURES + 1)))
        for batch in batches:
            for better, worse in zip(batch.column("better"), batch.column("worse"), strict=True):
                sides = [np.asarray(v.values).reshape(-1, FEATURES) for v in (better, worse)]
                total = total + _whole(_pair_sums(*sides, weights))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(total)), pa.int32()),
             pa.array([Decimal(int(v)) for v in total], pa.decimal128(38, 0))],
            ["place", "part"],
        )

    parts = map_batches(blocks, add, "place int, part decimal(38,0)")
    sums = parts.groupBy("place").agg(F.sum("part").alias("sum")).collect()
    return [int(r["sum"]) for r in sorted(sums)]


def learn(rows: DataFrame, pairs: int = PAIRS) -> Ranking:
    """Fit on all rows (doc_id, features, quality) with a quality of 0 or 1."""
    marked = settle(
        rows.filter(F.col("quality").isin(0, 1)).select("doc_id", "features", (F.col("quality") == 1).alias("good"))
    )
    n, good = marked.agg(F.count("*"), F.count(F.when(F.col("good"), 1))).first()
    ranking = Ranking(np.empty(0), np.ones(0, bool))
    if not 0 < good < n:
        ranking.share = 1.0 if good == n else 0.0
        return ranking
    ranking.standardise(*_mean_and_spread(marked, [F.col("features")[i] for i in range(FEATURES)]))
    blocks = settle(_in_blocks(marked, ranking, good, n - good, pairs))
    sides = [F.size(c).cast("long") / FEATURES for c in ("better", "worse")]
    n_pairs = int(blocks.agg(F.sum((sides[0] * sides[1]).cast("long"))).first()[0])
    ranking.weights = _fit(lambda weights: _block_total(blocks, weights), n_pairs)
    strengths = settle(marked.select(ranking.strength(F.col("features")).alias("v")))
    spread = _mean_and_spread(strengths, [F.col("v")])[1][0]
    ranking.decide(*_ranked_pair(strengths, n - good), spread)
    return ranking


def rank_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, quality) are those to learn from; a null or other label than 0 and
    1, a null doc_id and one without a document teach nothing. A document labelled
    repeatedly counts each time. Null and empty texts are scored like any other. Without
    two kinds of labels every document gets the share of label 1 (1 without any label).
    Only the text makes the score: the other columns of both tables are not looked at. No
    rows give no rows.
    """
    known = settle(features(docs))
    marked = labels.select(F.col("doc_id").cast("long"), "quality")
    ranking = learn(known.join(marked, "doc_id"))
    score = ranking.score(F.col("features"))
    return known.select("doc_id", score.alias("score")).withColumn(
        "predicted", (F.col("score") >= ACCEPT).cast("int")
    )


def keep_accepted(docs: DataFrame, ranked: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those that are rejected.

    Rows that share a doc_id, or have none, stay together if one of them is accepted.
    """
    rejected = (
        ranked.groupBy("doc_id")
        .agg(F.max("predicted").alias("best"))
        .filter("best = 0")
        .select(F.col("doc_id").alias("_rejected"))
    )
    same = docs["doc_id"].cast("long").eqNullSafe(rejected["_rejected"])
    return docs.join(rejected, same, "left_anti")
