"""Toxic passages: maximum-scoring segments of token log-odds.

Keys are words and their beginnings. A key's log-odds of toxic against clean documents has a
Dirichlet prior in proportion to the key's documents in the whole corpus, and counts only where
it is significant and the key is in some toxic documents that were learned from: those are the
keys that the corpus is searched for. Every token also costs a constant. All
maximal segments of positive sum are found in one pass over a text's tokens. Their sums in
clean text follow an extreme-value law, whose two parameters come from the clean documents'
token scores, so that a segment's score becomes the number of such segments to expect by
chance. Segments below a limit of that number are toxic passages.

A document's segments together give its evidence. What evidence clean documents reach is
fitted to the tail of those that were learned from, and the document's score follows from
the share of clean documents that would reach as much.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator, Mapping
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlab.llm.common import bounded_sample, map_batches
from stintlab.staging import settle

# Labelled documents that are learned from.
MAX_SAMPLE = 50_000
# Standard errors that a key's log-odds must exceed to count.
SIGNIFICANT = 2.5
# Toxic documents of the sample that a key must be in to count.
LEAST_DOCUMENTS = 3
# What every token costs, in units of log-odds.
COST = 0.5
# Chance segments to expect in a whole document at a passage's score.
EXPECTED = 0.05
# Share of clean documents that may be called toxic.
CLEAN_ERRORS = 0.005
ACCEPT = 0.7
# Clean documents in the tail without which it is not fitted.
_LEAST_TAIL = 20
# Beginnings of a word, in bytes, that are keys of their own.
STEMS = (8, 7, 6, 5, 4)
# The least log-odds that count.
LEAST_ODDS = 2.0
# Words and keys that a task remembers; once full, a memory stays as it is, counts go out.
_REMEMBERED = 200_000
# ASCII marks and digits part words; letters of other scripts are bytes above 127.
_BREAKS = bytes.maketrans(
    bytes(string.punctuation + string.digits, "ascii"),
    b" " * len(string.punctuation + string.digits),
)


def tokens(text: str | None) -> list[bytes]:
    """The words of a text, in lower case and without marks and digits."""
    return (text or "").lower().encode().translate(_BREAKS).split()


def word_keys(word: bytes) -> list[bytes]:
    """A word and its longer beginnings, the longest first.

    Where a word is too rare to judge, what it begins with stands in for it. Beginnings end
    with a mark that no word has.
    """
    return [word, *(word[:n] + b"*" for n in STEMS if n < len(word))]


def word_score(word: bytes, odds: Mapping[bytes, float]) -> float:
    """The log-odds of a word, or of the longest of its beginnings that has any, less the cost."""
    return next((odds[key] for key in word_keys(word) if key in odds), 0.0) - COST


class _Remembered(dict):
    """Values by word, worked out once for as many words as there is room for."""

    def __init__(self, work):
        self._work = work

    def __missing__(self, word: bytes):
        value = self._work(word)
        if len(self) < _REMEMBERED:
            self[word] = value
        return value


def sample_counts(taught: DataFrame) -> DataFrame:
    """(key, n_toxic, n_clean, words): documents of ``taught`` (text, toxic) with the key; the row
    without a key has the distinct words of all toxic documents."""

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        n_words = 0

        def counted() -> pa.RecordBatch:
            keys = [None, *(counts[0].keys() | counts[1].keys())]
            columns = [[0, *(c[k] for k in keys[1:])] for c in (counts[1], counts[0])]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.binary()), *(pa.array(c, pa.int64()) for c in columns),
                    pa.array([n_words, *[0] * (len(keys) - 1)], pa.int64()),
                ],
                ["key", "n_toxic", "n_clean", "words"],
            )

        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic"), strict=True):
                words = set(tokens(text.as_py()))
                counts[toxic.as_py()].update({key for w in words for key in word_keys(w)})
                n_words += len(words) * toxic.as_py()
            if len(counts[0]) + len(counts[1]) > _REMEMBERED:
                yield counted()
                counts, n_words = (Counter(), Counter()), 0
        yield counted()

    rows = map_batches(taught, change, "key binary, n_toxic long, n_clean long, words long")
    return rows.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n_toxic", "n_clean", "words")])


def corpus_counts(docs: DataFrame, keys: list[bytes]) -> tuple[np.ndarray, int]:
    """How many rows of ``docs`` (text) have each key, and the distinct words of all rows."""
    shared = docs.sparkSession.sparkContext.broadcast({key: i for i, key in enumerate(keys)})
    n = len(keys)

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value
        counts, n_words = np.zeros(n, np.int64), 0
        known = _Remembered(lambda word: [places[k] for k in word_keys(word) if k in places])
        for batch in batches:
            for text in batch.column("text"):
                words = set(tokens(text.as_py()))
                n_words += len(words)
                seen = {i for w in words for i in known[w]}
                counts[np.fromiter(seen, np.int64, len(seen))] += 1
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *used.tolist()], pa.int64()), pa.array([n_words, *counts[used].tolist()], pa.int64())],
            ["place", "n"],
        )

    rows = map_batches(docs.select(F.col("text").cast("string")), change, "place long, n long")
    # A row per key sought, however large the corpus.
    summed = {r["place"]: r["n"] for r in rows.groupBy("place").agg(F.sum("n").alias("n")).collect()}
    return np.array([summed.get(i, 0) for i in range(n)], np.int64), summed.get(-1, 0)


def _odds(toxic: np.ndarray, clean: np.ndarray, total_toxic: float, total_clean: float) -> tuple:
    """Log-odds and their standard errors from counts with their prior. The prior weighs as
    much as the toxic documents themselves."""
    others_toxic = np.maximum(2 * total_toxic - toxic, 1e-9)
    others_clean = np.maximum(total_clean + total_toxic - clean, 1e-9)
    odds = np.log(toxic / others_toxic) - np.log(clean / others_clean)
    return odds, np.sqrt(1 / toxic + 1 / clean)


class TokenScores:
    """Log-odds by key and the extreme-value parameters that go with them."""

    def __init__(
        self, keys: list[bytes], counts: np.ndarray, total_toxic: float, total_clean: float, rate: float
    ):
        """``counts`` has a row (all, toxic, clean) per key; the totals are over all keys there
        are. ``rate`` is what part of all documents' words the toxic ones of the sample have."""
        self.odds: dict[bytes, float] = {}
        self.slope, self.scale = 1.0, 0.1
        if not total_toxic or not total_clean or not len(keys):
            return
        n_all, n_toxic, n_clean = counts.astype(float).T
        prior = np.maximum(rate * n_all, 1e-9)
        odds, error = _odds(n_toxic + prior, n_clean + prior, total_toxic, total_clean)
        counting = (odds > SIGNIFICANT * error) & (odds > LEAST_ODDS) & (n_toxic >= LEAST_DOCUMENTS)
        if not counting.any():
            return
        self.odds = {key: float(o) for key, o, good in zip(keys, odds, counting, strict=True) if good}
        share = (n_clean + prior)[counting] / (total_clean + total_toxic)
        # Chance of a positive token, a bound of the chance that a segment begins there.
        self.scale = float(share.sum())
        self.slope = self._slope(odds[counting], share)

    def of_word(self, word: bytes) -> float:
        return word_score(word, self.odds)

    def _slope(self, odds: np.ndarray, share: np.ndarray) -> float:
        """The positive root of sum(share * exp(slope * score)) = 1 over all keys."""
        rest = max(0.0, 1 - float(share.sum()))

        def excess(x: float) -> float:
            return float((share * np.exp(x * (odds - COST))).sum() + rest * np.exp(-x * COST)) - 1

        low, high = 0.0, 1.0
        while excess(high) < 0 and high < 64:
            low, high = high, high * 2
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if excess(middle) < 0 else (low, middle)
        return max(high, 1e-6)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal segments (from, to, sum) of positive sum, in linear time.

    Left to right, each positive token opens a candidate. Before it stands, in a chain of
    links, the nearest candidate that begins lower. If the new one ends at least as high as
    that one, both and all between become one, which is tried again; else it stands.
    """
    found: list[tuple] = []  # from, to, height before, height at the end, link
    height = np.concatenate([[0.0], np.cumsum(scores)])
    for at in np.flatnonzero(scores > 0):
        start, low, high = int(at), float(height[at]), float(height[at + 1])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                found.append((start, int(at) + 1, low, high, j))
                break
            start, low = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, high - low) for a, b, low, high, _ in found]


def evidence(n_tokens: int, sums: list[float], slope: float, scale: float) -> float:
    """How far the best r segments together are beyond chance, for the best r.

    Each adds its normalised score, slope * sum - log(scale * tokens), the negative logarithm
    of the segments like it to expect; log(r!) is for their order.
    """
    if not sums:
        return 0.0
    normal = slope * np.sort(np.array(sums))[::-1] - np.log(max(scale * n_tokens, 1e-9))
    ranks = np.arange(1, len(normal) + 1)
    return float(np.cumsum(normal + np.log(ranks)).max())


def sketch(words: list[bytes], known: dict[bytes, int]) -> int:
    """The least hash of five words in a row, which copies and most near copies share."""
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    if len(words) < 5:
        return crc32(b" ".join(words))
    mixed = np.zeros(len(words) - 4, np.uint64)
    for i in range(5):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(mixed)]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return int((mixed >> np.uint64(1)).min())


def teaching_sample(docs: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """(doc_id, toxic) of labelled documents, one of those with equal sketch and label.

    Drawn from at most ``max_sample`` labels, those whose id hashes lowest, so the table
    is small enough to broadcast whatever the corpus. Near copies teach once.
    """
    marked = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    drawn = settle(bounded_sample(marked, max_sample, "doc_id"))

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Remembered(crc32)
        for batch in batches:
            found = [sketch(tokens(t.as_py()), known) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.int64())],
                ["doc_id", "toxic", "sketch"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    taught = texts.join(F.broadcast(drawn), "doc_id").select("doc_id", "toxic", "text")
    sketched = map_batches(taught, change, "doc_id long, toxic int, sketch long")
    return settle(
        sketched.groupBy("toxic", "sketch")
        .agg(F.min("doc_id").alias("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )


def learn(docs: DataFrame, sample: DataFrame) -> TokenScores:
    """Scores from the sample (doc_id, toxic); the prior counts every row of ``docs``.

    What comes to the driver has a row per key that enough toxic documents of the sample
    have, whatever the corpus.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    seen = settle(sample_counts(texts.join(F.broadcast(sample), "doc_id").select("text", "toxic")))
    total_toxic, total_clean, n_words = (
        v or 0 for v in seen.agg(F.sum("n_toxic"), F.sum("n_clean"), F.sum("words")).first()
    )
    if not total_toxic or not total_clean:
        return TokenScores([], np.zeros((0, 3)), total_toxic, total_clean, 0.0)
    likely = (
        seen.filter(F.col("key").isNotNull() & (F.col("n_toxic") >= LEAST_DOCUMENTS)).orderBy("key").collect()
    )
    keys = [bytes(r["key"]) for r in likely]
    n_all, all_words = corpus_counts(texts, keys)
    counts = np.array([(n, r["n_toxic"], r["n_clean"]) for n, r in zip(n_all, likely, strict=True)])
    return TokenScores(keys, counts.reshape(-1, 3), total_toxic, total_clean, n_words / max(all_words, 1))


def tail(clean: np.ndarray) -> tuple[float, float, float]:
    """(u, share, rate): a share of clean documents has evidence above u, and beyond it that
    share falls with exp(-rate * distance)."""
    u = float(np.quantile(clean, 0.9)) if len(clean) else 0.0
    above = clean[clean > u] - u
    if len(above) < _LEAST_TAIL:
        return 0.0, 1.0, 1.0
    return u, len(above) / len(clean), float(1 / above.mean())


def find_toxic(docs: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """(doc_id, score, predicted, n_tokens, passages) for every row of ``docs`` (doc_id, text).

    ``passages`` are the significant segments as (from, to, score), counted in tokens.
    ``labels`` (doc_id, toxic) are those to learn from; other labels than 0 and 1 teach
    nothing, and a document labelled both ways counts as toxic. Null and empty texts have
    no token and the lowest score. Without both kinds of labels no token counts. Only the
    text makes the score: the other columns of both tables are not looked at. Repeated
    rows are scored each time. No rows give no rows.
    """
    sample = teaching_sample(docs, labels, max_sample)
    model = learn(docs, sample)
    slope, scale = model.slope, model.scale
    shared = docs.sparkSession.sparkContext.broadcast(model.odds)  # of the keys that count

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds = shared.value
        known = _Remembered(lambda word: word_score(word, odds))
        kind = pa.list_(
            pa.struct([("from", pa.int64()), ("to", pa.int64()), ("score", pa.float64())])
        )
        for batch in batches:
            strength, lengths, passages = [], [], []
            for text in batch.column("text"):
                words = tokens(text.as_py())
                own = np.fromiter(map(known.__getitem__, words), np.float64, len(words))
                segments = maximal_segments(own)
                strength.append(evidence(len(own), [s for _, _, s in segments], slope, scale))
                lengths.append(len(own))
                lowest = np.log(max(scale * len(own), 1e-9) / EXPECTED)
                passages.append(
                    [{"from": a, "to": b, "score": s} for a, b, s in segments if slope * s >= lowest]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(strength, pa.float64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(passages, kind),
                ],
                ["doc_id", "evidence", "n_tokens", "passages"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = settle(
        map_batches(
            rows,
            change,
            "doc_id long, evidence double, n_tokens long,"
            " passages array<struct<from: bigint, to: bigint, score: double>>",
        )
    )
    clean = found.join(F.broadcast(sample.filter("toxic = 0")), "doc_id").groupBy("doc_id")
    reached = clean.agg(F.max("evidence").alias("evidence")).toPandas()["evidence"]
    u, share, rate = tail(reached.to_numpy(float))
    x = F.col("evidence")
    below = x * (-np.log(share) / u if u > 0 else 0.0)
    rare = F.when(x <= u, below).otherwise((x - u) * rate - float(np.log(share)))
    at_limit = float(np.log(ACCEPT / (1 - ACCEPT)))
    raised = rare + float(np.log(CLEAN_ERRORS)) + at_limit
    return found.withColumn("score", 1 / (1 + F.exp(-raised))).select(
        "doc_id",
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
        "n_tokens",
        "passages",
    )
