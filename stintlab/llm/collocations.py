"""Phrases that recur, mined set by set from relations of occurrences (SETM).

An occurrence is a place in the texts and the phrase that begins there, both by number. Places
count words piece by piece, with one left out behind each piece, so that the next place is the
next position of the same piece or nothing. R(1) holds the occurrences of frequent words.
Round k joins R(k) with itself by next place: two phrases of k words that follow each other by one
word make a phrase of k + 1. In the first round a piece's words still stand in order, so each word
is read with the one behind it, and the pairs of frequent ones are written as they are read.
They are counted by phrase, and those of frequent phrases (a semi-join) are R(k + 1). It is kept in
buckets by the part of the input that the texts were read from, so that a task writes what it has
read, and as both sides lie in the same buckets, the next round is a merge join without a shuffle.
Occurrences are not shuffled at all, unless the frequent phrases are too many to be sent to them;
if the words already are, R(1) is made, kept and joined like the others.

What a round has read is removed when the next relation is written, and so is what was shuffled.

A phrase is counted where it is, so what a task hands on is one row per phrase it met. No
task holds a piece's or phrase's occurrences together: a long piece is one bucket's
sorted rows, and a phrase that is everywhere is added up before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlab.operators.ranking import with_rows_before
from stintlab.staging import discard, new_path, settle

LEAST_COUNT = 30
MOST_WORDS = 4
TOP = 2000
# A candidate inside a longer one goes if the longer one has this per cent of its count.
COVERED_PERCENT = 80
SCALE = 2_000_000
NO_LANGUAGE = "und"
# Buckets for each part of the input, so that few share one, and the most there are.
BUCKETS_PER_PART = 2
MOST_BUCKETS = 20_000
# Frequent phrases are sent to all tasks up to this many bytes; beyond it both sides are
# shuffled by phrase.
MOST_BYTES_SENT = 32 << 20
_BYTES_OF_NUMBERS = 24

# Fixed values of the texts' layout.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PIECE_ENDS = r"[.,;:!?\n\x0B\f\r]"
WORD_ENDS = r"[ \t]+"

# Joins by part and place may use that both sides lie in buckets of parts, and tasks
# may write several buckets at once instead of sorting by bucket first. Rows that were shuffled
# for a written table go once it is written.
_OPTIONS = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
# Relations are read once or twice and removed. Places rise by ones, and numbers are small; the
# second version of the files' pages writes both as differences, if not in dictionaries.
_FILES = {"compression": "zstd", "parquet.writer.version": "v2", "parquet.enable.dictionary": "false"}


@contextmanager
def _by_parts(spark: SparkSession) -> Iterator[None]:
    """Plan by how relations are stored; the session's options come back."""
    before = {name: spark.conf.get(name, None) for name in _OPTIONS}
    for name, value in _OPTIONS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def pieces(docs: DataFrame) -> DataFrame:
    """(lang, words) for every piece of ``docs`` (lang, text): its words in order."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE))
    # Explode as outer: else Spark filters for non-empty arrays, which splits each text twice.
    split = docs.select(lang.alias("lang"), F.explode_outer(F.split(text, PIECE_ENDS)).alias("piece"))
    return split.select("lang", F.array_remove(F.split(_lowered("piece"), WORD_ENDS), "").alias("words"))


def _lowered(name: str) -> Column:
    """A-Z lower-cased and nothing else. lower() does the same to ASCII texts, in less time than looking
    up each character."""
    ascii_only = F.octet_length(name) == F.length(name)
    return F.when(ascii_only, F.lower(name)).otherwise(F.translate(name, UPPER, LOWER))


def words(split: DataFrame) -> DataFrame:
    """(lang, word) for every word of some pieces."""
    return split.select("lang", F.explode_outer("words").alias("word")).filter(F.col("word").isNotNull())


def places(split: DataFrame) -> DataFrame:
    """(lang, word, at) for every word that has another in its piece, in order.

    An empty word behind each piece takes the place that is left out. A part's places begin
    alike.
    """
    ended = F.when(F.size("words") > 1, F.array_append("words", F.lit("")))
    numbered = split.select("lang", F.explode_outer(ended).alias("word")).select(
        "lang", "word", F.monotonically_increasing_id().alias("at")
    )
    return numbered.filter(F.col("word").isNotNull() & (F.col("word") != ""))


def neighbours(split: DataFrame) -> DataFrame:
    """(lang, word, next, at) for every word that has another behind it in its piece, in order.

    A piece's last word takes the place that is left out.
    """
    numbered = split.select("lang", "words", F.posexplode_outer("words").alias("i", "word")).select(
        "lang", "word", F.get("words", F.col("i") + 1).alias("next"), F.monotonically_increasing_id().alias("at")
    )
    return numbered.filter(F.col("next").isNotNull())


def _part() -> Column:
    """The part of the input that a place lies in."""
    return F.shiftright("at", 33).cast("int").alias("part")


def _table_name(path: str) -> str:
    return path.rsplit("/", 1)[-1].replace("-", "_")


def _bucketed(rows: DataFrame, buckets: int, in_place: bool, path: str | None = None) -> DataFrame:
    """Write (part, at, phrase) in buckets of parts; ``in_place`` says that each task has whole
    parts already, in order of place."""
    spark = rows.sparkSession
    path = path or new_path(spark)
    name = _table_name(path)
    if not in_place:
        rows = rows.repartition(buckets, "part").sortWithinPartitions("at")
    with _by_parts(spark):
        rows.write.options(**_FILES).bucketBy(buckets, "part").option("path", path).saveAsTable(name)
    return spark.table(name)


def _removed(spark: SparkSession, path: str) -> None:
    """Remove a relation that nothing will read again."""
    spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
    discard(spark, path)


def _first_pairs(split: DataFrame, frequent: DataFrame, path: str) -> DataFrame:
    """(at, part, first, second): neighbouring frequent words, written once. The numbers of words
    that can be sent to all tasks are small.

    Words are looked up by a hash, which is faster than by language and word; both are compared as well.
    """
    pairs = neighbours(split)
    for name, number in (("word", "first"), ("next", "second")):
        known = frequent.select(
            _hash("lang", "word").alias("known"), F.col("lang").alias("known_lang"),
            F.col("word").alias("known_word"), F.col("phrase").cast("int").alias(number),
        )
        same = (
            (F.col("hash") == F.col("known")) & _alike("lang", "known_lang") & _alike(name, "known_word")
        )
        hashed = pairs.select("*", _hash("lang", name).alias("hash"))
        pairs = hashed.join(F.broadcast(known), same).drop("hash", "known", "known_lang", "known_word")
    return settle(pairs.select("at", _part(), "first", "second"), path, **_FILES)


def _hash(lang: str, word: str) -> Column:
    return F.xxhash64(lang, word)


def _alike(one: str, other: str) -> Column:
    """Equality that is checked on what a join found, not made one of its keys."""
    return F.col(one).between(F.col(other), F.col(other))


def _with_number(
    occurrences: DataFrame, frequent: DataFrame, keys: list[str], n_bytes: int
) -> tuple[DataFrame, bool]:
    """Occurrences of frequent phrases with the phrase's number, and whether they stay where
    they are. ``n_bytes`` is the size of the frequent phrases' keys and numbers."""
    few = n_bytes <= MOST_BYTES_SENT
    known = frequent.select(*keys, "phrase")
    return occurrences.join(F.broadcast(known) if few else known, keys), few


def _followed(occurrences: DataFrame) -> DataFrame:
    """(at, part, first, second): two phrases that begin at neighbouring places."""
    first = occurrences.withColumnRenamed("phrase", "first")
    second = occurrences.select("part", (F.col("at") - 1).alias("at"), F.col("phrase").alias("second"))
    keys = ["at", "part"]
    return first.join(second.hint("merge"), keys).select(*keys, "first", "second")


def _numbered(phrases: DataFrame, n_bytes: int) -> DataFrame:
    """Phrases with numbers: small ones, from one task, where they are few enough to be sent."""
    few = phrases.coalesce(1) if n_bytes <= MOST_BYTES_SENT else phrases
    return settle(few.select(F.monotonically_increasing_id().alias("phrase"), "*"))


def _longer(pairs: DataFrame, shorter: DataFrame, least: int) -> DataFrame:
    """Frequent phrases of one word more, from the pairs (first, second) that make them.

    ``heads`` are the counts of a phrase's first 1, 2, ... words short of all, ``tails`` those of
    its last ones.
    """
    counted = pairs.groupBy("first", "second").count().filter(F.col("count") >= least)
    one = shorter.select(
        F.col("phrase").alias("first"), "lang", "text",
        F.array_append("heads", F.col("a")).alias("heads"),
    )
    other = shorter.select(
        F.col("phrase").alias("second"), "last",
        F.array_append("tails", F.col("a")).alias("tails"),
    )
    found = settle(counted)
    joined = found.join(one, "first").join(other, "second").select(
        "lang", F.concat_ws(" ", "text", "last").alias("text"), "last",
        F.col("count").alias("a"), "heads", "tails", "first", "second",
    )
    return _numbered(joined, _BYTES_OF_NUMBERS * found.count())


def _score(a: Column, left: Column, right: Column, scale: int) -> Column:
    """floor(scale * a / (left + right)) in whole numbers beyond 64 bits."""
    wide = [c.cast("decimal(19,0)") for c in (a, left, right)]
    return F.call_function("div", wide[0] * F.lit(scale).cast("decimal(10,0)"), wide[1] + wide[2])


def _scored(phrases: DataFrame, words_each: int, scale: int) -> DataFrame:
    """Adds l, r and score of the cut that scores lowest, the earliest of equal ones."""
    cuts = []
    for k in range(1, words_each):
        left, right = F.get("heads", k - 1), F.get("tails", words_each - k - 1)
        score = _score(F.col("a"), left, right, scale)
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    lowest = F.array_min(F.array(*cuts))
    return phrases.withColumn("cut", lowest).select(
        "lang", "text", "phrase", "a", "cut.l", "cut.r", "cut.score"
    )


def _not_covered(phrases: DataFrame, longer: DataFrame, percent: int) -> DataFrame:
    """Drop phrases inside a longer one with at least ``percent`` of their count.

    Only phrases of one word more need be asked: a still longer one has one of these inside,
    with no smaller count.
    """
    within = longer.select(F.explode(F.array("first", "second")).alias("phrase"), F.col("a").alias("over"))
    most = within.groupBy("phrase").agg(F.max("over").alias("over"))
    wide = [F.col(c).cast("decimal(19,0)") for c in ("over", "a")]
    covered = wide[0] * 100 >= wide[1] * F.lit(percent)
    return phrases.join(most, "phrase", "left").filter(F.col("over").isNull() | ~covered).drop("over")


def mine_phrases(
    docs: DataFrame,
    least: int = LEAST_COUNT,
    most_words: int = MOST_WORDS,
    top: int = TOP,
    covered_percent: int = COVERED_PERCENT,
    scale: int = SCALE,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of ``docs`` (lang, text).

    A phrase is 2 to ``most_words`` words in a row of one piece that occur ``least`` times. Cut in two
    parts with counts l and r it scores floor(scale * a / (l + r)); its lowest score counts.
    Phrases inside a longer one with at least ``covered_percent`` of their count are left out. ``n``
    is the number of words of the language. Equal scores go by count, then by the phrase's bytes.

    A null text is an empty one, a null language is ``und``, the same as a language of that
    name. Repeated rows count again. Other columns of ``docs`` are not looked at. No rows give no
    rows, nor do languages without frequent phrases.
    """
    spark = docs.sparkSession
    split = pieces(docs.select("lang", "text"))
    counted = words(split).groupBy("lang", "word").agg(F.count("*").alias("a"))
    # Words that are too rare are one row per language, for its total.
    kept = F.when(F.col("a") >= least, F.col("word")).alias("word")
    with _by_parts(spark):
        every = settle(counted.groupBy("lang", kept).agg(F.sum("a").alias("a")))
    totals = every.groupBy("lang").agg(F.sum("a").alias("n"))
    listed = every.filter(F.col("word").isNotNull())
    n_bytes = listed.agg(
        F.sum(F.octet_length("lang") + F.octet_length("word") + _BYTES_OF_NUMBERS)
    ).first()[0] or 0
    none = F.array().cast("array<long>")
    frequent = _numbered(
        listed.select(
            "lang", "word", F.col("word").alias("text"), F.col("word").alias("last"), "a",
            none.alias("heads"), none.alias("tails"),
        ),
        n_bytes,
    )
    parts = docs.select(F.spark_partition_id().alias("part")).agg(F.max("part")).first()[0]
    buckets = int(min(MOST_BUCKETS, BUCKETS_PER_PART * (1 + (parts or 0))))
    path = new_path(spark)
    if n_bytes <= MOST_BYTES_SENT:
        pairs = _first_pairs(split, frequent, path)
    else:
        found, in_place = _with_number(places(split), frequent, ["lang", "word"], n_bytes)
        pairs = _followed(_bucketed(found.select(_part(), "at", "phrase"), buckets, in_place, path))

    levels = [frequent]
    for size in range(2, most_words + 1):
        with _by_parts(spark):
            longer = _longer(pairs, levels[-1], least)
        levels.append(longer)
        read = path
        if size < most_words:
            n_bytes = _BYTES_OF_NUMBERS * longer.count()
            kept, in_place = _with_number(pairs, longer, ["first", "second"], n_bytes)
            path = new_path(spark)
            pairs = _followed(_bucketed(kept.select("part", "at", "phrase"), buckets, in_place, path))
        _removed(spark, read)

    results = []
    for size, phrases in enumerate(levels[1:], start=2):
        best = _scored(phrases, size, scale)
        if size < most_words:
            best = _not_covered(best, levels[size], covered_percent)
        results.append(best.drop("phrase"))
    listed = results[0]
    for more in results[1:]:
        listed = listed.unionAll(more)
    ordered = listed.select(
        "*", (-F.col("score")).alias("_score"), (-F.col("a")).alias("_a"), F.lit(1).alias("_one")
    )
    ranked = with_rows_before(ordered, ["lang"], ["_score", "_a", "text"], "_one", "_before")
    return ranked.filter(F.col("_before") < top).join(totals, "lang").select(
        "lang", (F.col("_before") + 1).cast("long").alias("rank"), F.col("text").alias("phrase"),
        "a", "l", "r", "n", "score",
    )
