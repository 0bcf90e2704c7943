"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is dealt out in blocks of equal size, in words. Sainte-Lague gives each next block
to the highest quotient weight / (2 * blocks + 1): first to sources, by their targets, then
inside each source to its shards, by their sizes. A shard's documents lie end to end in a
seeded order; its quota takes whole passes over them and then blocks from the start.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintlab.llm.common import WORD, row_key, text_hash
from stintlab.staging import settle

# Words in a block, and the documents a shard is meant to hold.
BLOCK = 16
DOCS_PER_SHARD = 4096
SEED = 7
MOST_REPEATS = 3


def apportion(
    df: DataFrame, groups: Sequence[str], weight: str, total: str, seats: str, order: str, name: str
) -> DataFrame:
    """Add ``name``: each row's share of its group's ``seats`` by highest quotients.

    ``total`` holds the group's sum of ``weight``; ties go to the lesser ``order``. Rather
    than deal seats one by one, all that a divisor slightly too large gives are dealt at
    once; then at most as many are left as there are rows, and they are ranked.
    """
    whole = Window.partitionBy(*groups)
    share = F.col(weight) / F.col(total)
    counted = df.withColumn(
        "_n", F.sum(F.when(F.col(weight) > 0, 1).otherwise(0)).over(whole)
    ).withColumn(
        "_sure",
        F.when(
            F.col(weight) > 0,
            F.greatest(
                F.lit(0),
                F.floor(share * (F.col(seats) - F.col("_n") / 2) + F.lit(0.5 - 1e-9)),
            ),
        )
        .otherwise(0)
        .cast("long"),
    )
    counted = counted.withColumn("_left", F.col(seats) - F.sum("_sure").over(whole))
    asks = counted.filter(F.col(weight) > 0).select(
        *groups,
        order,
        "_left",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.ceil(share * F.col("_n")).cast("int") + 1),
                lambda j: F.col(weight) / (2 * (F.col("_sure") + j) + 1),
            )
        ).alias("_j", "_quotient"),
    )
    ranked = Window.partitionBy(*groups).orderBy(F.desc("_quotient"), order, "_j")
    given = (
        asks.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") <= F.col("_left"))
        .groupBy(*groups, order)
        .agg(F.count("*").alias("_more"))
    )
    keys = list(dict.fromkeys([*groups, order]))
    return (
        counted.join(given, keys, "left")
        .withColumn(name, F.col("_sure") + F.coalesce("_more", F.lit(0)))
        .drop("_n", "_sure", "_left", "_more")
    )


def source_targets(sources: DataFrame, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """Add place, weight and target to (source, source_size), one row per source.

    Sources rank by code point, null last, and weigh 1, 2, 3, repeating. No target is
    above ``most_repeats`` times its source; what is above is shared out again by weight.
    The capped sources are those with the least room per weight, so one sorted pass finds
    the level that the others share. The window holds one row per source.
    """
    all_rows = Window.partitionBy("_all")
    by_room = all_rows.orderBy("_room", "place")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(0, Window.unboundedFollowing)
    ranked = (
        sources.withColumn("_all", F.lit(0))
        .withColumn(
            "place",
            F.row_number().over(all_rows.orderBy(F.asc_nulls_last("source"))),
        )
        .withColumn("weight", (F.col("place") - 1) % 3 + 1)
        .withColumn("_cap", most_repeats * F.col("source_size"))
        .withColumn("_room", F.col("_cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(all_rows))
    )
    rest = F.col("total") - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    level = rest / F.sum("weight").over(after)
    levelled = ranked.withColumn("_level", level).withColumn(
        "_level", F.max(F.when(F.col("_level") <= F.col("_room"), F.col("_level"))).over(all_rows)
    )
    target = F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("weight"))
    return levelled.withColumn("target", F.coalesce(target, F.lit(0.0))).drop(
        "_cap", "_room", "_level"
    )


def _seeded(seed: int) -> Column:
    return F.md5(
        F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    )


def mix(
    docs: DataFrame,
    block: int = BLOCK,
    docs_per_shard: int = DOCS_PER_SHARD,
    seed: int = SEED,
    most_repeats: int = MOST_REPEATS,
) -> DataFrame:
    """(doc_id, source, text_hash, size, source_size, target, taken) for every row of ``docs``.

    ``taken`` is the number of words the mix takes from the document, repeats counted:
    ``taken div size`` whole copies and the first ``taken mod size`` words. A null or empty
    text has size 0 and gives nothing. A null source is a source, ranked last. Repeated
    rows are documents of their own. Documents are ordered by a hash of seed and doc_id,
    then by doc_id and a hash of the text, so reruns agree. Other columns are not looked at. No rows
    give no rows.

    A source may hold any share of the rows: it is cut into shards by hash, and only a
    shard's rows (about ``docs_per_shard``) are ever put in order together.
    """
    sized = settle(
        docs.select(
            F.col("doc_id").cast("long"),
            F.col("source").cast("string"),
            text_hash().alias("text_hash"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        )
    )
    sources = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs")
    )
    blocks = F.round(F.col("total") / block).cast("long")
    targets = settle(
        apportion(
            source_targets(sources, most_repeats).withColumn("_blocks", blocks),
            ["_all"], "target", "total", "_blocks", "place", "blocks",
        ).select(
            F.col("source").alias("_source"), "place", "source_size", "target", "blocks",
            F.ceil(F.col("n_docs") / docs_per_shard).alias("n_shards"),
        )
    )
    drawn = F.conv(F.substring("drawn", 1, 8), 16, 10).cast("long")
    placed = (
        sized.withColumn("drawn", _seeded(seed))
        .join(targets, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("shard", drawn % F.col("n_shards"))
    )
    shards = placed.groupBy("place", "shard", "blocks", "source_size").agg(
        F.sum("size").alias("shard_size")
    )
    quotas = settle(
        apportion(shards, ["place"], "shard_size", "source_size", "blocks", "shard", "quota").select(
            "place",
            "shard",
            "shard_size",
            F.least(F.col("quota") * block, F.col("shard_size") * most_repeats).alias("words"),
        )
    )
    laid = (
        Window.partitionBy("place", "shard")
        .orderBy("drawn", "doc_id", "text_hash")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum("size").over(laid), F.lit(0))
    rest = F.greatest(F.lit(0), F.least(F.col("words") % F.col("shard_size") - F.col("offset"), F.col("size")))
    passes = F.floor(F.col("words") / F.col("shard_size"))
    taken = F.when(F.col("shard_size") > 0, passes * F.col("size") + rest).otherwise(0)
    return (
        placed.withColumn("offset", offset)
        .join(quotas, ["place", "shard"])
        .select(
            "doc_id", "source", "text_hash", "size", "source_size", "target",
            taken.cast("long").alias("taken"),
        )
    )


def first_words(text: Column, n: Column) -> Column:
    """The beginning of a text up to the end of its n-th word."""
    pieces = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    return F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), "")


def take(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as ``mixed`` takes them, with their columns.

    A document comes in whole copies and, for the rest of its words, once more with the
    beginning of its text. What is not taken does not come.
    """
    keys = ["_doc", "_text"]
    amounts = (
        mixed.withColumns({"_doc": row_key("doc_id", "source"), "_text": F.col("text_hash")})
        .groupBy(*keys)
        .agg(F.sum("taken").alias("_taken"), F.max("size").alias("_size"))
        .filter(F.col("_taken") > 0)
    )
    # Equal rows are dropped where the join then finds them: one shuffle of the texts.
    keyed = docs.withColumns({"_doc": row_key("doc_id", "source"), "_text": text_hash()})
    joined = keyed.dropDuplicates(keys).join(amounts, keys)
    whole, rest = F.floor(F.col("_taken") / F.col("_size")), F.col("_taken") % F.col("_size")
    none = F.array().cast("array<bigint>")
    copies = F.concat(
        F.array_repeat(F.col("_size"), whole.cast("int")), F.when(rest > 0, F.array(rest)).otherwise(none)
    )
    taken = joined.withColumn("_words", F.explode(copies))
    part = F.when(F.col("_words") == F.col("_size"), F.col("text")).otherwise(
        first_words(F.col("text"), F.col("_words"))
    )
    cut = taken.withColumn("text", part)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast("long"))
    return cut.select(*docs.columns)
