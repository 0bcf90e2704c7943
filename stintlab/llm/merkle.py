"""Fingerprints of documents as Merkle trees over paragraphs and sections.

Paragraphs are lines; a paragraph's leaves are its sentences, long ones in stretches. A
section ends after a paragraph whose own hash says so, one in four on average, so that a
paragraph put in or taken out changes its own section and no later one. Every node hashes
what lies below it:

    root:section[paragraph{leaf.leaf},paragraph{leaf}];section[...]

Equal roots mean equal texts. Where roots differ, only branches with different hashes need
to be entered to find the edits.

Everything here is built of SQL functions; hashes are SHA-256.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintlab.staging import settle

# A leaf is a sentence with its end, or at most so many characters of it.
LEAF = r"[^.!?]{1,32}[.!?]?|[.!?]"
# Digits of the hashes that a fingerprint shows. Parents hash their children's whole hashes.
LEAF_DIGITS, NODE_DIGITS = 6, 8
# Last shown digits of a paragraph's hash that end its section.
SECTION_ENDS = "048c"
# Stands for a null doc_id, so that joins compare plain numbers.
NO_ID = -(2**63)
_WHOLE = r"([0-9a-f]{64})\{"


def _hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _paragraph(hashes: Column) -> Column:
    """hash{leaves} of a line's leaf hashes, its own hash in full."""
    shown = F.array_join(F.transform(hashes, lambda h: F.substring(h, 1, LEAF_DIGITS)), ".")
    return F.concat(_hash(F.array_join(hashes, "")), F.lit("{"), shown, F.lit("}"))


def _closed(paragraph: Column) -> Column:
    """A paragraph and the mark that says whether its section goes on."""
    last = F.substring(paragraph, NODE_DIGITS, 1)
    ends = F.lit(SECTION_ENDS).contains(last)
    return F.concat(paragraph, F.when(ends, F.lit(";")).otherwise(F.lit(",")))


def _section(paragraphs: Column) -> Column:
    """hash[paragraphs], its hash in full and theirs as shown."""
    children = F.array_join(F.regexp_extract_all(paragraphs, F.lit(_WHOLE), F.lit(1)), "")
    shown = F.regexp_replace(paragraphs, r"([0-9a-f]{8})[0-9a-f]{56}\{", "$1{")
    return F.concat(_hash(children), F.lit("["), F.rtrim(shown, F.lit(",")), F.lit("]"))


def _tree(sections: Column) -> Column:
    top = _hash(F.array_join(F.transform(sections, lambda s: F.substring(s, 1, 64)), ""))
    shown = F.transform(
        sections, lambda s: F.concat(F.substring(s, 1, NODE_DIGITS), F.substring(s, 65, 2**31 - 1))
    )
    return F.concat(top, F.lit(":"), F.array_join(shown, ";"))


def fingerprint(text: Column) -> Column:
    """The tree of a text as a string."""
    hashes = F.transform(
        F.split(text, "\n"),
        lambda line: F.transform(F.regexp_extract_all(line, F.lit(LEAF), F.lit(0)), _hash),
    )
    paragraphs = F.transform(F.transform(hashes, _paragraph), _closed)
    parts = F.split(F.rtrim(F.array_join(paragraphs, ""), F.lit(";,")), ";")
    return _let(F.transform(parts, _section), _tree)


def leaves(tree: Column) -> Column:
    return F.regexp_extract_all(tree, F.lit(r"[{.]([0-9a-f]{6})"), F.lit(1))


def root(tree: Column) -> Column:
    return F.substring_index(tree, ":", 1)


def likeness(tree: Column, other: Column) -> Column:
    """Share of different leaves that two trees have in common, from 0 to 1.

    1 exactly where the roots are equal; the same leaves in another order stay below.
    """

    def overlap(pair: Column) -> Column:
        total = F.size(pair["a"]) + F.size(pair["b"])
        shared = 2 * F.size(F.array_intersect(pair["a"], pair["b"]))
        return F.when(total == 0, F.lit(0.0)).otherwise(F.least(shared, total - 1) / total)

    pair = F.struct(
        F.array_distinct(leaves(tree)).alias("a"), F.array_distinct(leaves(other)).alias("b")
    )
    return F.when(root(tree) == root(other), F.lit(1.0)).otherwise(_let(pair, overlap))


def changed_paragraphs(tree: Column, other: Column) -> Column:
    """Numbers (from 0) of the paragraphs of ``tree`` that the other tree does not have.

    Sections that both trees have are not entered.
    """

    def sections(t: Column) -> Column:
        return F.split(F.substring_index(t, ":", -1), ";")

    known = sections(other)
    known_paragraphs = F.flatten(
        F.transform(known, lambda s: F.regexp_extract_all(s, F.lit(r"([0-9a-f]{8})\{"), F.lit(1)))
    )
    marked = F.flatten(
        F.transform(
            sections(tree),
            lambda s: F.transform(
                F.regexp_extract_all(s, F.lit(r"([0-9a-f]{8})\{"), F.lit(1)),
                lambda p: ~F.array_contains(known, s) & ~F.array_contains(known_paragraphs, p),
            ),
        )
    )
    numbered = F.transform(marked, lambda m, i: F.when(m, i))
    return F.filter(numbered, lambda i: i.isNotNull())


def next_ids(ids: DataFrame) -> DataFrame:
    """Add ``next_id`` to distinct doc_ids: the next greater one, the least after the last.

    Ids are sorted over ranges, and each range's last row looks at the next range's first.
    """
    ordered = settle(
        ids.repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id")
        .withColumn("place", F.monotonically_increasing_id())
    ).withColumn("range", F.shiftright("place", 33))
    firsts = ordered.groupBy("range").agg(F.min("doc_id").alias("first"))
    over_ranges = Window.partitionBy(F.lit(0)).orderBy("range")
    everything = over_ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select(
        "range",
        F.coalesce(F.lead("first").over(over_ranges), F.first("first").over(everything)).alias("after"),
    )
    within = Window.partitionBy("range").orderBy("place")
    return (
        ordered.withColumn("following", F.lead("doc_id").over(within))
        .join(after, "range")
        .withColumn("next_id", F.coalesce("following", "after"))
        .drop("place", "range", "following", "after")
    )


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Trees of every document, of its edited text and how near both and the next one are.

    One row per row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next. The edited text has the last
    quarter of the code points replaced by as many from the start of the next document, or
    all of it if it is shorter. Null texts are empty. Of rows that share a doc_id each is
    compared, and the one with the least beginning is the next document of the id before; a null
    doc_id comes before all others (and is not told from the least long). A single id is its own next. Other columns are not
    looked at. No rows give no rows.
    """
    base = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    quarter = F.floor(F.length("text") / 4).cast("int")
    wanted = settle(base.groupBy("doc_id").agg(F.max(quarter).alias("wanted")))
    asked = settle(next_ids(wanted)).select(F.col("doc_id").alias("asker"), "wanted", "next_id")
    found = base.join(asked, base["doc_id"] == asked["next_id"]).select(
        "asker",
        F.struct(
            F.substring("text", F.lit(1), F.col("wanted")).alias("head"),
            fingerprint(F.col("text")).alias("tree"),
        ).alias("next"),
    )
    # One shuffle for both: the join below finds the heads grouped by their asker.
    nearest = found.groupBy("asker").agg(F.min("next").alias("next"))
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - quarter),
        F.substring(F.col("next.head"), F.lit(1), quarter),
    )
    trees = (
        base.join(nearest, base["doc_id"] == nearest["asker"])
        .select(
            F.nullif(F.col("doc_id"), F.lit(NO_ID)).alias("doc_id"),
            F.length("text").cast("long").alias("n_chars"),
            "text",
            edited.alias("edited"),
            F.col("next.tree").alias("next_tree"),
        )
        .select(
            "doc_id",
            "n_chars",
            F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"),
            fingerprint(F.col("text")).alias("fingerprint"),
            fingerprint(F.col("edited")).alias("edited_fingerprint"),
            "next_tree",
        )
    )
    mine = F.col("fingerprint")
    return trees.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(mine, F.col("edited_fingerprint")).alias("near_edited"),
        likeness(mine, F.col("next_tree")).alias("near_next"),
    )
