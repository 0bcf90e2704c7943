"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlab.llm.collocations import mine_phrases
from stintlab.llm.common import held_out, table
from stintlab.llm.infill import fill_in_middle, restored
from stintlab.llm.licenses import scan_licenses
from stintlab.llm.merkle import compare_with_edits
from stintlab.llm.mixing import mix
from stintlab.llm.oracles import ORACLES
from stintlab.llm.packing import pack
from stintlab.llm.pii import KINDS, find_personal_data
from stintlab.llm.quality import rank_quality
from stintlab.llm.sentencepieces import encode
from stintlab.llm.simhash import hex_digits, near_duplicates
from stintlab.llm.topk import top_k
from stintlab.llm.toxicity import find_toxic
from stintlab.llm.warc import read_records, write_archives


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def _spans(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def op2_pii_semi_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in KINDS
    ]
    digest = F.sha2(_spans(F.col("base")).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, _spans(F.col("spans")).alias("spans"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_records(write_archives(table(spark, sf_dir, "pages")))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors.filter(F.col("vec_id") % 20 == 0), vectors)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op7_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter(~held_out(4, 2))
    ranked = rank_quality(table(spark, sf_dir, "documents"), labels)
    return ranked.select("doc_id", held_out(4, 2).alias("held_out"), "score", "predicted")


def op8_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    listed = F.transform(
        "matches", lambda m: F.concat_ws(":", m["license"], m["start"], m["end"])
    )
    return found.select("doc_id", "n_licenses", "coverage", F.array_join(listed, ",").alias("matches"))


def op10_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter(~held_out(3, 1))
    found = find_toxic(table(spark, sf_dir, "documents"), labels)
    return found.select(
        "doc_id", held_out(3, 1).alias("held_out"), "score", "predicted", "n_tokens", "passages"
    )


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        _digest(F.col("output")).alias("output_sha256"),
        _digest(restored()).alias("restored_sha256"),
    )


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(table(spark, sf_dir, "documents"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = encode(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _digest(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        _digest(F.col("decoded")).alias("decoded_sha256"),
    )


__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup,
        op2_pii_semi_crf,
        op3_source_mixing,
        op4_warc_index,
        op5_exact_topk,
        op6_best_fit_packing,
        op7_quality_ranking,
        op8_merkle_fingerprints,
        op9_license_scan,
        op10_toxic_segments,
        op11_fill_in_middle,
        op12_phrase_collocations,
        op13_sentencepiece,
    )
}
