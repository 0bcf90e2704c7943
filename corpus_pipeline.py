"""Raw documents to training sequences, stage by stage.

Each stage takes the documents that the stage before kept, applies one operator to all of them
and returns those that go on, with its decisions applied. Between stages they are written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stintlab.llm.common import table
from stintlab.llm.mixing import mix, take
from stintlab.llm.packing import pack
from stintlab.llm.pii import mask_personal_data
from stintlab.llm.quality import keep_accepted, rank_quality
from stintlab.llm.simhash import keep_one_each, near_duplicates
from stintlab.staging import settle


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking accepts."""
    return keep_accepted(docs, rank_quality(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints at most two bits apart."""
    return keep_one_each(docs, near_duplicates(docs))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return mask_personal_data(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them, the last copy cut to the words
    that are left."""
    return take(docs, mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document, placed in a sequence."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", accept_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_pii),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if place == 0 else settle(docs), sf_dir)
    return docs


# Learned models, XXH64 and token ids are beyond SQL.
ORACLE_SQL: str | None = None

QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
