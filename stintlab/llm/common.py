"""What several of the operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def worker_memory() -> dict:
    """What this Python process keeps from task to task.

    Workers are used for many tasks, but each task brings the operators' code anew, so that a
    variable of a module would not last.
    """
    name = "stintlab_worker_memory"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(
    df: DataFrame, change: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Arrow batches in, Arrow batches out; integers keep their nulls, unlike in pandas."""
    return df.mapInArrow(change, schema)


def text_hash() -> Column:
    """Tells rows with equal doc_id but other texts apart; a null text is an empty one."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def row_key(*names: str) -> Column:
    """A number for the values of some columns, nulls included, that plain joins can compare."""
    values = [F.col(c).cast("long" if c == "doc_id" else "string") for c in names]
    return F.xxhash64(*[v.isNull() for v in values], *values)


def held_out(parts: int, part: int) -> Column:
    """Whether crc32 of the document's id, as text, falls to the part that is not learned from.

    A document without an id is not held out.
    """
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts
    return F.coalesce(remainder == part, F.lit(False))


def bounded_sample(rows: DataFrame, n: int, *order: str) -> DataFrame:
    """At most ``n`` rows, those whose first ``order`` column hashes lowest.

    Rows are first counted by the upper 16 bits of the hash, which tells how low a hash must be:
    only those rows are ranked, so what tasks hand to the driver does not grow with the
    table. One value that repeats often may bring more rows to be ranked, but no fewer.
    """
    place = F.xxhash64(order[0])
    part = F.shiftright(place, 48)
    # At most 65,536 counts.
    counts = rows.groupBy(part.alias("part")).count().orderBy("part").collect()
    upto = np.cumsum([r["count"] for r in counts])
    enough = int(np.searchsorted(upto, n))
    if enough < len(counts):
        rows = rows.filter(part <= counts[enough]["part"])
    return rows.orderBy(place, *order).limit(n)
