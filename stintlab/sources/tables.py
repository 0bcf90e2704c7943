"""Flat tables as CSV with a header line in each file."""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlab import schemas


def read_table(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str],
    present: Sequence[str] | None = None,
) -> DataFrame:
    """The table as text columns named ``columns``.

    Nothing is inferred. Each file's header must list the expected names in order, so a
    file with a shifted layout fails instead of being read into the wrong columns. Files
    that lack optional columns are read by naming what they hold in ``present``; the
    others are NULL.
    """
    present = list(columns) if present is None else list(present)
    table = (
        spark.read.schema(schemas.text_table(present))
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )
    return table.select(
        *[F.col(c) if c in present else F.lit(None).cast("string").alias(c) for c in columns]
    )


def plain_path(file: str) -> str:
    """A path for the reader: spelled out, and without the characters of patterns."""
    return re.sub(r"([*?{}\[\]\\])", r"\\\1", unquote(file))


def files_by_header(spark: SparkSession, path: str | list[str]) -> Mapping[tuple[str, ...], list[str]]:
    """The files under ``path`` by the names in their header line; empty files have none.

    Takes a pass over the lines, as text, of which one per file goes on.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    # The first block's lines are read in order.
    first = (
        lines.filter(F.col("start") == 0)
        .withColumn("nth", F.monotonically_increasing_id())
        .groupBy("file")
        .agg(F.min_by("value", "nth").alias("header"))
    )
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first.groupBy("header").agg(F.collect_list("file").alias("files")).collect():
        names = tuple(next(csv.reader([row["header"]]), ()))
        found.setdefault(names, []).extend(plain_path(file) for file in row["files"])
    return {names: sorted(files) for names, files in sorted(found.items())}


def read_layouts(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str],
    needed: Sequence[str],
    others: bool = False,
) -> DataFrame:
    """Files of several layouts, say of several seasons, as one table of text columns.

    Each file is read by its own header, with one scan per layout; columns that a layout lacks
    are NULL. The table has ``columns``, and with ``others`` those that layouts have beside
    them, in name order. A layout must have the ``needed`` columns; without ``others`` it must
    also have no unknown column, and its columns in the order of ``columns``, so that a shifted
    header fails. A name that a header lists twice fails as well.
    """
    layouts = files_by_header(spark, path)
    if not layouts:
        raise ValueError("no header line in the files")
    for names, files in layouts.items():
        absent = [c for c in needed if c not in names]
        known = [c for c in names if c in columns]
        wrong = (
            f"lacks {', '.join(absent)}" if absent
            else "lists a name twice" if len(set(names)) < len(names)
            else "has unknown columns" if not others and len(known) < len(names)
            else "is out of order" if not others and known != [c for c in columns if c in names]
            else None
        )
        if wrong:
            raise ValueError(f"the header of {files[0]} {wrong}")
    parts = [read_table(spark, files, names) for names, files in layouts.items()]
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    more = sorted(set(table.columns) - set(columns)) if others else []
    return table.select(
        *[F.col(c) if c in table.columns else F.lit(None).cast("string").alias(c) for c in columns],
        *["`" + c.replace("`", "``") + "`" for c in more],
    )


def read_laps(
    spark: SparkSession,
    path: str | list[str],
    present: Sequence[str] | None = None,
    layouts: bool = False,
) -> DataFrame:
    """The lap table; with ``layouts`` each file may lack other optional columns."""
    if layouts:
        return read_layouts(spark, path, schemas.LAP_COLUMNS, schemas.NEEDED_LAP_COLUMNS)
    return read_table(spark, path, schemas.LAP_COLUMNS, present)


def read_telemetry(spark: SparkSession, path: str | list[str], layouts: bool = False) -> DataFrame:
    """The telemetry table with the columns its files have.

    Seasons differ in their channels, so the header decides; all files must have the same
    one, with at least the keys and the channels that the reports use. With ``layouts`` each
    file may have channels of its own, which are NULL for the others.
    """
    needed = [*schemas.TELEMETRY_KEYS, *schemas.TELEMETRY_CHANNELS]
    if layouts:
        return read_layouts(spark, path, needed, needed, others=True)
    header = spark.read.option("header", True).csv(path).columns
    absent = [c for c in needed if c not in header]
    if absent:
        raise ValueError(f"no telemetry table: its header lacks {', '.join(absent)}")
    return read_table(spark, path, header)


def read_drivers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_table(spark, path, schemas.DRIVER_COLUMNS)


def read_results(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_table(spark, path, schemas.RESULT_COLUMNS)
