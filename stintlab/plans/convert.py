"""Raw JSON documents to flat tables.

Documents are parsed once. The arrays are those that the documents have, or those that are named;
a document that lacks one of them gives no rows, as the arrays are zipped, unless
``pad_missing`` keeps it. ``layout`` is ``"csv"`` (text, with a header) or ``"parquet"`` (typed, by
event and session; see ``sources.typed``). Of the latter, ``mode="refresh"`` replaces the sessions
that the documents are of and no others. ``compression`` is that of text tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlab import schemas
from stintlab.operators.reshape import driver_rows, lap_rows, telemetry_rows
from stintlab.sinks import write_csv
from stintlab.sources.cleaning import typed_laps, typed_telemetry
from stintlab.sources.documents import PATH_COLUMN, KeptDocuments, keep_documents, read_documents
from stintlab.sources.typed import write_typed


def _insist(kept: KeptDocuments, names: Sequence[str]) -> None:
    """Fail if a named array is in no document."""
    absent = [name for name in names if name not in kept.names]
    if absent:
        raise ValueError(f"in no document: {', '.join(absent)}")


def telemetry_table(
    spark: SparkSession,
    source: str | list[str],
    samples: Sequence[str] | None = None,
    pad_missing: bool = False,
) -> DataFrame:
    """The telemetry documents under ``source`` as one row per sample, all text."""
    kept = keep_documents(spark, source, "tel", ["dataKey"], samples)
    names = list(kept.names) if samples is None else list(samples)
    if not names:
        raise ValueError("no telemetry arrays in the documents")
    _insist(kept, names)
    arrays = [kept.text_array(c).alias(c) for c in names]
    return telemetry_rows(kept.rows.select(F.struct("dataKey", *arrays).alias("tel")), pad_missing)


def lap_table(
    spark: SparkSession,
    source: str | list[str],
    fields: Sequence[str] | None = None,
    pad_missing: bool = False,
) -> DataFrame:
    """The lap documents under ``source`` as one row per lap."""
    kept = keep_documents(spark, source, names=list(schemas.LAP_FIELDS) if fields is None else fields)
    names = [c for c in schemas.LAP_FIELDS if c in kept.names] if fields is None else list(fields)
    if "lap" not in names:
        raise ValueError("no lap arrays in the documents")
    _insist(kept, names)
    arrays = [kept.text_array(c).alias(c) for c in names]
    return lap_rows(kept.rows.select(F.split("path", "/").alias(PATH_COLUMN), *arrays), pad_missing)


def convert_telemetry(
    spark: SparkSession,
    source: str,
    target: str,
    samples: Sequence[str] | None = None,
    pad_missing: bool = False,
    mode: str = "errorifexists",
    layout: str = "csv",
    compression: str = "none",
) -> None:
    """Telemetry documents (``<event>/<session>/<driver>/<lap>_tel.json``) to a table.

    ``samples`` names the arrays to keep, each of which must be in some document; by default
    all arrays are kept, in name order.
    """
    rows = telemetry_table(spark, source, samples, pad_missing)
    if layout == "parquet":
        write_typed(typed_telemetry(rows), target, mode)
    else:
        write_csv(rows, target, mode, compression=compression)


def convert_laps(
    spark: SparkSession,
    source: str,
    target: str,
    fields: Sequence[str] | None = None,
    pad_missing: bool = False,
    mode: str = "errorifexists",
    layout: str = "csv",
    compression: str = "none",
) -> None:
    """Lap documents (``<event>/<session>/<driver>/laptimes.json``) to a table.

    ``fields`` names the arrays to keep, each of which must be in some document. Columns of
    the lap table that no document has an array for are NULL.
    """
    rows = lap_table(spark, source, fields, pad_missing)
    if layout == "parquet":
        write_typed(typed_laps(rows), target, mode)
    else:
        write_csv(rows, target, mode, compression=compression)


def convert_drivers(
    spark: SparkSession,
    source: str,
    target: str,
    mode: str = "errorifexists",
    compression: str = "none",
) -> None:
    """A session's driver list to a table; teams are those of that session."""
    docs = read_documents(spark, source, schemas.driver_document())
    write_csv(driver_rows(docs), target, mode, compression=compression)
