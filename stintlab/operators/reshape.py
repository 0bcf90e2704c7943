"""Documents of parallel arrays to flat rows.

``arrays_zip`` pads short arrays with NULL. A document with one array missing
altogether gives no rows, as zipping with NULL is NULL; ``pad_missing`` reads such an
array as empty instead. No step here shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintlab import schemas
from stintlab.functions.text import key_part, number, path_segment
from stintlab.sources.documents import PATH_COLUMN

# Where a lap document's path holds its event and its session.
EVENT_SEGMENT = -4
SESSION_SEGMENT = -3

INTEGER_LAP_COLUMNS = {"lap", "stintNumber", "tyreAgeLaps"}


def _named(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def _explode(
    docs: DataFrame, keys: dict[str, Column], arrays: dict[str, str], pad_missing: bool
) -> DataFrame:
    """One row per array position; ``arrays`` maps each array's column to its row name.

    The keys are worked out per document, below the explode. The arrays are zipped inside
    it: Spark filters an exploded column for being non-empty, which would zip them anew.
    """

    def items(name: str) -> Column:
        return F.coalesce(_named(name), F.array()) if pad_missing else _named(name)

    keyed = docs.select(
        *[c.alias(name) for name, c in keys.items()],
        *[items(old).alias(f"{new}_items") for old, new in arrays.items()],
    )
    zipped = F.arrays_zip(*[_named(f"{new}_items").alias(new) for new in arrays.values()])
    return keyed.select(*keys, F.inline(zipped))


def telemetry_rows(docs: DataFrame, pad_missing: bool = False) -> DataFrame:
    """One row per telemetry sample, keyed by the five parts of ``dataKey``.

    Parts are split on every ``-``, so one inside a name shifts the parts after it.
    """
    tel = docs.select("tel.*")
    samples = {c: c for c in tel.columns if c != "dataKey"}
    keys = {name: key_part("dataKey", i) for i, name in enumerate(schemas.TELEMETRY_KEYS)}
    return _explode(tel, keys, samples, pad_missing)


def lap_rows(docs: DataFrame, pad_missing: bool = False) -> DataFrame:
    """One row per lap with the lap table's columns, in order.

    ``docs`` needs the ``lap`` array and the path segments (``read_documents(...,
    with_path=True)``). ``totalLaps`` is the number of laps in the document, i.e. of this
    driver in this session. Arrays the documents do not have become NULL columns.
    """
    present = {old: new for old, new in schemas.LAP_FIELDS.items() if old in docs.columns}
    keys = {
        "event": path_segment(PATH_COLUMN, EVENT_SEGMENT),
        "sessionType": path_segment(PATH_COLUMN, SESSION_SEGMENT),
        "totalLaps": F.size("lap"),
    }
    rows = _explode(docs, keys, present, pad_missing)

    def column(name: str) -> Column:
        if name not in rows.columns:
            value = F.lit(None).cast("string")
        elif name in INTEGER_LAP_COLUMNS and isinstance(rows.schema[name].dataType, T.StringType):
            value = number(name, "int")
        elif name in INTEGER_LAP_COLUMNS:
            value = F.col(name).try_cast("int")
        else:
            value = F.col(name)
        return value.alias(name)

    return rows.select(*[column(c) for c in schemas.LAP_COLUMNS])


def driver_rows(docs: DataFrame) -> DataFrame:
    """One row per entry of the ``drivers`` array, with descriptive names."""
    entries = docs.select(F.inline("drivers"))
    return entries.select(
        *[F.col(old).alias(new) for old, new in schemas.DRIVER_FIELDS.items()]
    )
