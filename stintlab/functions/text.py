"""Reading values out of text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blanks and control characters, which surround values in hand-edited files.
_BLANKS = "".join(chr(c) for c in range(33))
MISSING = "None"
# What every text that is a number matches; ``None`` does not.
_NUMBER_LIKE = {
    "int": r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*$",
    "double": r"[0-9]|(?i:nan|inf)",
}


def tidy(name: str) -> Column:
    """The column as trimmed text; a missing value is the empty string."""
    return F.coalesce(F.btrim(F.col(name).cast("string"), F.lit(_BLANKS)), F.lit(""))


def label(name: str) -> Column:
    """Trimmed text with ``None`` read as empty."""
    return F.regexp_replace(tidy(name), f"^{MISSING}$", "")


def number(name: str, kind: str) -> Column:
    """The text as a number, or NULL where it is not one. Blanks do not matter.

    ``None`` and other texts that cannot be one are told apart first: every failing cast costs
    an exception, which takes longer than all the rest of a row.
    """
    text = F.col(name).cast("string")
    like = text.rlike(_NUMBER_LIKE[kind]) if kind in _NUMBER_LIKE else text != MISSING
    return F.when(like, text).try_cast(kind)


def number_or_zero(name: str, kind: str, none_is_zero: bool = False) -> Column:
    """As :func:`number`, but an empty value (and optionally ``None``) is 0."""
    gaps = ["", MISSING] if none_is_zero else [""]
    return F.when(tidy(name).isin(gaps), F.lit(0).cast(kind)).otherwise(number(name, kind))


def key_part(name: str, position: int, separator: str = "-") -> Column:
    """Part ``position`` of a composite key, NULL past its end."""
    return F.get(F.split(F.col(name), separator), F.lit(position))


def path_segment(segments: str, position: int) -> Column:
    """URL-decoded path segment; negative positions count from the file name.

    NULL where the path is too short or the segment is not valid URL encoding.
    """
    return F.try_url_decode(F.try_element_at(F.col(segments), F.lit(position)))
