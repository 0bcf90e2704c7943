"""Fill-in-the-middle: documents cut at two line ends and put together in another order.

A document's draws come from the SHA-256 of the seed and its id, so that they are the same in
every run and task. Its cuts are selected by rank in the set of its line ends
(:mod:`stintlab.llm.boundaries`). Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlab.llm.boundaries import Boundaries
from stintlab.llm.common import map_batches

SEED = 7
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Per cent of documents that are cut, and of those the part whose suffix comes first.
CUT_PERCENT = 100
SUFFIX_FIRST_PERCENT = 50
# Characters put out at once.
_AT_ONCE = 1 << 23


def draws(seed: int) -> list[Column]:
    """Four numbers below 2**32 from the seed and ``doc_id``; a null id counts as empty text."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), name).cast("binary"), 256)
    return [
        F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}")
        for i in range(4)
    ]


def cut(text: str, one: int, other: int) -> tuple[int, int, int]:
    """Number of units, and the places behind the lesser and the greater number of units that
    the draws come to."""
    places = Boundaries.of(text)
    n = len(places) - 1
    low, high = sorted((one % (n + 1), other % (n + 1)))
    return n, places.select(low), places.select(high)


def fill_in_middle(
    docs: DataFrame,
    seed: int = SEED,
    cut_percent: int = CUT_PERCENT,
    suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of ``docs``
    (doc_id, text).

    ``form`` is ``plain`` (the text as it is), ``psm`` (prefix, suffix, middle) or ``spm``
    (suffix, prefix, middle), each part behind its mark. Plain are empty texts, texts that hold
    one of the marks, and those not drawn; their lengths are null. ``n`` counts the lines.

    A null text is an empty one. A null doc_id draws as empty text does. Rows with equal id and
    text come out equal, each of them. Other columns of ``docs`` are not looked at. No rows give no
    rows.
    """

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for doc_id, text, h1, h2, h3, h4 in zip(*batch.columns, strict=True):
                text = text.as_py() or ""
                n, start, end = cut(text, h1.as_py(), h2.as_py())
                prefix, middle, suffix = text[:start], text[start:end], text[end:]
                if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3.as_py() % 100 >= cut_percent:
                    rows.append((doc_id.as_py(), n, "plain", None, None, text))
                elif h4.as_py() % 100 < suffix_first_percent:
                    output = f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
                    rows.append((doc_id.as_py(), n, "spm", len(prefix), len(middle), output))
                else:
                    output = f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
                    rows.append((doc_id.as_py(), n, "psm", len(prefix), len(middle), output))
                held += len(text)
                if held >= _AT_ONCE:
                    yield pa.RecordBatch.from_arrays(_arrays(rows), names)
                    rows, held = [], 0
            yield pa.RecordBatch.from_arrays(_arrays(rows), names)

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def _arrays(rows: list[tuple]) -> list[pa.Array]:
        columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
        return [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]

    drawn = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *draws(seed))
    return map_batches(drawn, change, schema)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that ``output`` was made of.

    A text that was cut holds no mark, and none can arise where parts meet, as a mark's ``<``
    stands at its start only. So the marks split the output into its parts.
    """
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)))
    first, second, middle = (F.get(parts, i) for i in (1, 2, 3))
    return (
        F.when(F.col(form) == "psm", F.concat(first, middle, second))
        .when(F.col(form) == "spm", F.concat(second, middle, first))
        .otherwise(F.col(output))
    )
