"""CSV output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from stintlab.staging import settle

# How hard gzip files are compressed: a sixth to a third larger than by default, and faster written.
GZIP_LEVEL = {"zlib.compress.level": "THREE"}


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    order_by: Sequence[str] = (),
    single_file: bool = False,
    compression: str = "none",
) -> None:
    """Write ``df`` with a header line in each file.

    By default an existing path is an error. ``order_by`` sorts the output across its
    files. ``single_file`` is meant for reports: the result is worked out and written by as
    many tasks as it takes, and one task then puts it into a file; with ``order_by`` it
    sorts there, without another exchange. ``compression`` (``"gzip"``) makes files a fraction as
    large, which only whole tasks can read.
    """
    if mode == "refresh":
        raise ValueError("text tables are not kept by session and cannot be refreshed")
    if single_file:
        df = settle(df).coalesce(1)
    if order_by:
        df = df.orderBy(*order_by)
    df.write.option("header", True).options(compression=compression, **GZIP_LEVEL).mode(mode).csv(path)
