"""Finishing positions and top rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stintlab.staging import settle


def with_rows_before(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    weight: str,
    name: str,
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over the rows of the same keys that come earlier.

    ``totals`` maps further names to columns whose sum over all rows of the keys they get.

    No key is ever held in one task. The rows of all keys are range-partitioned and sorted
    at once and written; a running sum within each partition is then raised by what the
    key has in earlier partitions, which is one row per key and partition. ``keys`` and
    ``order`` must tell every row from any other.
    """
    keys, order = list(keys), list(order)
    place = "_place"
    rows = settle(
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn(place, F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright(place, 33))
    here = Window.partitionBy(*keys, "_part").orderBy(place).rowsBetween(
        Window.unboundedPreceding, -1
    )
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    every = Window.partitionBy(*keys).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    sums = [F.sum(column).alias(total) for total, column in (totals or {}).items()]
    parts = (
        rows.groupBy(*keys, "_part")
        .agg(F.sum(weight).alias("_sum"), *sums)
        .withColumn("_earlier", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .withColumns({total: F.sum(total).over(every) for total in totals or {}})
        .drop("_sum")
    )
    before = F.coalesce(F.sum(weight).over(here), F.lit(0)) + F.col("_earlier")
    return rows.join(parts, [*keys, "_part"]).withColumn(name, before).drop(
        place, "_part", "_earlier"
    )


def race_positions(totals: DataFrame) -> DataFrame:
    """Position by total time within each event; equal times rank by driver.

    ``totals`` has one row per event and driver. Fields of any size take the same way.
    """
    numbered = with_rows_before(
        totals.withColumn("_one", F.lit(1)), ["event"], ["total_time", "driver"], "_one", "_before"
    )
    return numbered.withColumn("position", (F.col("_before") + 1).cast("int")).select(
        *totals.columns, "position"
    )


def top_rows(df: DataFrame, columns: Sequence[str], n: int = 50) -> DataFrame:
    """The ``n`` greatest rows comparing ``columns`` in turn."""
    return df.orderBy(*[F.desc(c) for c in columns]).limit(n)
