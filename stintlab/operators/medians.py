"""Exact medians of groups too large for one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlab.staging import settle

# Size of a group's sketch: its ranks are right to within about 0.4 % of the group.
SKETCH_SIZE = 800
# A bracket reaches from the middle to the next of so many equal shares of the group, and one on.
STEPS = 100
# Values of one group that are sorted together.
MOST_GATHERED = 100_000


def _bracket(share: Column, steps: int) -> list[Column]:
    """Values somewhat below and above a share of what the column ``sketch`` has seen.

    Sketches take no NaN: where there is nothing else, every other value lies below.
    """
    shares = F.array(*[F.lit(i / steps) for i in range(steps + 1)])
    seen = F.call_function("kll_sketch_get_n_double", "sketch") > 0
    values = F.when(seen, F.call_function("kll_sketch_get_quantile_double", "sketch", shares))
    places = [
        F.greatest(F.lit(0), F.floor(share * steps).cast("int") - 1),
        F.least(F.lit(steps), F.ceil(share * steps).cast("int") + 1),
    ]
    return [F.coalesce(F.get(values, place), F.lit(math.nan)) for place in places]


def upper_medians(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    sketch_size: int = SKETCH_SIZE,
    steps: int = STEPS,
    most_gathered: int = MOST_GATHERED,
) -> DataFrame:
    """Upper median, count and mean of ``value`` per key.

    The upper median is element n/2 (from 0) of the sorted group: of an even number of
    values the upper of the middle two. Neither ``median`` (which interpolates) nor
    ``percentile_approx`` gives it, and ``percentile_disc`` holds a group's distinct
    values in one task. So it is bracketed:

    1. a quantile sketch per key, which combines before the shuffle, gives a value somewhat
       below the middle and one somewhat above;
    2. the rows below, at and between the two are counted exactly. If the middle row is at one
       of them, that is the median. If it lies outside, the bracket moves there; if too
       many rows lie between, a sketch of those gives a narrower one; and the count is
       repeated for these keys;
    3. the few values between are gathered and sorted.

    The result is exact for any options, which only set how often rows are counted: groups up to
    ``most_gathered * steps / 4`` rows mostly once. Every shuffle carries one row per key
    and task, but for the last one, which carries at most ``most_gathered`` values per key.
    """
    keys = list(keys)
    values = df.select(*keys, F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    sketch = F.call_function("kll_sketch_agg_double", F.col("v"), F.lit(sketch_size))
    grouped = values.groupBy(*keys).agg(
        F.count("*").alias("total"), F.avg("v").alias("mean"), sketch.alias("sketch")
    )
    low, high = _bracket(F.lit(0.5), steps)
    # The median is known to lie between least and most, these included.
    open_groups = settle(
        grouped.select(
            *keys, "total", "mean",
            F.floor(F.col("total") / 2).alias("middle"),
            F.lit(-math.inf).alias("least"), F.lit(math.nan).alias("most"),
            low.alias("low"), high.alias("high"),
        )
    )
    found: list[DataFrame] = []
    while True:
        counted = settle(_counted(values, open_groups, keys, sketch_size))
        below, low, inside, high = (F.col(c) for c in ("n_below", "n_low", "n_inside", "n_high"))
        middle = F.col("middle")
        between = (middle >= below + low) & (middle < below + low + inside)
        few = between & (inside <= most_gathered)
        at_low = (middle >= below) & (middle < below + low)
        at_high = (middle >= below + low + inside) & (middle < below + low + inside + high)
        known = counted.filter(at_low | at_high).select(
            *keys, F.when(at_low, F.col("low")).otherwise(F.col("high")).alias("median"),
            F.col("total").alias("count"), "mean",
        )
        gathered = values.join(
            counted.filter(few).withColumn("offset", middle - below - low), keys
        ).filter((F.col("v") > F.col("low")) & (F.col("v") < F.col("high")))
        found += [known, _by_sorting(gathered, keys)]
        rest = counted.filter(~(at_low | at_high | few))
        if rest.isEmpty():
            break
        share = F.try_divide(middle - below - low, inside)
        narrow = _bracket(share, steps)
        is_below = middle < below
        open_groups = settle(
            rest.select(
                *keys, "total", "mean", "middle",
                F.when(is_below, F.col("least")).when(between, F.col("low")).otherwise(F.col("high")).alias("least"),
                F.when(is_below, F.col("low")).when(between, F.col("high")).otherwise(F.col("most")).alias("most"),
                F.when(is_below, F.col("least")).when(between, narrow[0]).otherwise(F.col("high")).alias("low"),
                F.when(is_below, F.col("low")).when(between, narrow[1]).otherwise(F.col("most")).alias("high"),
            )
        )
    result = found[0]
    for more in found[1:]:
        result = result.unionAll(more)
    return result


def _counted(values: DataFrame, groups: DataFrame, keys: list[str], sketch_size: int) -> DataFrame:
    """The groups with their rows below, at and between the bracket's ends, and a sketch of
    those between."""
    v, low, high = F.col("v"), F.col("low"), F.col("high")
    inside = (v > low) & (v < high)
    counts = (
        values.join(groups.select(*keys, "low", "high"), keys)
        .groupBy(*keys)
        .agg(
            F.count_if(v < low).alias("n_below"),
            F.count_if(v == low).alias("n_low"),
            F.count_if(inside).alias("n_inside"),
            F.count_if((v == high) & (high > low)).alias("n_high"),
            F.call_function(
                "kll_sketch_agg_double", F.when(inside, v), F.lit(sketch_size)
            ).alias("sketch"),
        )
    )
    return groups.join(counts, keys)


def _by_sorting(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The value at ``offset`` of the few rows of each key."""
    grouped = rows.groupBy(*keys).agg(
        F.sort_array(F.collect_list("v")).alias("sorted"),
        F.any_value("offset").alias("offset"), F.any_value("total").alias("count"),
        F.any_value("mean").alias("mean"),
    )
    median = F.get("sorted", F.col("offset").cast("int"))
    return grouped.select(*keys, median.alias("median"), "count", "mean")
