"""Labelled, fuel-corrected laps and the comparison of fresh with worn tyres."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlab.functions.labels import DEGRADED, OPTIMAL, tyre_state, wear_state
from stintlab.functions.timing import fuel_corrected
from stintlab.operators.filters import representative_laps


def with_tyre_state(laps: DataFrame, warm_up: bool = True) -> DataFrame:
    state = tyre_state(F.col("compound"), F.col("lap"), F.col("tyre_age"), warm_up)
    return laps.withColumn("state", state)


def paced_laps(
    laps: DataFrame,
    keys: Sequence[str],
    warm_up: bool = True,
    dry_only: bool = True,
    add_fuel: bool = False,
) -> DataFrame:
    """Representative laps with tyre state and fuel-corrected pace. Needs no shuffle."""
    pace = fuel_corrected(F.col("lap_time"), F.col("lap"), F.col("total_laps"), add_fuel)
    state = wear_state(F.col("compound"), F.col("lap"), F.col("tyre_age"))
    return representative_laps(laps, warm_up, dry_only).select(
        *keys, "compound", state.alias("state"), pace.alias("pace")
    )


def with_style(laps: DataFrame, styles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Give each lap its driver's style; laps of drivers without telemetry vanish.

    ``styles`` has one row per driver. Written by ``settle`` its size is known, so Spark
    broadcasts it while it is small and leaves the laps where they are.
    """
    return laps.join(styles, list(keys))


def compare_states(medians: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: median and count of both tyre states, and the pace drop-off.

    A key without one of the states has a NULL median and count 0 for it.
    """

    def of(state: str, column: str):
        return F.max(F.when(F.col("state") == state, F.col(column)))

    sides = medians.groupBy(*keys).agg(
        of(OPTIMAL, "median").alias("optimal_median"),
        of(DEGRADED, "median").alias("degraded_median"),
        F.coalesce(of(OPTIMAL, "count"), F.lit(0)).cast("int").alias("optimal_count"),
        F.coalesce(of(DEGRADED, "count"), F.lit(0)).cast("int").alias("degraded_count"),
    )
    return sides.select(
        *keys,
        "optimal_median",
        "degraded_median",
        (F.col("degraded_median") - F.col("optimal_median")).alias("pace_dropoff_s"),
        "optimal_count",
        "degraded_count",
    )
