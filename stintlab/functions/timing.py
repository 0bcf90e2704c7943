"""Lap-time arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Kilograms of fuel at the start and seconds lost per kilogram.
FULL_TANK = 100
SECONDS_PER_KG = 0.03


def race_share(lap: Column, total_laps: Column) -> Column:
    """Lap over race length as doubles, with IEEE results for a zero race length."""
    lap, total = lap.cast("double"), total_laps.cast("double")
    at_zero = F.when(lap > 0, F.lit(float("inf"))).when(lap < 0, F.lit(float("-inf")))
    return F.when(total == 0, at_zero.otherwise(F.lit(float("nan")))).otherwise(
        F.try_divide(lap, total)
    )


def fuel_corrected(
    lap_time: Column, lap: Column, total_laps: Column, add: bool = False
) -> Column:
    """Lap time without the weight of the fuel still on board.

    ``add`` turns the correction round, as the earlier prototype of the report had it.
    """
    burden = (F.lit(FULL_TANK) * (F.lit(1) - race_share(lap, total_laps))) * F.lit(SECONDS_PER_KG)
    return lap_time + burden if add else lap_time - burden
