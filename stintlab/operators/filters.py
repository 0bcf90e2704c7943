"""Row predicates of the reports, pushed to the scan where the source allows it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlab.functions.labels import WET_TYRES, exceeds, unusable
from stintlab.functions.text import MISSING
from stintlab.sources.cleaning import RACE

WARM_UP_LAPS = 3


def timed_race_laps(laps: DataFrame) -> DataFrame:
    """Race laps with a positive time and a known compound."""
    return laps.filter(
        (F.col("session") == RACE) & exceeds(F.col("lap_time"), 0) & (F.col("compound") != "")
    )


def worn_laps(laps: DataFrame, race_only: bool = True) -> DataFrame:
    """Laps with a time, a compound and a tyre age. Negative values pass."""
    known = (F.col("lap_time") != 0) & (F.col("compound") != "") & (F.col("tyre_age") != 0)
    return laps.filter(known & (F.col("session") == RACE) if race_only else known)


def valid_telemetry(telemetry: DataFrame, race_only: bool = True) -> DataFrame:
    """Samples with a relative distance; without one the other channels are unusable."""
    located = F.col("rel_distance") != MISSING
    return telemetry.filter(located & (F.col("session") == RACE) if race_only else located)


def representative_laps(
    laps: DataFrame, warm_up: bool = True, dry_only: bool = True
) -> DataFrame:
    """Laps that count towards the pace comparison."""
    counts = (
        ~unusable(F.col("compound"), F.col("tyre_age"), warm_up)
        & (F.col("pit_out") == MISSING)
        & (F.col("lap") > WARM_UP_LAPS)
    )
    return laps.filter(counts & ~F.col("compound").isin(WET_TYRES) if dry_only else counts)
