"""Labelling rules. The spellings of the labels are fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AGGRESSIVE_STRATEGY = "AGGRESSIVE"
AGGRESSIVE_STYLE = "AGRESSIVE"
BALANCED = "BALANCED"
CONSERVATIVE = "CONSERVATIVE"

OPTIMAL = "OPTIMAL"
DEGRADED = "DEGRADED"
DROP = "DROP"
WET_TYRES = ["INTERMEDIATE", "WET"]

# Laps a tyre stays in its best window, early in the race and later.
EARLY_LAPS = 15
EARLY_WINDOW = {"HARD": 16, "MEDIUM": 12}
LATE_WINDOW = {"SOFT": 5, "MEDIUM": 12, "HARD": 18, "INTERMEDIATE": 7, "WET": 5}
OTHER_WINDOW = 6


def exceeds(value: Column, limit: Column | float) -> Column:
    """``value > limit`` where NaN exceeds nothing (Spark sorts NaN above everything)."""
    return (value > limit) & ~F.isnan(value.cast("double"))


def falls_below(value: Column, limit: Column) -> Column:
    """``value < limit`` where nothing falls below NaN."""
    return (value < limit) & ~F.isnan(limit.cast("double"))


def pit_strategy(compounds: Column, avg_stint_length: Column) -> Column:
    """Strategy from the compounds in stint order and the mean stint length.

    A NULL mean (no stint at all) meets neither length condition.
    """
    one_compound = F.size(F.array_distinct(compounds)) == 1
    long_hard_start = (F.get(compounds, F.lit(0)) == "HARD") & (avg_stint_length > 18)
    return (
        F.when(F.array_contains(compounds, "SOFT") & (avg_stint_length < 12), AGGRESSIVE_STRATEGY)
        .when(long_hard_start | one_compound, CONSERVATIVE)
        .otherwise(BALANCED)
    )


def driving_style(score: Column) -> Column:
    """Style from how many of the three driving statistics point to attacking."""
    return (
        F.when(score >= 2, AGGRESSIVE_STYLE).when(score == 1, BALANCED).otherwise(CONSERVATIVE)
    )


def _table(limits: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(v) for pair in limits.items() for v in pair])


def unusable(compound: Column, age: Column, warm_up: bool = True) -> Column:
    """Laps that say nothing about tyre wear.

    These are out-laps (age 1) and, with ``warm_up``, every lap up to age 2 on the
    slower-warming hard and medium tyres.
    """
    out_lap = age == 1
    return out_lap | ((age <= 2) & compound.isin("HARD", "MEDIUM")) if warm_up else out_lap


def wear_state(compound: Column, lap: Column, age: Column) -> Column:
    """OPTIMAL while the tyre is within its best window, DEGRADED after it."""
    # One lookup in a constant table keeps the generated code small: a filter is pushed
    # below the columns it is made of, which repeats them at every mention.
    table = F.when(lap <= EARLY_LAPS, _table(EARLY_WINDOW)).otherwise(_table(LATE_WINDOW))
    limit = F.coalesce(F.try_element_at(table, compound), F.lit(OTHER_WINDOW))
    return F.when(age <= limit, OPTIMAL).otherwise(DEGRADED)


def tyre_state(compound: Column, lap: Column, age: Column, warm_up: bool = True) -> Column:
    """DROP, OPTIMAL or DEGRADED for one lap."""
    return F.when(unusable(compound, age, warm_up), DROP).otherwise(
        wear_state(compound, lap, age)
    )
