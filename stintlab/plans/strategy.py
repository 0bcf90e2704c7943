"""Pit strategy report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlab.functions.labels import exceeds, pit_strategy
from stintlab.operators.filters import timed_race_laps
from stintlab.operators.ranking import race_positions
from stintlab.operators.stints import ratio, strategy_profile


def one_team_per_driver(drivers: DataFrame, order_by: str | None = None) -> DataFrame:
    """The driver table as (driver, team), one entry of repeated drivers.

    Files have no order, so it must be told which entry is the last: that with the greatest
    ``order_by``, or without it the greatest (team, number). Entries level in ``order_by``
    are told apart by team and number.
    """
    last = [F.col(order_by)] if order_by else []
    entries = drivers.select(
        F.col("driverName").alias("driver"),
        F.struct(*last, F.col("team"), F.col("driverNumber")).alias("entry"),
    )
    return entries.groupBy("driver").agg(F.max("entry")["team"].alias("team"))


def all_teams(drivers: DataFrame) -> DataFrame:
    """The driver table as (driver, team), one row per entry."""
    return drivers.select(F.col("driverName").alias("driver"), "team")


def classify_strategies(laps: DataFrame) -> DataFrame:
    """Strategy and total race time per event and driver, from cleaned laps."""
    profile = strategy_profile(timed_race_laps(laps))
    strategy = pit_strategy(F.col("compounds"), F.col("avg_stint_length"))
    classified = profile.select("event", "driver", strategy.alias("strategy"), "total_time")
    return classified.filter(exceeds(F.col("total_time"), 0))


def pit_strategy_report(
    laps: DataFrame,
    drivers: DataFrame,
    repeated_drivers: str = "merge",
    order_by: str | None = None,
) -> DataFrame:
    """Average position and race time per strategy, event and team.

    ``laps`` are cleaned stint laps, ``drivers`` the driver table. Drivers are ranked
    before the driver table is consulted, so one missing from it still holds a position.
    A driver listed more than once counts once (``"merge"``, the entry with the greatest
    ``order_by``) or once per entry (``"all"``).

    Runs jobs when called: the ranking is written. Cut ``laps`` to the events wanted
    before, as a filter on the report does not get below that.
    """
    ranked = race_positions(classify_strategies(laps))
    if repeated_drivers == "merge":
        teams = one_team_per_driver(drivers, order_by)
    else:
        teams = all_teams(drivers)
    return (
        ranked.join(teams, "driver")
        .groupBy("strategy", "event", "team")
        .agg(
            F.avg("position").alias("avgPosition"),
            ratio(F.sum("total_time"), F.count("*")).alias("avgTotalTime"),
        )
    )
