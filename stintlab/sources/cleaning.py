"""Text tables to typed rows. A row with an unreadable number is dropped.

The two reports need different columns, and a row is only judged by the columns its
report uses, hence two lap cleaners. Rows are kept however many trailing columns are
empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlab.functions.text import label, number, number_or_zero, tidy

RACE = "Race"


def _readable(*names: str) -> Column:
    # Not dropna(): that would discard NaN too, which is for the filters to judge.
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).isNotNull()
    return condition


# The columns of each kind of row, and those of them that must be readable numbers.
STINT_COLUMNS = ["event", "session", "driver", "lap_time", "stint", "lap", "total_laps", "compound"]
STINT_NUMBERS = ["lap_time", "stint", "lap", "total_laps"]
WEAR_COLUMNS = [
    "event", "session", "driver", "lap_time", "compound", "tyre_age", "lap", "total_laps", "pit_out",
]
WEAR_NUMBERS = ["lap_time", "tyre_age", "lap", "total_laps"]
TELEMETRY_NUMBERS = ["acc_y", "brake", "rpm", "speed", "throttle"]


def _lap_values() -> dict[str, Column]:
    return {
        "event": tidy("event"),
        "session": tidy("sessionType"),
        "driver": tidy("driverCode"),
        "lap_time": number_or_zero("lapTime", "double", none_is_zero=True),
        "stint": number_or_zero("stintNumber", "int"),
        "lap": number("lap", "int"),
        "total_laps": number("totalLaps", "int"),
        "compound": label("tyreCompound"),
        "tyre_age": number_or_zero("tyreAgeLaps", "int"),
        "pit_out": tidy("pitOut"),
    }


def typed_laps(laps: DataFrame) -> DataFrame:
    """Every lap of a text table with typed values for either report; unreadable ones are NULL."""
    return laps.select(*[value.alias(name) for name, value in _lap_values().items()])


def typed_telemetry(telemetry: DataFrame) -> DataFrame:
    """Every sample of a text table with typed values; unreadable ones are NULL."""
    return telemetry.select(
        tidy("event").alias("event"),
        tidy("sessionType").alias("session"),
        tidy("driverName").alias("driver"),
        number("acc_y", "double").alias("acc_y"),
        number("brake", "int").alias("brake"),
        number("rpm", "double").alias("rpm"),
        number("speed", "double").alias("speed"),
        number("throttle", "double").alias("throttle"),
        tidy("rel_distance").alias("rel_distance"),
    )


def stint_laps_of(typed: DataFrame) -> DataFrame:
    """The typed laps that the strategy report can read."""
    return typed.select(*STINT_COLUMNS).filter(_readable(*STINT_NUMBERS))


def wear_laps_of(typed: DataFrame) -> DataFrame:
    """The typed laps that the tyre-wear reports can read."""
    return typed.select(*WEAR_COLUMNS).filter(_readable(*WEAR_NUMBERS))


def telemetry_of(typed: DataFrame) -> DataFrame:
    """The typed samples that the style rules can read."""
    return typed.filter(_readable(*TELEMETRY_NUMBERS))


def clean_stint_laps(laps: DataFrame) -> DataFrame:
    """Laps for the strategy report."""
    values = _lap_values()
    return stint_laps_of(laps.select(*[values[c].alias(c) for c in STINT_COLUMNS]))


def clean_wear_laps(laps: DataFrame) -> DataFrame:
    """Laps for the tyre-wear reports."""
    values = _lap_values()
    return wear_laps_of(laps.select(*[values[c].alias(c) for c in WEAR_COLUMNS]))


def clean_telemetry(telemetry: DataFrame) -> DataFrame:
    """Telemetry samples with the channels the style rules use."""
    return telemetry_of(typed_telemetry(telemetry))


def clean_results(results: DataFrame) -> DataFrame:
    """Official race results; their session is always the race."""
    rows = results.select(
        tidy("event").alias("event"),
        F.lit(RACE).alias("session"),
        tidy("driverCode").alias("driver"),
        number("finalPosition", "int").alias("final_position"),
        number("totalTime", "double").alias("total_time"),
    )
    return rows.filter(_readable("final_position", "total_time"))
