"""Tyre-wear reports: pace lost between fresh and worn tyres by driving style."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlab.operators.driving import (
    CHANNELS,
    driving_stats,
    driving_stats_prototype,
    styles_by_event,
    styles_prototype,
)
from stintlab.operators.filters import valid_telemetry, worn_laps
from stintlab.operators.medians import upper_medians
from stintlab.operators.wear import compare_states, paced_laps, with_style
from stintlab.sources.cleaning import RACE
from stintlab.staging import settle

MIN_LAPS = 15
OUTPUT_ORDER = ["event", "style", "tyre_compound"]
_ROUNDED = ["optimal_median", "degraded_median", "pace_dropoff_s"]


def _rounded(report: DataFrame) -> DataFrame:
    return report.withColumns({c: F.round(c, 3) for c in _ROUNDED})


def driver_styles(telemetry: DataFrame, stage_inputs: bool = False) -> DataFrame:
    """Style per event and driver from cleaned telemetry of all sessions.

    The statistics are written before they are labelled: they and their baselines must be
    the same numbers, and sums of doubles may differ between two evaluations.
    """
    valid = valid_telemetry(telemetry).select("event", "driver", *CHANNELS)
    stats = settle(driving_stats(settle(valid) if stage_inputs else valid))
    return styles_by_event(stats)


def wear_report(
    telemetry: DataFrame,
    laps: DataFrame,
    stage_inputs: bool = False,
) -> DataFrame:
    """Median pace on fresh and on worn tyres per event, style and compound.

    ``telemetry`` and ``laps`` are cleaned. Groups need 15 laps in both states. Both inputs
    are read twice; ``stage_inputs`` writes the few columns needed once instead, which pays
    where reading is dear (CSV) or the styles are too many to broadcast; typed Parquet
    tables (see ``sources.typed``) are cheap to read twice.

    Runs jobs when called. Cut the inputs to the events wanted before, as a filter on the
    report does not get below what is written.
    """
    styles = settle(driver_styles(telemetry, stage_inputs))
    paced = paced_laps(worn_laps(laps), ["event", "driver"])
    styled = with_style(paced, styles, ["event", "driver"])
    if stage_inputs:
        styled = settle(styled)
    medians = upper_medians(styled, ["event", "style", "compound", "state"], "pace")
    report = compare_states(medians, ["event", "style", "compound"])
    enough = (F.col("optimal_count") >= MIN_LAPS) & (F.col("degraded_count") >= MIN_LAPS)
    return _rounded(report.filter(enough)).withColumnRenamed("compound", "tyre_compound")


def prototype_styles(telemetry: DataFrame) -> DataFrame:
    """Style per event, session and driver under the prototype's rules."""
    stats = settle(driving_stats_prototype(valid_telemetry(telemetry, race_only=False)))
    return styles_prototype(stats)


def prototype_medians(
    telemetry: DataFrame,
    laps: DataFrame,
    stage_inputs: bool = False,
) -> DataFrame:
    """Upper median, count and mean of pace per style, compound and tyre state."""
    keys = ["event", "session", "driver"]
    styles = settle(prototype_styles(telemetry))
    paced = paced_laps(
        worn_laps(laps, race_only=False).filter(F.col("session") == RACE),
        keys,
        warm_up=False,
        dry_only=False,
        add_fuel=True,
    )
    styled = with_style(paced, styles, keys)
    if stage_inputs:
        styled = settle(styled)
    return upper_medians(styled, ["style", "compound", "state"], "pace")


def wear_report_prototype(
    telemetry: DataFrame,
    laps: DataFrame,
    stage_inputs: bool = False,
) -> DataFrame:
    """The earlier, season-wide form of the report, per style and compound.

    It differs in its style rules (see ``styles_prototype``), keeps wet tyres and warm-up
    laps, adds the fuel correction instead of subtracting it and asks for no minimum of
    laps. A median of exactly 0 is shown as NULL. Ordered by style and compound. Figures
    are rounded half up in decimal, which differs from rounding the binary value where the
    fourth place is a 5.
    """
    medians = prototype_medians(telemetry, laps, stage_inputs)
    report = compare_states(medians, ["style", "compound"])
    shown = report.filter(F.col("pace_dropoff_s").isNotNull())
    blank_zero = {
        c: F.when(F.col(c) != 0, F.col(c)) for c in ["optimal_median", "degraded_median"]
    }
    return _rounded(shown.withColumns(blank_zero)).orderBy("style", "compound")
