"""Text tables to typed rows."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from stintlab import schemas
from stintlab.functions import text
from stintlab.functions.text import number
from stintlab.operators.filters import timed_race_laps, valid_telemetry, worn_laps
from stintlab.sources.cleaning import (
    clean_results,
    clean_stint_laps,
    clean_telemetry,
    clean_wear_laps,
)

LAP = {
    "event": "E1", "sessionType": "Race", "totalLaps": "50", "driverCode": "VER", "lap": "7",
    "lapTime": "91.5", "pitOut": "None", "tyreCompound": "SOFT", "tyreAgeLaps": "3",
    "stintNumber": "1",
}
TELEMETRY = [*schemas.TELEMETRY_KEYS, *schemas.TELEMETRY_CHANNELS]
SAMPLE = {
    "event": "E1", "sessionType": "Race", "driverName": "VER", "acc_y": "1.5", "brake": "1",
    "rpm": "11000", "speed": "200", "throttle": "99", "rel_distance": "0.5",
}


def one(spark, columns, base, **changes):
    values = {**base, **changes}
    return spark.createDataFrame(
        [tuple(values.get(c) for c in columns)], schemas.text_table(columns)
    )


@pytest.mark.parametrize(
    ("changes", "column", "expected"),
    [
        ({"lapTime": "None"}, "lap_time", 0.0),
        ({"lapTime": None}, "lap_time", 0.0),
        ({"lapTime": " "}, "lap_time", 0.0),
        ({"lapTime": " 91.5 "}, "lap_time", 91.5),
        ({"stintNumber": ""}, "stint", 0),
        ({"stintNumber": None}, "stint", 0),
        ({"tyreCompound": "None"}, "compound", ""),
        ({"tyreCompound": None}, "compound", ""),
        ({"tyreCompound": "\tHARD "}, "compound", "HARD"),
        ({"tyreCompound": "NoneSuch"}, "compound", "NoneSuch"),
        ({"event": " E1 "}, "event", "E1"),
        ({"driverCode": None}, "driver", ""),
    ],
)
def test_stint_lap_values(spark, changes, column, expected):
    got = clean_stint_laps(one(spark, schemas.LAP_COLUMNS, LAP, **changes))
    assert got.first()[column] == expected


@pytest.mark.parametrize(
    "changes",
    [{"stintNumber": "None"}, {"lap": ""}, {"lap": None}, {"lap": "1.5"}, {"totalLaps": "x"},
     {"lapTime": "fast"}],
)
def test_unreadable_stint_laps_are_dropped(spark, changes):
    assert clean_stint_laps(one(spark, schemas.LAP_COLUMNS, LAP, **changes)).count() == 0


def test_each_report_judges_its_own_columns(spark):
    bad_stint = one(spark, schemas.LAP_COLUMNS, LAP, stintNumber="None")
    bad_age = one(spark, schemas.LAP_COLUMNS, LAP, tyreAgeLaps="None")
    assert (clean_stint_laps(bad_stint).count(), clean_wear_laps(bad_stint).count()) == (0, 1)
    assert (clean_stint_laps(bad_age).count(), clean_wear_laps(bad_age).count()) == (1, 0)


@pytest.mark.parametrize(
    ("changes", "timed", "worn"),
    [
        ({}, 1, 1),
        ({"lapTime": "NaN"}, 0, 1),
        ({"lapTime": "-1"}, 0, 1),
        ({"lapTime": "None"}, 0, 0),
        ({"tyreCompound": ""}, 0, 0),
        ({"tyreAgeLaps": ""}, 1, 0),
        ({"tyreAgeLaps": "-2"}, 1, 1),
        ({"sessionType": "Sprint"}, 0, 0),
    ],
)
def test_lap_filters(spark, changes, timed, worn):
    table = one(spark, schemas.LAP_COLUMNS, LAP, **changes)
    assert timed_race_laps(clean_stint_laps(table)).count() == timed
    assert worn_laps(clean_wear_laps(table)).count() == worn


def test_all_sessions_filter(spark):
    practice = clean_wear_laps(one(spark, schemas.LAP_COLUMNS, LAP, sessionType="Practice 1"))
    assert worn_laps(practice, race_only=False).count() == 1
    sample = clean_telemetry(
        one(spark, TELEMETRY, SAMPLE, sessionType="Practice 1")
    )
    assert valid_telemetry(sample).count() == 0
    assert valid_telemetry(sample, race_only=False).count() == 1


@pytest.mark.parametrize(
    ("changes", "kept", "valid"),
    [
        ({}, 1, 1),
        ({"brake": "1.0"}, 0, 0),
        ({"rpm": "None"}, 0, 0),
        ({"speed": None}, 0, 0),
        ({"acc_y": "NaN"}, 1, 1),
        ({"rel_distance": "None"}, 1, 0),
        ({"rel_distance": None}, 1, 1),
    ],
)
def test_telemetry(spark, changes, kept, valid):
    got = clean_telemetry(one(spark, TELEMETRY, SAMPLE, **changes))
    assert got.count() == kept
    assert valid_telemetry(got).count() == valid


def test_nan_sample_keeps_its_value(spark):
    got = clean_telemetry(one(spark, TELEMETRY, SAMPLE, acc_y="NaN"))
    assert math.isnan(got.first()["acc_y"])


def test_results(spark):
    base = {"event": "E1", "driverCode": "VER", "finalPosition": "1", "totalTime": "5400.25"}
    got = clean_results(one(spark, schemas.RESULT_COLUMNS, base)).first()
    assert tuple(got) == ("E1", "Race", "VER", 1, 5400.25)
    retired = one(spark, schemas.RESULT_COLUMNS, base, finalPosition="R")
    assert clean_results(retired).count() == 0


ODD_NUMBERS = [
    "1", "+1", "-1", " 7 ", "\t7\n", "\x007\x1f", "7\x7f", "7\u00a0", "\u20037", "1.5", "1.", ".5", ".", "", " ", "+", "-", "--1",
    "1e3", "1E-3", "1d", "1f", "2147483647", "2147483648", "-2147483648", "99999999999999999999", "0x10", "0x1p3", "0xAp1",
    "NaN", "nan", "-NaN", "Infinity", "-infinity", "inf", "+INF", " nan ", "None", "none", "n/a", "x", "fast", "1 2", "1,5",
    "\u0661", "1\n", "\u00851", "1\u2028", "1L", "007", "1_000", "true", None,
]


@pytest.mark.parametrize("kind", ["int", "double"])
def test_numbers_are_what_casts_make_of_them(spark, kind):
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(ODD_NUMBERS)], "i int, t string")
    plain = F.col("t").try_cast(kind)
    got = texts.select("i", "t", number("t", kind).alias("got"), plain.alias("plain"))
    assert [tuple(r) for r in got.filter("NOT (got <=> plain)").collect()] == []
    assert got.filter("got IS NOT NULL").count() >= 9


@pytest.mark.parametrize("kind, texts", [("int", ["n/a", "1.5", "None", ""]), ("double", ["fast", "x", "None", ""])])
def test_texts_that_are_no_numbers_are_not_cast(spark, kind, texts):
    held = spark.createDataFrame([(t,) for t in texts], "t string")
    plan = held.select(number("t", kind).alias("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan.upper()
    assert held.filter(F.col("t").rlike(text._NUMBER_LIKE[kind])).count() == 0
