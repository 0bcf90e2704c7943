"""Labelling and timing rules, by hand-worked cases."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from stintlab.functions.labels import driving_style, exceeds, falls_below, pit_strategy, tyre_state
from stintlab.functions.text import key_part, path_segment
from stintlab.functions.timing import fuel_corrected


@pytest.mark.parametrize(
    ("compounds", "avg", "expected"),
    [
        (["SOFT", "HARD"], 11.9, "AGGRESSIVE"),
        (["SOFT", "HARD"], 12.0, "BALANCED"),
        (["HARD", "MEDIUM"], 18.0, "BALANCED"),
        (["HARD", "MEDIUM"], 18.5, "CONSERVATIVE"),
        (["MEDIUM", "HARD"], 18.5, "BALANCED"),
        (["SOFT", "SOFT"], 20.0, "CONSERVATIVE"),
        (["SOFT"], 11.0, "AGGRESSIVE"),
        (["HARD", "SOFT"], 19.0, "CONSERVATIVE"),
        ([], None, "BALANCED"),
    ],
)
def test_pit_strategy(spark, compounds, avg, expected):
    df = spark.createDataFrame([(compounds, avg)], "c array<string>, a double")
    assert df.select(pit_strategy(F.col("c"), F.col("a"))).first()[0] == expected


TYRE_CASES = [
    ("MEDIUM", 10, 2, "DROP", "OPTIMAL"),
    ("HARD", 10, -1, "DROP", "OPTIMAL"),
    ("MEDIUM", 10, 3, "OPTIMAL", "OPTIMAL"),
    ("SOFT", 10, 1, "DROP", "DROP"),
    ("SOFT", 10, 2, "OPTIMAL", "OPTIMAL"),
    ("SOFT", 15, 6, "OPTIMAL", "OPTIMAL"),
    ("SOFT", 15, 7, "DEGRADED", "DEGRADED"),
    ("SOFT", 16, 5, "OPTIMAL", "OPTIMAL"),
    ("SOFT", 16, 6, "DEGRADED", "DEGRADED"),
    ("MEDIUM", 15, 12, "OPTIMAL", "OPTIMAL"),
    ("MEDIUM", 20, 12, "OPTIMAL", "OPTIMAL"),
    ("MEDIUM", 20, 13, "DEGRADED", "DEGRADED"),
    ("HARD", 15, 16, "OPTIMAL", "OPTIMAL"),
    ("HARD", 15, 17, "DEGRADED", "DEGRADED"),
    ("HARD", 16, 18, "OPTIMAL", "OPTIMAL"),
    ("HARD", 30, 19, "DEGRADED", "DEGRADED"),
    ("INTERMEDIATE", 15, 7, "DEGRADED", "DEGRADED"),
    ("INTERMEDIATE", 16, 7, "OPTIMAL", "OPTIMAL"),
    ("WET", 15, 6, "OPTIMAL", "OPTIMAL"),
    ("WET", 16, 6, "DEGRADED", "DEGRADED"),
    ("HYPERSOFT", 16, 6, "OPTIMAL", "OPTIMAL"),
    ("HYPERSOFT", 16, 7, "DEGRADED", "DEGRADED"),
]


def test_tyre_state(spark):
    df = spark.createDataFrame([c[:3] for c in TYRE_CASES], "c string, lap int, age int")
    args = F.col("c"), F.col("lap"), F.col("age")
    got = df.select("*", tyre_state(*args), tyre_state(*args, warm_up=False)).collect()
    assert sorted(tuple(r) for r in got) == sorted(TYRE_CASES)


def test_driving_style_spelling(spark):
    got = spark.range(4).select("id", driving_style(F.col("id"))).collect()
    assert dict(got) == {0: "CONSERVATIVE", 1: "BALANCED", 2: "AGRESSIVE", 3: "AGRESSIVE"}


def test_nan_compares_false(spark):
    df = spark.createDataFrame([(float("nan"), 1.0)], "n double, x double")
    n, x = F.col("n"), F.col("x")
    got = df.select(exceeds(n, x), exceeds(x, n), falls_below(x, n), falls_below(n, x)).first()
    assert not any(got)


@pytest.mark.parametrize(
    ("time", "lap", "total", "season", "prototype"),
    [
        (90.0, 10, 50, 87.6, 92.4),
        (90.0, 50, 50, 90.0, 90.0),
        (90.0, 10, 0, math.inf, -math.inf),
        (90.0, -1, 0, -math.inf, math.inf),
    ],
)
def test_fuel_correction(spark, time, lap, total, season, prototype):
    df = spark.createDataFrame([(time, lap, total)], "t double, lap int, total int")
    args = F.col("t"), F.col("lap"), F.col("total")
    got = df.select(fuel_corrected(*args), fuel_corrected(*args, add=True)).first()
    assert tuple(got) == pytest.approx((season, prototype))


def test_fuel_correction_of_nothing_is_nan(spark):
    df = spark.createDataFrame([(90.0, 0, 0)], "t double, lap int, total int")
    assert math.isnan(df.select(fuel_corrected(*[F.col(c) for c in df.columns])).first()[0])


def test_key_parts_and_path_segments(spark):
    df = spark.createDataFrame(
        [("2025-X-Race", ["a", "Miami%20Grand%20Prix", "Race", "VER", "laptimes.json"])],
        "k string, p array<string>",
    )
    got = df.select(key_part("k", 2), key_part("k", 3), path_segment("p", -4), path_segment("p", -9))
    assert tuple(got.first()) == ("Race", None, "Miami Grand Prix", None)


def test_malformed_segment_is_null(spark):
    df = spark.createDataFrame([(["50%", "x"],)], "p array<string>")
    assert df.select(path_segment("p", -2)).first()[0] is None
