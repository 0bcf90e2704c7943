"""Driving statistics and styles."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from stintlab.operators.driving import (
    driving_stats,
    driving_stats_prototype,
    event_baselines,
    styles_by_event,
    styles_prototype,
    top_acceleration,
)
from stintlab.staging import settle
from tests.conftest import rows

SCHEMA = (
    "event string, session string, driver string, acc_y double, brake int, rpm double, "
    "speed double, throttle double"
)


def samples(spark, values, driver="A"):
    return spark.createDataFrame([("E", "Race", driver, *v) for v in values], SCHEMA)


def test_mean_of_five_largest(spark):
    df = samples(spark, [(float(a), 0, 1.0, 0.0, 0.0) for a in [1, 2, 3, 4, 5, 6]])
    assert driving_stats(df).first()["acc_y"] == 4.0
    df = samples(spark, [(-3.0, 0, 1.0, 0.0, 0.0), (-1.0, 0, 1.0, 0.0, 0.0)])
    assert driving_stats(df).first()["acc_y"] == -2.0


def test_equal_accelerations_all_count(spark):
    df = samples(spark, [(a, 0, 1.0, 0.0, 0.0) for a in [9.0, 9.0, 9.0, 1.0, 1.0, 1.0]])
    assert driving_stats(df).first()["acc_y"] == pytest.approx(29 / 5)


@pytest.mark.parametrize("speed, throttle", [(120.0, 99.0), (300.0, 35.0), (float("nan"), 99.0)])
def test_rpm_without_a_sample_at_speed(spark, speed, throttle):
    df = samples(spark, [(1.0, 1, 11000.0, speed, throttle), (1.0, 1, 9000.0, speed, throttle)])
    assert driving_stats(df).first()["rpm"] == 0.0
    assert driving_stats_prototype(df).first()["rpm"] == 2.0


def test_rpm_at_speed(spark):
    df = samples(
        spark, [(1.0, 1, 11000.0, 121.0, 36.0), (1.0, 0, 10000.0, 300.0, 99.0), (1.0, 0, 1.0, 50.0, 99.0)]
    )
    for stats in (driving_stats(df), driving_stats_prototype(df)):
        assert stats.first()["rpm"] == 10500.0
        assert stats.first()["brake"] == pytest.approx(1 / 3)


def test_prototype_acceleration_has_a_floor(spark):
    df = samples(spark, [(-50.0, 0, 1.0, 0.0, 0.0), (-40.0, 0, 1.0, 0.0, 0.0)])
    assert driving_stats_prototype(df).first()["acc_y"] == -30.0


def stats(spark, values):
    return spark.createDataFrame(
        [("E", "Race", *v) for v in values],
        "event string, session string, driver string, acc_y double, brake double, rpm double",
    )


def test_styles(spark):
    df = stats(spark, [("A", 4.0, 0.2, 11000.0), ("B", 2.0, 0.4, 10000.0)])
    assert rows(event_baselines(df).select("acc_y", "rpm")) == [(3.0, 10500.0)]
    got = dict(rows(styles_by_event(df).select("driver", "style")))
    assert got == {"A": "AGRESSIVE", "B": "CONSERVATIVE"}
    got = dict(rows(styles_prototype(df).select("driver", "style")))
    assert got == {"A": "AGRESSIVE", "B": "BALANCED"}


def test_lone_driver_is_conservative(spark):
    df = stats(spark, [("A", 4.1, 0.7, 11000.3)])
    assert styles_by_event(df).first()["style"] == "CONSERVATIVE"


def test_hot_driver_against_sorting(spark):
    """One driver has a third of all samples, spread over every partition."""
    rng = random.Random(11)
    keys = ["HOT"] * 2000 + [f"D{i % 50}" for i in range(4000)]
    data = [("E", "Race", k, rng.gauss(0, 10), rng.randrange(2), 1.0, 0.0, 0.0) for k in keys]
    df = settle(spark.createDataFrame(data, SCHEMA).repartition(8))
    by_key = {}
    for row in data:
        by_key.setdefault(row[2], []).append(row[3])
    expected = {k: sum(sorted(v)[-5:]) / 5 for k, v in by_key.items()}
    got = {r.driver: r.acc_y for r in top_acceleration(df).collect()}
    assert got == pytest.approx(expected)
    brakes = df.groupBy("driver").agg(F.avg("brake").alias("b"))
    assert rows(driving_stats(df).select("driver", "brake")) == rows(brakes)


@pytest.mark.parametrize("n", [1, 5, 40])
@pytest.mark.parametrize(
    "draw",
    [
        lambda rng: rng.gauss(0, 10),
        lambda rng: rng.uniform(3.0, 3.01),  # all in one bin
        lambda rng: rng.choice([2.0, 2.125, 7.5]),
        lambda rng: rng.choice([float("inf"), 1.0, -1e300, 1e300]),
    ],
    ids=["spread", "one bin", "few values", "extremes"],
)
def test_largest_by_sorting(spark, draw, n):
    rng = random.Random(12)
    data = [("E", "Race", rng.choice(["A", "A", "B", "C"]), draw(rng), 0, 1.0, 0.0, 0.0) for _ in range(800)]
    data += [("E", "Race", "D", 4.0, 0, 1.0, 0.0, 0.0), ("E", "Race", "none", None, 0, 1.0, 0.0, 0.0)]
    by_key = {}
    for row in data:
        if row[3] is not None:
            by_key.setdefault(row[2], []).append(row[3])
    expected = {}
    for k, v in by_key.items():
        largest = sorted(v)[-n:]
        expected[k] = sum(largest) / len(largest)
    df = settle(spark.createDataFrame(data, SCHEMA).repartition(8))
    got = {r.driver: r.acc_y for r in top_acceleration(df, n=n).collect()}
    assert got == pytest.approx(expected)
