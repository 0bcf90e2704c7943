"""The reports against hand-worked cases and against the long way round in plain Python."""

from __future__ import annotations

import random
from fractions import Fraction

import pytest

from stintlab.operators.filters import timed_race_laps
from stintlab.operators.stints import race_totals, stint_summary, strategy_profile
from stintlab.plans.strategy import pit_strategy_report
from stintlab.plans.wear import wear_report, wear_report_prototype
from tests.conftest import rows

STINT_LAPS = (
    "event string, session string, driver string, stint int, compound string, lap int, "
    "lap_time double, total_laps int"
)
DRIVERS = "driverName string, team string, driverNumber string, firstName string, lastName string"


@pytest.mark.parametrize("offset", [0.0, 1e6, 1e9])
def test_variance_keeps_its_digits(spark, offset):
    """Large, close lap times in stints with means of their own."""
    draw = random.Random(9)
    times = {d: [(s, offset + 2 * s + draw.randrange(80) / 8) for s in (1, 2, 3) for _ in range(40)] for d in "AB"}
    laps = spark.createDataFrame(
        [("E1", "Race", d, s, "SOFT", i, t, 120) for d, listed in times.items() for i, (s, t) in enumerate(listed)],
        STINT_LAPS,
    ).repartition(6)
    got = {r.driver: r.lap_variance for r in strategy_profile(laps).collect()}
    for driver, listed in times.items():
        exact = [Fraction(t) for _, t in listed]
        mean = sum(exact) / len(exact)
        variance = float(sum((t - mean) ** 2 for t in exact) / len(exact))
        assert got[driver] == pytest.approx(variance, rel=1e-9)


def test_endless_lap_times_break_nothing(spark):
    laps = stint_laps(spark, [("AAA", 1, "SOFT", 1, float("inf")), ("AAA", 1, "SOFT", 2, 90.0), ("BBB", 1, "HARD", 1, 90.0)])
    got = {r.driver: (r.total_time, r.lap_variance) for r in strategy_profile(laps).collect()}
    assert got["BBB"] == (90.0, 0.0)
    assert got["AAA"][0] == float("inf") and got["AAA"][1] != got["AAA"][1]


def stint_laps(spark, values):
    return spark.createDataFrame([("E1", "Race", *v, 3) for v in values], STINT_LAPS)


def drivers(spark, teams):
    return spark.createDataFrame([(d, t, "1", "x", "y") for d, t in teams], DRIVERS)


GOLDEN = [
    ("AAA", 1, "SOFT", 1, 90.0), ("AAA", 1, "SOFT", 2, 91.0), ("AAA", 2, "HARD", 3, 92.0),
    ("BBB", 1, "HARD", 1, 95.0), ("BBB", 1, "HARD", 2, 95.0), ("BBB", 1, "HARD", 3, 95.0),
    ("CCC", 1, "MEDIUM", 1, 89.0),
    ("DDD", 0, "MEDIUM", 1, 100.0), ("DDD", 0, "MEDIUM", 2, 100.0),
]
TEAMS = [("AAA", "T1"), ("BBB", "T1"), ("DDD", "T2")]


def test_pit_strategy_report(spark):
    got = pit_strategy_report(stint_laps(spark, GOLDEN), drivers(spark, TEAMS))
    assert got.columns == ["strategy", "event", "team", "avgPosition", "avgTotalTime"]
    assert rows(got) == [
        ("AGGRESSIVE", "E1", "T1", 3.0, 273.0),
        ("BALANCED", "E1", "T2", 2.0, 200.0),
        ("CONSERVATIVE", "E1", "T1", 4.0, 285.0),
    ]


def test_repeated_drivers(spark):
    laps, twice = stint_laps(spark, GOLDEN), drivers(spark, [*TEAMS, ("DDD", "T1")])
    merged = {r.team: r.avgPosition for r in pit_strategy_report(laps, twice).collect()
              if r.strategy == "BALANCED"}
    assert merged == {"T2": 2.0}
    every = {r.team: r.avgPosition for r in
             pit_strategy_report(laps, twice, repeated_drivers="all").collect()
             if r.strategy == "BALANCED"}
    assert every == {"T1": 2.0, "T2": 2.0}


def test_repeated_drivers_by_a_given_order(spark):
    listed = drivers(spark, [*TEAMS, ("DDD", "T1"), ("AAA", "T0")])
    dated = listed.selectExpr("*", "CASE team WHEN 'T1' THEN 2 WHEN 'T0' THEN 3 ELSE 1 END AS entered")
    report = pit_strategy_report(stint_laps(spark, GOLDEN), dated, order_by="entered")
    assert {r.strategy: r.team for r in report.collect()} == {
        "AGGRESSIVE": "T0", "BALANCED": "T1", "CONSERVATIVE": "T1",
    }


def test_profile_and_stints(spark):
    laps = stint_laps(spark, GOLDEN + [("AAA", 2, "SOFT", 9, 93.0)])
    got = {r.driver: r for r in strategy_profile(laps).collect()}
    assert (got["AAA"].num_stints, got["AAA"].compounds) == (2, ["SOFT", "HARD"])
    assert got["AAA"].avg_stint_length == 2.0
    assert got["AAA"].avg_lap == 91.5
    assert got["AAA"].lap_variance == pytest.approx(1.25)
    assert (got["DDD"].num_stints, got["DDD"].avg_stint_length) == (0, None)
    assert got["DDD"].compounds == []
    assert rows(stint_summary(laps).filter("driver = 'AAA'").drop("event", "driver")) == [
        (1, "SOFT", 2), (2, "HARD", 2),
    ]
    totals = {r.driver: (r.total_time, r.last_lap) for r in race_totals(laps).collect()}
    assert totals["AAA"] == (366.0, 9)


def test_pit_strategy_the_long_way(spark):
    """Random laps, one driver with a third of them, against dictionaries."""
    rng = random.Random(21)
    values = []
    for i in range(3000):
        driver = "HOT" if i % 3 == 0 else f"D{rng.randrange(30)}"
        values.append((f"E{rng.randrange(3)}", rng.choice(["Race", "Race", "Sprint"]), driver,
                       rng.randrange(6), rng.choice(["SOFT", "MEDIUM", "HARD", ""]), i,
                       rng.choice([0.0, rng.randrange(60, 120) / 1.0]), 50))
    teams = [(f"D{i}", f"T{i % 4}") for i in range(28)] + [("HOT", "T0")]
    by_driver = {}
    for event, session, driver, stint, compound, lap, time, _ in values:
        if session == "Race" and time > 0 and compound:
            by_driver.setdefault((event, driver), []).append((lap, stint, compound, time))
    labels, totals = {}, {}
    for key, laps in by_driver.items():
        stints = {}
        for _lap, stint, compound, _time in sorted(laps):
            if stint > 0:
                stints.setdefault(stint, []).append(compound)
        sequence = [stints[s][0] for s in sorted(stints)]
        mean = sum(map(len, stints.values())) / len(stints) if stints else None
        totals[key] = sum(lap[3] for lap in laps)
        if "SOFT" in sequence and mean < 12:
            labels[key] = "AGGRESSIVE"
        elif sequence[:1] == ["HARD"] and mean > 18 or len(set(sequence)) == 1:
            labels[key] = "CONSERVATIVE"
        else:
            labels[key] = "BALANCED"
    team, groups = dict(teams), {}
    for event in {k[0] for k in totals}:
        order = sorted((t, d) for (e, d), t in totals.items() if e == event)
        for position, (time, driver) in enumerate(order, 1):
            if driver in team:
                group = (labels[event, driver], event, team[driver])
                groups.setdefault(group, []).append((position, time))
    expected = [(*g, sum(p for p, _ in v) / len(v), sum(t for _, t in v) / len(v))
                for g, v in groups.items()]
    got = pit_strategy_report(spark.createDataFrame(values, STINT_LAPS), drivers(spark, teams))
    assert rows(got) == sorted(expected)
    assert timed_race_laps(spark.createDataFrame(values, STINT_LAPS)).count() == sum(
        map(len, by_driver.values())
    )


TELEMETRY = (
    "event string, session string, driver string, acc_y double, brake int, rpm double, "
    "speed double, throttle double, rel_distance string"
)
WEAR_LAPS = (
    "event string, session string, driver string, lap_time double, compound string, "
    "tyre_age int, lap int, total_laps int, pit_out string"
)
LIMITS = {
    True: {"HARD": 16, "MEDIUM": 12},
    False: {"SOFT": 5, "MEDIUM": 12, "HARD": 18, "INTERMEDIATE": 7, "WET": 5},
}


def season(seed=31, laps=6000):
    rng = random.Random(seed)
    names = ["HOT"] * 10 + [f"D{i}" for i in range(20)]
    telemetry, wear = [], []
    for _ in range(4000):
        telemetry.append((f"E{rng.randrange(2)}", rng.choice(["Race", "Race", "Sprint"]),
                          rng.choice(names), float(rng.randrange(-40, 50)), rng.randrange(2),
                          float(rng.randrange(9000, 12000)), float(rng.randrange(300)),
                          float(rng.randrange(100)), rng.choice(["0.5", "0.5", "None"])))
    for _ in range(laps):
        wear.append((f"E{rng.randrange(3)}", rng.choice(["Race", "Race", "Sprint"]),
                     rng.choice(names), rng.choice([0.0, *[rng.randrange(80000, 99000) / 1000] * 9]),
                     rng.choice(["SOFT", "MEDIUM", "HARD", "HARD", "WET", "INTERMEDIATE", ""]),
                     rng.randrange(0, 26), rng.randrange(1, 51), 50,
                     rng.choice(["None", "None", "None", "None", "True", ""])))
    return telemetry, wear


def mean(values):
    return sum(values) / len(values)


def label(score):
    return ["CONSERVATIVE", "BALANCED", "AGRESSIVE", "AGRESSIVE"][score]


def grouped(pairs):
    out = {}
    for key, value in pairs:
        out.setdefault(key, []).append(value)
    return out


def state_of(compound, lap, age, warm_up):
    if age == 1 or (warm_up and age <= 2 and compound in ("HARD", "MEDIUM")):
        return None
    return "OPTIMAL" if age <= LIMITS[lap <= 15].get(compound, 6) else "DEGRADED"


def rpm_at_speed(samples):
    return [s[5] for s in samples if s[6] > 120 and s[7] > 35]


def test_wear_report_the_long_way(spark):
    telemetry, wear = season(laps=16000)
    valid = [s for s in telemetry if s[8] != "None" and s[1] == "Race"]
    stats = {}
    for key, samples in grouped(((s[0], s[2]), s) for s in valid).items():
        fast = rpm_at_speed(samples)
        stats[key] = (mean(sorted(s[3] for s in samples)[-5:]), mean([s[4] for s in samples]),
                      mean(fast) if fast else 0.0)
    styles = {}
    for (event, driver), (acc, brake, rpm) in stats.items():
        of_event = [v for (e, _), v in stats.items() if e == event]
        base = [mean([v[i] for v in of_event]) for i in range(3)]
        styles[event, driver] = label((acc > base[0]) + (brake < base[1]) + (rpm > base[2]))
    paces = []
    for event, session, driver, time, compound, age, lap, total, pit_out in wear:
        state = state_of(compound, lap, age, True)
        if (session == "Race" and time != 0 and compound not in ("", "WET", "INTERMEDIATE")
                and age != 0 and state and pit_out == "None" and lap > 3
                and (event, driver) in styles):
            pace = time - (100 * (1 - lap / total)) * 0.03
            paces.append(((event, styles[event, driver], compound, state), pace))
    median = {k: (sorted(v)[len(v) // 2], len(v)) for k, v in grouped(paces).items()}
    expected = []
    for event, style, compound in {k[:3] for k in median}:
        opt = median.get((event, style, compound, "OPTIMAL"), (0, 0))
        deg = median.get((event, style, compound, "DEGRADED"), (0, 0))
        if opt[1] >= 15 and deg[1] >= 15:
            expected.append((event, style, compound, round(opt[0], 3), round(deg[0], 3),
                             round(deg[0] - opt[0], 3), opt[1], deg[1]))
    for stage_inputs in (False, True):
        got = wear_report(spark.createDataFrame(telemetry, TELEMETRY),
                          spark.createDataFrame(wear, WEAR_LAPS), stage_inputs=stage_inputs)
        assert got.columns == ["event", "style", "tyre_compound", "optimal_median",
                               "degraded_median", "pace_dropoff_s", "optimal_count",
                               "degraded_count"]
        assert len(expected) > 6
        for a, b in zip(rows(got), sorted(expected), strict=True):
            assert a[:3] == b[:3] and a[6:] == b[6:] and a[3:6] == pytest.approx(b[3:6], abs=1e-3)


def test_prototype_the_long_way(spark):
    telemetry, wear = season(41, 4000)
    valid = [s for s in telemetry if s[8] != "None"]
    stats = {}
    for key, samples in grouped((s[:3], s) for s in valid).items():
        fast, brakes = rpm_at_speed(samples), [s[4] for s in samples]
        stats[key] = (max(-30.0, *[s[3] for s in samples]), mean(brakes),
                      mean(fast) if fast else float(sum(brakes)))
    base = [mean([v[i] for v in stats.values()]) for i in range(3)]
    styles = {k: label(sum(v[i] > base[i] for i in range(3))) for k, v in stats.items()}
    paces = []
    for event, session, driver, time, compound, age, lap, total, pit_out in wear:
        state = state_of(compound, lap, age, False)
        if (time != 0 and compound and age != 0 and state and session == "Race"
                and pit_out == "None" and lap > 3 and (event, session, driver) in styles):
            pace = time + (100 * (1 - lap / total)) * 0.03
            paces.append(((styles[event, session, driver], compound, state), pace))
    median = {k: (sorted(v)[len(v) // 2], len(v)) for k, v in grouped(paces).items()}
    expected = []
    for style, compound in sorted({k[:2] for k in median}):
        opt, deg = median.get((style, compound, "OPTIMAL")), median.get((style, compound, "DEGRADED"))
        if opt and deg:
            expected.append((style, compound, opt[0], deg[0], deg[0] - opt[0], opt[1], deg[1]))
    got = wear_report_prototype(spark.createDataFrame(telemetry, TELEMETRY),
                                spark.createDataFrame(wear, WEAR_LAPS))
    for a, b in zip([tuple(r) for r in got.collect()], expected, strict=True):
        assert a[:2] == b[:2] and a[5:] == b[5:] and a[2:5] == pytest.approx(b[2:5], abs=6e-4)


def test_same_report_without_broadcasts(spark, setting):
    telemetry, wear = season(51, 3000)
    args = spark.createDataFrame(telemetry, TELEMETRY), spark.createDataFrame(wear, WEAR_LAPS)
    expected = rows(wear_report(*args))
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    assert rows(wear_report(*args)) == expected
