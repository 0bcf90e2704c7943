"""The physical plans: shuffles, pushdown and no Python workers."""

from __future__ import annotations

import re

import pytest

from stintlab.checks import proxies
from stintlab.checks.queries import QUERIES
from stintlab import schemas
from stintlab.operators import driving, medians
from stintlab.operators.driving import driving_stats
from stintlab.operators.medians import upper_medians
from stintlab.operators.reshape import lap_rows
from stintlab.operators.wear import paced_laps, with_style
from stintlab.operators.filters import timed_race_laps, valid_telemetry, worn_laps
from stintlab.operators.stints import race_totals
from stintlab.plans.strategy import classify_strategies, pit_strategy_report
from stintlab.plans.wear import driver_styles
from stintlab.sources.cleaning import (
    stint_laps_of,
    telemetry_of,
    typed_laps,
    typed_telemetry,
    wear_laps_of,
)
from stintlab.sources.typed import read_typed_laps, read_typed_telemetry, write_typed
from stintlab.staging import settle

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    """The plan after it ran, which is when exchanges are reused and joins settled."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def shuffles(text: str) -> int:
    return len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange (?:hash|range|Single|round)", text, re.I))


def test_shipped_strategy_report(spark):
    """The report's last plan reads the written ranking and joins its parts and the teams."""
    report = pit_strategy_report(proxies.stint_laps(spark, SF), proxies.drivers(spark, SF))
    text = plan(report)
    assert shuffles(text) <= 6
    for window in re.findall(r"Window \[.*", text):
        assert "_part" in window


def test_medians_shuffle_partial_results(spark, monkeypatch):
    """Three shuffles in all, of one row per key and task or of the few values gathered; no
    window and no sort of a group's rows."""
    laps = paced_laps(worn_laps(proxies.wear_laps(spark, SF)), ["event"])
    texts = []

    def noted(df):
        texts.append(plan(df))
        return settle(df)

    monkeypatch.setattr(medians, "settle", noted)
    texts.append(plan(upper_medians(laps, ["event", "compound", "state"], "pace")))
    assert len(texts) == 3
    assert sum(map(shuffles, texts)) <= 4
    for text in texts:
        assert "Window" not in text and "SortMergeJoin" not in text


def test_first_shuffle_carries_partial_sums(spark):
    text = plan(classify_strategies(proxies.stint_laps(spark, SF)))
    assert shuffles(text) == 2
    assert text.rindex("partial_sum") > text.rindex("Exchange hashpartitioning")


def test_samples_are_neither_sorted_nor_shuffled(spark, monkeypatch):
    """What reads the telemetry counts it by bin or value before anything is moved or sorted."""
    texts = []

    def noted(df):
        texts.append(plan(df))
        return settle(df)

    monkeypatch.setattr(driving, "settle", noted)
    texts.append(plan(driving_stats(proxies.telemetry(spark, SF))))
    assert len(texts) == 2
    for text in texts:
        # From the scan of the telemetry up to the aggregate that follows it.
        lines = text.split("\n")
        (at,) = [i for i, line in enumerate(lines) if "FileScan parquet" in line and "lineitem" in line]
        depth = {i: len(line) - len(line.lstrip(" :|+-*")) for i, line in enumerate(lines)}
        path, least = [], depth[at]
        for i in range(at - 1, -1, -1):
            if depth[i] < least:
                path.append(lines[i])
                least = depth[i]
        first_move = next(k for k, line in enumerate(path) if re.search(r"(?<!Broadcast)Exchange|Sort |Window", line))
        assert any("HashAggregate" in line and "partial_count" in line for line in path[:first_move])


def test_styles_read_written_statistics(spark):
    """Statistics and baselines come from one written table, not from the telemetry twice."""
    text = plan(driver_styles(proxies.telemetry(spark, SF)))
    scans = re.findall(r"Scan parquet.*", text)
    assert scans and not any("lineitem" in scan for scan in scans)


def test_laps_stay_where_they_are(spark):
    styles = settle(QUERIES["driving_style"](spark, SF))
    keys = ["event", "driver"]
    text = plan(with_style(paced_laps(worn_laps(proxies.wear_laps(spark, SF)), keys), styles, keys))
    assert "BroadcastHashJoin" in text and shuffles(text) == 0


def test_hot_driver_is_split_where_styles_are_not_broadcast(spark, setting):
    """Half of all laps are one driver's; its partition of the join is cut into several."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.shuffle.partitions", "32")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    laps = spark.range(0, 200_000, 1, 8).selectExpr(
        "'E' AS event", "if(id % 2 = 0, 'HOT', concat('D', id % 999)) AS driver", "rand(1) AS pace"
    )
    drivers = laps.select("event", "driver").distinct()
    styles = settle(drivers.selectExpr("*", "if(driver = 'HOT', 'AGRESSIVE', 'BALANCED') AS style"))
    counts = with_style(laps, styles, ["event", "driver"]).groupBy("style").count()
    assert dict(counts.collect()) == {"AGRESSIVE": 100_000, "BALANCED": 100_000}
    assert "SortMergeJoin(skew=true)" in plan(counts)


def test_filter_and_columns_reach_a_parquet_table(spark, tmp_path):
    path = str(tmp_path / "laps")
    proxies.stint_laps(spark, SF).write.parquet(path)
    df = timed_race_laps(spark.read.parquet(path)).select("event", "lap_time")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    assert "EqualTo(session,Race)" in text and "GreaterThan(lap_time" in text
    assert "total_laps" not in re.search(r"ReadSchema: struct<(.*)>", text).group(1)


def scan(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_reports_read_race_folders_and_their_columns_only(spark, tmp_path):
    laps, telemetry = str(tmp_path / "laps"), str(tmp_path / "telemetry")
    write_typed(typed_laps(proxies.lap_text(spark, SF)), laps)
    write_typed(typed_telemetry(proxies.telemetry_text(spark, SF)), telemetry)
    stored = read_typed_laps(spark, laps)
    wanted = {
        scan(race_totals(timed_race_laps(stint_laps_of(stored)))): ["tyre_age", "pit_out"],
        scan(paced_laps(worn_laps(wear_laps_of(stored)), ["event"])): ["stint"],
        scan(driving_stats(valid_telemetry(telemetry_of(read_typed_telemetry(spark, telemetry))))): [],
    }
    for text, unused in wanted.items():
        assert re.search(r"PartitionFilters: \[.*session#\d+.*Race", text)
        for read in re.findall(r"ReadSchema: struct<(.*)>", text):
            assert not any(column in read for column in unused)


def test_reshaping_shuffles_nothing(spark):
    text = plan(lap_rows(proxies.lap_docs(spark, SF)))
    assert "Generate inline" in text and shuffles(text) == 0
    assert len(lap_rows(proxies.lap_docs(spark, SF)).columns) == len(schemas.LAP_COLUMNS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    text = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    for word in ["Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"]:
        assert word not in text
