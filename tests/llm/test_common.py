"""Samples of a bounded size."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stintlab.llm.common import bounded_sample
from stintlab.staging import settle


@pytest.mark.parametrize("n", [0, 1, 7, 400, 1500, 5000])
def test_the_lowest_hashes_are_drawn(spark, n):
    """Exactly as many rows as asked for, or all, also where one id has a third of all rows."""
    rows = settle(
        spark.range(0, 1500, 1, 4).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.col("id").alias("other")
        )
    )
    got = [tuple(r) for r in bounded_sample(rows, n, "doc_id", "other").collect()]
    expected = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "other").limit(n).collect()
    assert got == [tuple(r) for r in expected]
    assert len(got) == min(n, 1500)


def test_nothing_to_draw_from(spark):
    rows = spark.range(0).selectExpr("id AS doc_id")
    assert bounded_sample(rows, 5, "doc_id").count() == 0


def test_few_rows_are_ranked(spark):
    rows = settle(spark.range(0, 200_000, 1, 4).selectExpr("id AS doc_id"))
    sample = bounded_sample(rows, 100, "doc_id")
    condition = sample._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in condition and "shiftright" in condition
