"""Documents that are awkward in every way the operators must stand."""

from __future__ import annotations

import pytest

LONG = " ".join(f"word{i % 977}" for i in range(60_000)) + "."


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns whose names
    clash with those that operators make."""
    rows = [
        (1, "One line of text. Another line of text here.", "a"),
        (1, "One line of text. Another line of text here.", "a"),
        (2, None, "b"),
        (3, "", None),
        (4, " \t\n ", "b"),
        (5, LONG, "a"),
        (6, "One line of text. Another line of text here.", None),
        (None, "A text without an id, write to a.b@example.com please.", "c"),
        (None, None, None),
        (7, "Über straße 😀 naïve. ¡Qué día!", "d"),
    ]
    made = [(*row, -1, "x", 2.5, [1]) for row in rows]
    return spark.createDataFrame(
        made,
        "doc_id long, text string, source string, fp long, component_id string, score double, spans array<int>",
    ).selectExpr("*", "1 AS size", "2 AS taken", "3 AS key", "4 AS root", "5 AS kind", "6 AS toxic", "7 AS evidence")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
