"""Small documents with the awkward cases every operator meets."""

from __future__ import annotations

import pytest


@pytest.fixture
def awkward(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names clash with those of the operators."""
    long = " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000))
    rows = [
        (1, "one two three four five six"), (2, None), (3, ""), (4, " \t\n"), (5, long), (6, long), (7, "one two three four five six"),
        (7, "one two three four five six"), (None, "one two three four five six"), (None, None), (8, "solo"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs.selectExpr(
        "*", "'en' AS lang", "'s' AS source", "CAST(length(text) AS BIGINT) AS n_chars", "0 AS component_id", "1 AS kept", "2 AS score",
        "3 AS ids", "4 AS place", "5 AS bucket", "6 AS rep", "7 AS _id", "8 AS _kept", "9 AS words", "10 AS item_id")
