from __future__ import annotations

import random

import pytest

WORDS = [f"w{i}é" for i in range(300)]


@pytest.fixture(scope="session")
def documents(spark):
    """A table of (doc_id, text) with extra columns whose names clash with internal ones."""

    def make(rows):
        data = spark.createDataFrame(rows, "doc_id long, text string")
        return data.selectExpr(
            "*", "1 AS ids", "2 AS key", "3 AS found", "4 AS bucket", "5 AS sid", "6 AS length", "7 AS score"
        )

    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty texts, repeated rows and ids, a very long text, texts without words."""
    long = " ".join(random.Random(1).choices(WORDS, k=30_000))
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "one"),
        (5, long),
        (6, long.upper()),
        (7, "Hello world, again. ünïcödé 🦆 <|endoftext|> x"),
        (7, "Hello world, again. ünïcödé 🦆 <|endoftext|> x"),
        (None, "no id"),
        (8, "x" * 20_000),
        (9, None),
    ]
