from __future__ import annotations

import pytest

SCHEMA = ("doc_id long, text string, score int, row int, words int, spans int, features int, "
          "number int, text_hash int, start int, hash int, value int")

LONG = " ".join(f"word{i % 977} and" for i in range(60_000)) + " mail a.b@c.org"


def clashing(rows: list[tuple]) -> list[tuple]:
    return [(*row, *range(10)) for row in rows]


@pytest.fixture(scope="session")
def edge_rows() -> list[tuple]:
    """Nulls in both columns, empty and blank texts, ties, repeated rows, a very long text."""
    plain = "The quick brown fox jumps over the lazy dog again. It ran to a@b.org there."
    return [(1, None), (2, ""), (3, " \t\n"), (None, None), (None, plain), (None, "other text."),
            (4, plain), (4, plain), (4, "another text under one id."), (5, plain.upper()),
            (6, LONG), (7, LONG), (8, "x"), (9, "\U0001f600 ünï +49 (30) 123-4567 z")]


@pytest.fixture(scope="session")
def edges(spark, edge_rows):
    return spark.createDataFrame(clashing(edge_rows), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
