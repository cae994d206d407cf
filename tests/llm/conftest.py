from __future__ import annotations

import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, size int, block string"


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
SHARED = " ".join(f"shared{i}" for i in range(40))


@pytest.fixture(scope="session")
def edge_rows() -> list[tuple]:
    """Nulls, empties, ties, repeated rows, a very long text, loose spacing, clashing extra columns."""
    base = "the cat sat on the mat and it was a very good day for all of us here in town today"
    rows = [
        (1, base, "en", 1, "a"),
        (2, base, None, 2, None),
        (2, base, None, 2, None),  # a repeated row
        (3, None, "en", None, "b"),
        (4, "", "en", 3, "b"),
        (5, " \t\n ", "en", 3, "b"),
        (6, LONG, "en", 3, "b"),
        (7, f"one two {SHARED} three four", "en", 3, "b"),
        (8, f"{SHARED}\nfive  six\n\n{SHARED} ", "en", 3, "b"),
        (None, base, "en", 3, "b"),
        (None, "tail text without an id <|endoftext|> here", "en", 3, "b"),
        (9, "x", "en", 3, "b"),
        (10, "Ünïcödé wörds ▁▁ 日本 語 🙂 #hash $$ %% naïve", "de", 4, "c"),
        (11, "line a\nline a\nline b\n\n  \nline a", "en", 5, "c"),
        (12, " ".join(["again and again we go round"] * 9), "en", 5, "c"),
    ]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
