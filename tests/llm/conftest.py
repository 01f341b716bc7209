from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, one id twice,
    and columns whose names clash with results."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    base = " ".join(f"base{i}" for i in range(60))
    near = base.replace("base59", "other")
    line = "This very line occurs in several documents"
    rows = [(1, base, "en", "a"), (2, base.upper(), "en", "a"), (3, near, "en", "b"), (4, long, "en", "b"),
            (4, long, "en", "b"), (5, "", "en", "c"), (6, None, None, None), (None, base + " more", "en", "a"),
            (None, None, None, None), (7, f"{line}\n  {line.lower()}  \nalone a", "en", "a"), (8, f"{line}\nalone b", "en", None),
            (9, f"first\n{line}", "de", "c"), (10, " \t\n\x0b ", "en", "c"), (10, "two words", "en", "c"),
            (11, " ".join(["again"] * 40), "en", "a"), (12, "ünï cödé  x " * 12, "fr", "z")]
    return spark.createDataFrame([(*r, None, "clash", "clash") for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
