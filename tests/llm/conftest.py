"""Odd rows for every operator's tests."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block string, score double"
ODD_TEXTS = [None, "", " \n\t", "one", "a b c", "x" * 20_000, "word " * 3000, "a<P>b <S> <M>", "é ß İ Σ", "日本 語", "\x00 \x1f", "a b c", "a b c", " lead and trail \n"]


@pytest.fixture(scope="session")
def odd_rows(spark):
    """Odd texts, ties and repeated rows, null ids and languages, and columns with clashing names."""
    rows = [(i if i != 3 else None, t, "en" if i % 2 else None, None if i % 3 else "s", None, "mine", 0.5) for i, t in enumerate(ODD_TEXTS)]
    return spark.createDataFrame([*rows, rows[4]], SCHEMA)


@pytest.fixture(scope="session")
def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)
