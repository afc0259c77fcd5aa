"""Texts of some megabytes through the operators that take blocks of texts."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from tagmill.llm import katz, media, near_dedup, substring_dedup


@pytest.fixture(scope="module")
def long_rows(spark):
    rng = np.random.default_rng(11)
    words = np.array([f"{a}{b}{c}" for a in "bdgklm" for b in "aeiou" for c in "nrst"])
    text = " ".join(rng.choice(words, 600_000))
    # a near copy, an unlike text of equal length, and short ones
    rows = [(1, text), (2, text + " and a little more"), (3, " ".join(rng.choice(words, 600_000))), (4, "short text"), (5, None)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_media(spark, long_rows):
    rows, df = long_rows
    for r in media.read_media(media.store_media(df)).collect():
        assert r.payload_sha256 == hashlib.sha256(media.padded((r.text or "").encode())).hexdigest()


def test_katz(spark, long_rows):
    rows, df = long_rows
    got = {r.doc_id: r for r in katz.katz_scores(df).collect()}
    assert [got[i].n_tokens for i in (1, 2, 3, 4, 5)] == [600_001, 600_005, 600_001, 3, 1]
    assert all(np.isfinite(r.score) and r.score < 0 for r in got.values())


def test_near_duplicates(spark, long_rows):
    rows, df = long_rows
    got = {r.doc_id: (r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect()}
    assert got == {1: (1, True), 2: (1, False), 3: (3, True), 4: (4, True), 5: (5, True)}


def test_substrings(spark, long_rows):
    rows, df = long_rows
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.drop_repeats(df).collect()}
    assert got[1] == (600_000, 600_000) and got[2] == (600_004, 600_000)
    assert got[3] == (600_000, 0) and got[4] == (2, 0) and got[5] == (0, 0)
