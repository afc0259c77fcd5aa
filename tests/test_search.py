"""Short items in texts by automata against plain containment."""

from __future__ import annotations

import random

import pytest

from tagmill.operators import tagging


@pytest.mark.parametrize("chars", [1 << 20, 12])
def test_automata_equal_containment(spark, monkeypatch, chars):
    """Items inside items, overlaps, repeated items and texts, letters beyond 16 bits; one batch and many."""
    monkeypatch.setattr(tagging, "TRIE_CHARS", chars)
    rng = random.Random(chars)
    word = lambda n: "".join(rng.choice("ab é😀") for _ in range(n))
    texts = [word(rng.randint(0, 30)) for _ in range(50)] + [None, "", "aaaa"] + ["ab ab"] * 3
    items = [word(rng.randint(1, 5)) for _ in range(30)] + ["", None, "a", "aa", "aa", "not there"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {r.item_id: r.n_leaks for r in tagging.containments(docs, asked).collect()}
    assert got == {k: sum(x in t for t in texts if t is not None) if x is not None else 0 for k, x in enumerate(items)}
    assert all(r.n_leaks == 0 for r in tagging.containments(docs.limit(0), asked).collect())
    assert tagging.containments(docs, asked.limit(0)).count() == 0


def test_no_nested_loop_over_texts(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    plan = tagging.containments(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
