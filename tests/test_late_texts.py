"""Texts and prompts are joined last: no shuffle of ids carries them."""

from __future__ import annotations

import pytest

from tagmill.plans.all import QUERIES


def _shuffled(node):
    """The columns of every shuffle below a node of a plan."""
    if node.nodeName() == "Exchange":
        yield node.output().mkString(",")
    for i in range(node.children().size()):
        yield from _shuffled(node.children().apply(i))


@pytest.mark.parametrize(("name", "most"), [("sft_messages", 1), ("pair_prompts", 3)])
def test_texts_are_shuffled_as_few_times_as_joins_need(spark, name, most):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().initialPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    carried = [c for c in _shuffled(plan) if any(x in c for x in ("text#", "body", "prompt"))]
    assert len(carried) <= most, carried
