"""Neighbours that a query reads more than once are made once."""

from __future__ import annotations

from tagmill.plans.all import QUERIES

SF = "/root/testdata/sf0.001"


def test_entrants_read_neighbours_and_do_not_make_them_again(spark):
    plan = QUERIES["ab_entrants"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan
