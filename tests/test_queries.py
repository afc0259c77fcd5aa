"""Every query of the reference's operators against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from tagmill.plans.all import ORACLES, QUERIES
from tests.compare import canonical, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    ours, theirs = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours).equals(canonical(theirs))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_selections_are_pairs_once(spark, name):
    """What they select is compared with plain fills in test_semantics."""
    rows = QUERIES[name](spark, SF).cache()
    assert rows.count() == rows.select("a", "b").distinct().count() > 0
    assert rows.where("a >= b OR sim IS NULL").count() == 0
