"""Queries against their SQL where order keys have seven digits, so that several chunks share an id."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tagmill.plans.all import ORACLES, QUERIES
from tests.compare import TABLES, canonical, connect

SF = "/root/testdata/sf0.001"
SHIFT = 1_000_000


@pytest.fixture(scope="module")
def shifted(spark, tmp_path_factory):
    """Orders from 1,000,000 on, with their lines; parts, which are joined as orders, follow."""
    folder = tmp_path_factory.mktemp("large-keys")
    moved = {"orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_partkey"]}
    for t in TABLES:
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        df.withColumns({c: F.col(c) + SHIFT for c in moved.get(t, [])}).write.parquet(f"{folder}/{t}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["group_key", "human_metrics", "partition_cost"])
def test_equals_sql(spark, shifted, name):
    chunks = connect(shifted).execute("SELECT count(*) - count(DISTINCT c_nationkey || '.' || c_mktsegment || '.' || lpad(o_orderkey::VARCHAR, 6, '0')) FROM orders JOIN customer ON o_custkey = c_custkey").fetchall()
    assert chunks[0][0] > 0
    ours, theirs = QUERIES[name](spark, shifted).toPandas(), connect(shifted).execute(ORACLES[name]).df()
    assert canonical(ours).equals(canonical(theirs))
