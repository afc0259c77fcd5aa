"""Operators that write working tables, in a session without spark.checkpoint.dir."""

from __future__ import annotations

from tests.test_entry import REPO, _run

CODE = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
import __spark_entry__
from tagmill.llm.common import shared_dir
assert shared_dir(spark) == shared_dir(spark.newSession())
for name in NAMES:
    print(name, __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001").count())
"""
NAMES = ["op2_quality_classifier", "op5_katz_scoring", "op7_minhash_near_dedup", "op10_additive_ann", "op11_lexical_search", "pipeline"]


def test_queries_without_a_checkpoint_folder(tmp_path):
    out = _run(CODE.replace("NAMES", repr(NAMES)), REPO, tmp_path / "conf")
    assert all(f"{name} " in out for name in NAMES)
