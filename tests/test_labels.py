"""Labels of pairs of vectors: line items are grouped before they meet vectors."""

from __future__ import annotations

from tagmill.sources.tables import Tables


def test_line_items_are_grouped_before_they_are_joined(spark, tmp_path):
    """Where no side is broadcast, as with many vectors, no line item is shuffled as such; the last row of a pair wins."""
    lines = [(7, 503, 1.0, "A"), (3, 7, 2.0, "R"), (1007, 3, 1.0, "A"), (3, 7, 3.0, "A"), (8, 3, 9.0, "A"), (507, 507, 1.0, "A")]
    spark.createDataFrame(lines, "l_partkey long, l_suppkey long, l_extendedprice double, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(3, 0), (7, 1), (8, 0)], "vec_id long, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        labels = Tables(spark, str(tmp_path)).vector_labels
        rows, plan = labels.collect(), labels._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # 1007 and 3 come last among the rows of 3 and 7
    assert [(r.a, r.b, r.positive) for r in rows] == [(3, 7, True)]
    lines_ = plan.splitlines()
    scan = next(i for i, x in enumerate(lines_) if "Scan parquet" in x and "l_suppkey" in x)
    above = [x for x in lines_[:scan] if "Exchange " in x or "Aggregate(" in x or "Join" in x]
    assert "Aggregate(" in above[-1]
