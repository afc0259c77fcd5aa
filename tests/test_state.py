"""Typed state of verdicts, caches in buckets, and taxonomies as variants."""

from __future__ import annotations

import time
import tomllib

import pytest
from pyspark.sql import functions as F

from tagmill.sources import files
from tagmill.streaming import incremental, verdicts
from tagmill.streaming.caches import ScoreCache

VERDICTS = "id long, verdict string, at long"


def _feed(spark, folder, rows, schema=VERDICTS):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def _start(spark, tmp_path, made, out, **trigger):
    """A stream that adds what it emits to `out`."""
    into = lambda rows, _: out.extend(tuple(r) for r in rows.collect())
    with verdicts.rocksdb(spark):
        return made.writeStream.foreachBatch(into).outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(**trigger).start()


def _run(spark, tmp_path, made):
    """One run over what is new; what it emitted."""
    out = []
    _start(spark, tmp_path, made, out, availableNow=True).awaitTermination()
    return out


def _stream(spark, tmp_path, schema=VERDICTS):
    return spark.readStream.schema(schema).parquet(str(tmp_path / "in"))


def test_verdicts_are_kept_over_restarts_deleted_and_read_back(spark, tmp_path):
    kept = lambda: verdicts.kept_verdicts(_stream(spark, tmp_path), "id", "verdict", "at")
    _feed(spark, str(tmp_path / "in"), [(1, "x", 1), (1, "y", 2), (2, "z", None), (3, "w", 5), (3, "later", 5)])
    assert dict(_run(spark, tmp_path, kept())) == {1: "y", 2: "z", 3: "w"}
    _feed(spark, str(tmp_path / "in"), [(1, "old", 0), (3, "", 6), (4, None, 1)])
    assert dict(_run(spark, tmp_path, kept())) == {1: "y", 3: None, 4: None}
    # a late row does not bring back what was deleted
    _feed(spark, str(tmp_path / "in"), [(3, "before", 4)])
    assert dict(_run(spark, tmp_path, kept())) == {3: None}
    table = verdicts.verdict_table(spark, str(tmp_path / "c"))
    whole = spark.read.parquet(str(tmp_path / "in")).groupBy("id").agg(F.max_by("verdict", F.coalesce("at", F.lit(-1))).alias("verdict"))
    want = {r.id: r.verdict for r in whole.where("verdict <> ''").collect() if r.id != 3}
    assert {r.id: r.verdict for r in table.collect()} == want == {1: "y", 2: "z"}


def test_verdicts_expire(spark, tmp_path):
    _feed(spark, str(tmp_path / "in"), [(1, "x", 9)])
    out = []
    made = verdicts.kept_verdicts(_stream(spark, tmp_path), "id", "verdict", "at", keep_ms=1000)
    q = _start(spark, tmp_path, made, out, processingTime="200 milliseconds")
    try:
        for n, row in ((1, None), (2, (1, "y", 1))):
            if row:
                time.sleep(1.5)
                # with its state, the earlier row would not count
                _feed(spark, str(tmp_path / "in"), [row])
            end = time.time() + 40
            while len(out) < n and time.time() < end and q.isActive:
                time.sleep(0.2)
    finally:
        q.stop()
    assert out == [(1, "x"), (1, "y")]


def test_twins_share_verdicts(spark, tmp_path):
    schema = "twin string, id string, verdict string, at long"
    made = lambda: verdicts.twin_verdicts(_stream(spark, tmp_path, schema), "twin", "id", "verdict", "at")
    _feed(spark, str(tmp_path / "in"), [("p", "a", "yes", 1), ("p", "b", "", 1), ("q", "c", None, 1)], schema)
    assert sorted(_run(spark, tmp_path, made()), key=lambda r: r[1]) == [("p", "a", "yes", False), ("p", "b", "yes", True), ("q", "c", None, False)]
    _feed(spark, str(tmp_path / "in"), [("p", "b", "no", 2), ("p", "a", "", 3)], schema)
    assert sorted(_run(spark, tmp_path, made()), key=lambda r: r[1]) == [("p", "a", "no", True), ("p", "b", "no", False)]


def test_provider_is_put_back(spark):
    before = spark.conf.get(verdicts.PROVIDER)
    with pytest.raises(KeyError), verdicts.rocksdb(spark):
        raise KeyError
    assert spark.conf.get(verdicts.PROVIDER) == before


def _score(log):
    def score(todo):
        made = todo.withColumn("score", F.length("b") * 1.0)
        log.append(made.count())
        return made

    return score


def test_cache_is_looked_up_without_a_shuffle(spark, tmp_path):
    path, log = str(tmp_path / "cache"), []
    rows = spark.range(200).selectExpr("id AS a", "string(id % 7) AS b")
    incremental.append_scores(rows, path, ["a", "b"], _score(log), buckets=8)
    more = spark.range(100, 300).selectExpr("id AS a", "string(id % 7) AS b")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ScoreCache(spark, path, ["a", "b"]).unseen(more)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan, plan
        incremental.append_scores(more, path, ["a", "b"], _score(log), buckets=8)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    incremental.append_scores(more, path, ["a", "b"], _score(log))
    assert log == [200, 100, 0] and spark.read.parquet(path).count() == 300


def test_cache_goes_on_in_a_session_that_does_not_know_it(spark, tmp_path):
    path, log = str(tmp_path / "cache"), []
    rows = lambda n: spark.range(n).selectExpr("id AS a", "string(id % 7) AS b")
    incremental.append_scores(rows(0), path, ["a", "b"], _score(log), buckets=4)
    incremental.append_scores(rows(5), path, ["a", "b"], _score(log))
    spark.sql(f"DROP TABLE {ScoreCache(spark, path, ['a', 'b']).table}")
    incremental.append_scores(rows(9), path, ["a", "b"], _score(log))
    assert log == [0, 5, 4] and ScoreCache(spark, path, ["a", "b"]).rows().count() == 9
    with pytest.raises(ValueError, match="keys"):
        ScoreCache(spark, path, ["a"]).rows()
    with pytest.raises(ValueError, match="columns"):
        ScoreCache(spark, path, ["a", "b"]).append(rows(1))
    rows(2).write.parquet(str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="no record"):
        ScoreCache(spark, str(tmp_path / "plain"), ["a", "b"]).append(rows(1))


def test_replayed_batches_add_nothing(spark, tmp_path):
    rows = spark.range(50).selectExpr("id AS a", "string(id % 7) AS b")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    log = []
    # the second run has lost its checkpoint, and sees every batch again
    for n in range(2):
        incremental.score_stream(stream, str(tmp_path / "cache"), str(tmp_path / f"c{n}"), ["a", "b"], _score(log), buckets=4).awaitTermination()
    assert log == [50, 0] and spark.read.parquet(str(tmp_path / "cache")).count() == 50


DEEP = """
title = "none of three levels"
[a]
n = 3
list = ["x"]
c1 = "first"
[a.b.c.d]
c2 = "five levels"
[z.m]
c1 = "second"
[k.m]
c1 = "last in the document"
empty = ""
"""


def test_taxonomies_as_variants(spark, tmp_path):
    (tmp_path / "tax.toml").write_text(DEEP)

    def leaves(tree):
        for key, value in tree.items():
            if isinstance(value, dict):
                yield from leaves(value)
            elif isinstance(value, str):
                yield f"concept.{key}", value

    want = dict(leaves(tomllib.loads(DEEP)))
    got = files.concept_leaves(spark, str(tmp_path / "tax.toml"))
    assert {r.concept_id: r.definition for r in got.collect()} == want and want["concept.c1"] == "last in the document"
    three = files.taxonomy(spark, str(tmp_path / "tax.toml")).collect()
    assert {tuple(r) for r in three} == {("z", "m", "c1", "second"), ("k", "m", "c1", "last in the document"), ("k", "m", "empty", "")}
    (tmp_path / "empty.toml").write_text("")
    assert files.concept_leaves(spark, str(tmp_path / "empty.toml")).count() == 0
