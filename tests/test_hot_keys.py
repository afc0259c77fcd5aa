"""Places and sums inside keys that hold most rows: by ranges, over many tasks, equal to plain windows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tagmill.functions import working
from tagmill.operators import geometry, pairs


@pytest.fixture
def many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _same(a, b):
    rows = lambda df: sorted(map(repr, df.select(*sorted(df.columns)).collect()))
    assert rows(a) == rows(b)


def test_sums_within_equal_a_window(many_tasks):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "hot", "cold", None]), i, rng.choice([None, 1, 2, 5])) for i in range(3000)]
    df = many_tasks.createDataFrame(rows, "k string, i long, x long")
    w = Window.partitionBy("k").orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, -1)
    plain = df.withColumn("before", F.coalesce(F.sum("x").over(w), F.lit(0)))
    _same(working.sums_within(df, ["k"], [F.desc("i")], {"x": "before"}), plain)
    assert working.sums_within(df.limit(0), ["k"], [F.desc("i")], {"x": "before"}).count() == 0


def test_places_of_one_key_come_from_many_tasks(many_tasks, monkeypatch):
    seen = []
    plain = working.checkpointed
    monkeypatch.setattr(working, "checkpointed", lambda df: seen.append(plain(df)) or seen[-1])
    df = many_tasks.range(5000).withColumn("k", F.lit("all"))
    got = working.places_within(df, ["k"], [F.col("id")], "place")
    assert got.where("place <> id + 1").count() == 0 and got.count() == 5000
    sizes = [r["count"] for r in seen[0].groupBy("k", "range_").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2500


def test_rows_that_tie_have_all_places(many_tasks):
    df = many_tasks.createDataFrame([("a", 1)] * 7 + [("a", 0)] * 2, "k string, x int")
    got = working.places_within(df, ["k"], [F.col("x")], "place").collect()
    assert sorted(r.place for r in got) == list(range(1, 10)) and {r.place for r in got if r.x == 0} == {1, 2}


def test_panels_of_one_concept_go_in_slices(many_tasks, monkeypatch):
    rng = random.Random(5)
    rows = [("all", i, f"t{i % 3}", rng.random()) for i in range(600)] + [("few", i, f"t{i % 3}", rng.random()) for i in range(0, 600, 40)]
    df = many_tasks.createDataFrame(rows, "via string, chunk long, tradition string, score double")
    whole = geometry.derived_panels(df, 0.2, 3).collect()
    monkeypatch.setattr(geometry, "SLICE", 37)
    assert sorted(geometry.derived_panels(df, 0.2, 3).collect()) == sorted(whole) != []


def test_null_percentiles_equal_a_plain_count(many_tasks):
    rng = random.Random(9)
    dirs = [(f"t{t}", f"c{c}", [round(rng.uniform(-1, 1), 1) for _ in range(2)]) for t in range(3) for c in range(12)]
    scored = [("t0", "t1", f"c{c}", round(rng.uniform(-1, 1), 2), "kept") for c in range(12)] + [("t0", "t1", "c0", None, "null"), ("t0", "t9", "c0", 0.5, "no cells")]
    d = many_tasks.createDataFrame(dirs, "tradition string, concept string, v array<double>")
    s = many_tasks.createDataFrame(scored, "ta string, tb string, concept string, cosine double, note string")
    null = [sum(x * y for x, y in zip(v, w)) for t, _, v in dirs for u, _, w in dirs if (t, u) == ("t0", "t1")]
    for r in geometry.null_percentiles(s, d).collect():
        want = 100 * sum(x < r.cosine - 1e-12 for x in null) / len(null) if r.note == "kept" else None
        assert r.percentile == (None if want is None else pytest.approx(want)), r


def test_stratified_takes_turns(many_tasks):
    rng = random.Random(2)
    df = many_tasks.createDataFrame([(rng.choice("aaaaaabc"), i) for i in range(400)], "s string, id long")
    got = pairs.stratified(df, ["s"], 100, "7", "id").collect()
    assert sorted(r.pick for r in got) == list(range(1, 101))
    assert [(r.turn, r.s) for r in sorted(got, key=lambda r: r.pick)] == sorted((r.turn, r.s) for r in got)
