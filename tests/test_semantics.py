"""Rules that the SQL comparison does not pin down."""

from __future__ import annotations

import hashlib
import json
from datetime import UTC, datetime
from decimal import ROUND_HALF_EVEN, Decimal

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagmill.functions import agreement, columns, parsing, working
from tagmill.functions.columns import bucket, rounded, wilson_lower
from tagmill.operators import geometry, pairs, tagging, vectors
from tagmill.plans.all import QUERIES
from tagmill.sources import files, models, sinks
from tagmill.sources.tables import Tables
from tagmill.streaming import incremental
from tests.compare import canonical

SF = "/root/testdata/sf0.001"


def _tags(spark, rows):
    return spark.createDataFrame(rows, "id int, chunk_id string, concept_id string, score int, status string")


@pytest.mark.parametrize(
    ("rows", "winner"),
    [
        ([(1, "a", "c", 3, "pending"), (2, "a", "c", 1, "accepted")], 2),
        ([(1, "a", "c", 1, "accepted"), (2, "a", "c", 2, "accepted")], 2),
        ([(1, "a", "c", 2, "pending"), (2, "a", "c", 2, "rejected")], 1),
    ],
)
def test_supersede(spark, rows, winner):
    assert [r.id for r in tagging.supersede(_tags(spark, rows), order=["id"]).collect()] == [winner]


def test_denylist_is_case_insensitive_and_drops_null_models(spark):
    df = spark.createDataFrame([("Student-1",), ("STUDENT",), ("teacher",), (None,)], "model string")
    assert [r.model for r in tagging.without_prefixes(df, ("student",)).collect()] == ["teacher"]


def test_bucket_is_the_hash_of_seed_and_id(spark):
    ids = [f"t.w.{i}" for i in range(200)]
    got = spark.createDataFrame([(i,) for i in ids], "id string").select("id", bucket("7", "id").alias("b")).collect()
    for r in got:
        assert r.b == int.from_bytes(hashlib.sha256(f"7:{r.id}".encode()).digest()[:8], "big") / 2**64


def test_rounding_is_half_even(spark):
    got = spark.createDataFrame([(0.0625,), (0.1875,)], "x double").select(rounded("x", 3).alias("r")).collect()
    assert [r.r for r in got] == [float(Decimal(x).quantize(Decimal("0.001"), ROUND_HALF_EVEN)) for x in ("0.0625", "0.1875")]


def test_wilson_of_nothing_is_zero(spark):
    got = spark.createDataFrame([(0, 0), (0, 5), (5, 5)], "k int, n int").select(wilson_lower(F.col("k"), F.col("n")).alias("w")).collect()
    assert got[0].w == 0 and got[1].w == 0 and 0.5 < got[2].w < 1


CASES = [
    ('[{"concept_id": "a", "score": 2}]', True, {"a": 2}),
    ('{"results": [{"concept_id": "a", "score": "3"}]}', True, {"a": 3}),
    ('```json\n[{"concept_id": "a"}]\n```', True, {"a": 0}),
    ('[{"concept_id": "a", "score": 1}, {"concept_id": "b", "sco', True, {"a": 1}),
    ("[]", True, {}),
    ("7", True, {}),
    ("no json", False, {}),
    ('[{"concept_id": "a", "score": 1}, 5, {"concept_id": "a", "score": 2.7}, {"concept_id": "b", "score": "2.7"}]', True, {"a": 2}),
    ('[{"concept_id": null, "score": 1}]', True, {"None": 1}),
    (None, False, {}),
]


@pytest.mark.parametrize(("raw", "ok", "scores"), CASES)
def test_read_tags(raw, ok, scores):
    assert parsing.read_tags(raw) == (ok, scores)


def test_parse_tags_in_spark_equals_the_reader(spark):
    df = spark.createDataFrame([(i, raw) for i, (raw, _, _) in enumerate(CASES)], "i int, raw string")
    rows = parsing.parse_tags(df).collect()
    for i, (_, ok, scores) in enumerate(CASES):
        mine = [r for r in rows if r.i == i]
        assert all(r.parse_ok == ok for r in mine)
        assert {r.concept_id: r.score for r in mine if r.concept_id is not None} == scores


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("abc_", min_size=1, max_size=5), st.integers(0, 3)), max_size=6), st.integers(0, 300))
def test_truncated_output_keeps_whole_objects(tags, cut):
    whole = json.dumps([{"concept_id": c, "score": s} for c, s in tags])
    ok, got = parsing.read_tags(whole[:cut])
    assert set(got.items()) <= set(tags)
    if cut >= len(whole):
        assert ok and got == dict(tags)


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ('{"a": 1} x {"b": {"c": 2}}', [{"a": 1}, {"b": {"c": 2}}]),
        ('{"a": "}"} {"b": "\\""}', [{"a": "}"}, {"b": '"'}]),
        ('said "{1}" } {"a": 1}', [{"a": 1}]),
        ('{bad} {"a": 1}', [{"a": 1}]),
        ('{"a": 1} {"b": {"c": 2}', [{"a": 1}]),
        ('{"a": 1', []),
        ('"open {"a": 1}', []),
        ("{" * 5000, []),
        ('{"a":' * 300 + "1" + "}" * 300, None),
        ("", []),
    ],
)
def test_objects_of_the_outermost_level(raw, want):
    got = parsing.objects(raw)
    assert len(got) == 1 if want is None else got == want


def test_verdict_ignores_stray_braces_and_unknown_kinds(spark):
    raw = ['so } {"x": 1} {"edge_type": "CONTRASTS", "confidence": "0.5"}', '{"edge_type": "kin"}', None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, raw string").select("i", parsing.verdict_of(F.col("raw")).alias("v"))
    got = [r.v for r in df.orderBy("i").collect()]
    assert (got[0].edge_type, got[0].confidence) == ("CONTRASTS", 0.5)
    assert got[1].edge_type is None and got[2].justification == ""


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(60, 8))
    df = spark.createDataFrame([(i, f"t{i % 4}", v[i].tolist()) for i in range(60)], "vec_id long, tradition string, v array<double>")
    got = {(r.i, r["rank"]): r.j for r in vectors.neighbours(df, 5).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    for i in range(60):
        others = [j for j in range(60) if j % 4 != i % 4]
        best = sorted(others, key=lambda j: (-(u[i] @ u[j]), j))[:5]
        assert [got[i, r] for r in range(1, 6)] == best


def test_greedy_fill_respects_caps_and_quotas(spark):
    rows = [("x", a, b, (a * 7 + b * 3) % 11 / 11) for a in range(6) for b in range(6, 12)]
    pairs_ = spark.createDataFrame(rows, "block string, a long, b long, sim double")
    quotas = spark.createDataFrame([("x", 7)], "block string, quota int")
    got = vectors.greedy_fill(pairs_, quotas, "block", cap=2).collect()
    used = [x for r in got for x in (r.a, r.b)]
    assert len(got) <= 7 and max(map(used.count, used)) <= 2


def test_allocation_spends_the_budget(spark):
    blocks = spark.createDataFrame([(f"b{i}", float(i)) for i in range(9)], "block string, weight double")
    assert abs(sum(r.quota for r in vectors.allocate(blocks, 500, 10).collect()) - 500) <= 9


def _fill(sims, block_of, quotas, cap, eligible=lambda block, sim: True):
    out = set()
    for block, quota in quotas.items():
        used, taken = {}, 0
        rows = sorted((r for r in sims if block_of(r) == block), key=lambda r: (-r.sim, r.a, r.b))
        for r in rows:
            if taken < quota and eligible(block, r.sim) and used.get(r.a, 0) < cap and used.get(r.b, 0) < cap:
                used[r.a], used[r.b], taken = used.get(r.a, 0) + 1, used.get(r.b, 0) + 1, taken + 1
                out.add((r.a, r.b))
    return out


def _parts(spark):
    t = Tables(spark, SF)
    vs = {r.vec_id: r for r in t.vectors.select("vec_id", "tradition", "work").collect()}
    return vs, t.vector_labels.collect(), vectors.all_pairs(t.vectors).collect()


def _tally(labels, key):
    out = {}
    for r in labels:
        good, n = out.get(key(r), (0, 0))
        out[key(r)] = good + bool(r.positive), n + 1
    return out


def test_worklevel_equals_brute_force(spark):
    vs, labels, sims = _parts(spark)
    key = lambda part: lambda r: "|".join(sorted((vs[r.a][part], vs[r.b][part])))
    by_work, by_trad = _tally(labels, key("work")), _tally(labels, key("tradition"))
    grand = sum(g for g, _ in by_trad.values()) / sum(n for _, n in by_trad.values())
    sizes, trad = {}, {v.work: v.tradition for v in vs.values()}
    for v in vs.values():
        sizes[v.work] = sizes.get(v.work, 0) + 1
    weights = {}
    for x in sizes:
        for y in sizes:
            if x < y and trad[x] != trad[y]:
                tg, tn = by_trad.get("|".join(sorted((trad[x], trad[y]))), (0, 0))
                g, n = by_work.get(f"{x}|{y}", (0, 0))
                weights[f"{x}|{y}"] = (g + 20 * (tg + 20 * grand) / (tn + 20)) / (n + 20) * (sizes[x] * sizes[y]) ** 0.5
    budget = QUERIES["select_current"](spark, SF).count()
    shares = {k: budget * w / sum(weights.values()) for k, w in weights.items()}
    quotas = {k: int(x) for k, x in shares.items()}
    for k in sorted(shares, key=lambda k: (-round(shares[k] % 1, 9), k))[: budget - sum(quotas.values())]:
        quotas[k] += 1
    assert sum(quotas.values()) == budget and len(set(quotas.values())) > 1
    blocks = {}
    for r in sims:
        blocks.setdefault(key("work")(r), []).append(r)
    floors = {k: np.percentile([r.sim for r in v], 90) for k, v in blocks.items()}
    want = set()
    for k, rows in blocks.items():
        want |= _fill(rows, lambda r, k=k: k, {k: quotas[k]}, 2, lambda b, s: s >= floors[b] - 1e-12)
    assert len(want) > budget / 2
    assert {(r.a, r.b) for r in QUERIES["select_worklevel"](spark, SF).collect()} == want


def _wilson(k, n, z=1.96):
    p = k / n
    return max(0.0, (p + z * z / (2 * n) - z * ((p * (1 - p) + z * z / (4 * n)) / n) ** 0.5) / (1 + z * z / n))


def test_budget_equals_brute_force_on_sparse_labels(spark, monkeypatch):
    t = Tables(spark, SF)
    few = t.vector_labels.where("a % 50 < 10").cache()
    monkeypatch.setattr(Tables, "vector_labels", few)
    vs, labels, sims = _parts(spark)
    key = lambda r: "|".join(sorted((vs[r.a].tradition, vs[r.b].tradition)))
    tally, sizes = _tally(labels, key), {}
    for v in vs.values():
        sizes[v.tradition] = sizes.get(v.tradition, 0) + 1
    weights = {}
    for x in sizes:
        for y in sizes:
            if x < y:
                g, n = tally.get(f"{x}|{y}", (0, 0))
                weights[f"{x}|{y}"] = ((_wilson(g, n) if n >= 20 else 0.15) + 0.15) * (sizes[x] * sizes[y]) ** 0.5
    floor = min(10, 1000 // len(weights))
    quotas = {k: floor + round((1000 - floor * len(weights)) * w / sum(weights.values())) for k, w in weights.items()}
    blocks, want = {}, set()
    for r in sims:
        blocks.setdefault(key(r), []).append(r)
    for k, rows in blocks.items():
        want |= _fill(rows, lambda r, k=k: k, {k: quotas[k]}, 3)
    assert len(want) > 500
    assert {(r.a, r.b) for r in QUERIES["select_budget"](spark, SF).collect()} == want


def test_pairs_of_traditions_without_labels_get_a_weight(spark):
    vs = spark.createDataFrame([(i, f"t{i % 3}", f"t{i % 3}/w") for i in range(9)], "vec_id long, tradition string, work string")
    labels = spark.createDataFrame([(0, 1, True)] * 20, "a long, b long, positive boolean")
    got = {r.block: r.weight for r in vectors.tradition_weights(vs, labels).collect()}
    assert got == pytest.approx({"t0|t1": (_wilson(20, 20) + 0.15) * 3, "t0|t2": 0.9, "t1|t2": 0.9})


def test_kappa_of_constant_graders_is_null(spark):
    df = spark.createDataFrame([(True, True)] * 3, "a boolean, b boolean")
    assert df.agg(agreement.kappa(F.col("a"), F.col("b")).alias("k")).first().k is None


def test_stratified_takes_strata_in_turn(spark):
    rows = spark.createDataFrame([(s, f"{s}{i}") for s in "ab" for i in range(10 if s == "a" else 2)], "s string, key string")
    got = pairs.stratified(rows, ["s"], 6, "1", "key").groupBy("s").count().collect()
    assert {r.s: r["count"] for r in got} == {"a": 4, "b": 2}


def test_hash_rank_is_a_total_order(spark):
    got = tagging.hash_ranked(spark.range(500).selectExpr("id AS k"), "s", "k").orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 501)) and got[0].n == 500
    hashes = [hashlib.sha256(f"s:{r.k}".encode()).hexdigest() for r in got]
    assert hashes == sorted(hashes)


def test_empty_tables(spark):
    tags = _tags(spark, [])
    assert tagging.supersede(tags, order=["id"]).count() == 0
    none = spark.createDataFrame([], "vec_id long, tradition string, v array<double>")
    assert vectors.neighbours(none, 3).count() == 0


def test_sources_round_trip(spark, tmp_path):
    folder = tmp_path / "corpus" / "trad" / "text" / "chunks"
    folder.mkdir(parents=True)
    (folder / "001.toml").write_text('[content]\nbody = "words"\n[chunk]\ntext_name = "T"\n')
    row = files.toml_passages(spark, str(tmp_path / "corpus")).first()
    assert (row.chunk_id, row.body, row.text_name, row.section) == ("trad.text.001", "words", "T", None)
    (tmp_path / "tax.toml").write_text('[d.f]\nc1 = "x"\n')
    assert [tuple(r) for r in files.taxonomy(spark, str(tmp_path / "tax.toml")).collect()] == [("d", "f", "c1", "x")]
    for name, kind in (("a", "PARALLELS"), ("b", "unrelated")):
        (tmp_path / f"{name}.jsonl").write_text(json.dumps({"idx": 1, "edge_type": kind}) + "\nbroken\n")
    got = files.merged_grades(spark, str(tmp_path / "*.jsonl"), ["PARALLELS", "unrelated"]).collect()
    assert [(r.idx, r.edge_type, r.times) for r in got] == [(1, "unrelated", 2)]
    lines = [{"idx": 1, "edge_type": k} for k in ("unrelated", "PARALLELS")] + [{"edge_type": "unrelated"}, {"idx": 5, "edge_type": "kin"}]
    (tmp_path / "b.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\nbroken\n")
    got = files.merged_grades(spark, str(tmp_path / "*.jsonl"), ["PARALLELS", "unrelated"]).collect()
    assert [(r.idx, r.edge_type, r.times) for r in got] == [(1, "PARALLELS", 3)]  # the later line of the later file
    why = [r.reason for r in files.rejected_grades(spark, str(tmp_path / "b.jsonl"), ["PARALLELS", "unrelated"]).collect()]
    assert sorted(why) == ["malformed", "no idx", "unknown kind"]
    blobs = spark.createDataFrame([("c", bytearray(np.array([3, 4], "<f4").tobytes())), ("d", bytearray(b"x"))], "chunk_id string, vector binary")
    assert [r.v for r in files.decoded_vectors(blobs, 2).collect()] == [[0.6, 0.8]]
    for s in ("2024-01-01T00-00-00Z", "2025-01-01T00-00-00Z"):
        (tmp_path / "snap" / s).mkdir(parents=True)
    assert files.latest_snapshot(spark, str(tmp_path / "snap")) == "2025-01-01T00-00-00Z"
    with pytest.raises(ValueError):
        sinks.guarded("/live/x", "/live")


def test_stream_scores_each_key_once(spark, tmp_path):
    keys = ["user_id", "event_type"]
    score = lambda df: df.select(*keys, F.lit(1.0).alias("score"))
    stream = incremental.event_stream(spark, SF)
    for _ in range(2):
        incremental.score_stream(stream, str(tmp_path / "cache"), str(tmp_path / "check"), keys, score).awaitTermination()
    batch = spark.read.parquet(f"{SF}/events.parquet").select(*keys).distinct()
    cached = spark.read.parquet(str(tmp_path / "cache"))
    assert cached.count() == batch.count() == cached.select(*keys).distinct().count()


def test_stream_windows_equal_batch(spark, tmp_path):
    stream = incremental.counts_by_window(incremental.event_stream(spark, SF), "ts", "1 hour", "1 hour", ["event_type"])
    q = stream.writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    ours = spark.table("windows").selectExpr("window.start AS hour", "event_type", "n").toPandas()
    batch = spark.read.parquet(f"{SF}/events.parquet").groupBy(F.date_trunc("hour", "ts").alias("hour"), "event_type").agg(F.count("*").alias("n")).toPandas()
    assert canonical(ours).equals(canonical(batch))


def test_stream_keeps_last_verdicts(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "z", 1), (2, "", 2)], "id long, verdict string, at long")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = incremental.last_verdicts(stream, "id", "verdict", "at").writeStream.format("memory").queryName("verdicts").outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.id: r.verdict for r in spark.table("verdicts").collect()} == {1: "y", 2: None}


def test_small_files_become_tables(spark, tmp_path):
    (tmp_path / "deep.toml").write_text('[a]\nc1 = "x"\n[a.b.c]\nc2 = "y"\n')
    assert {tuple(r) for r in files.concept_leaves(spark, str(tmp_path / "deep.toml")).collect()} == {("concept.c1", "x"), ("concept.c2", "y")}
    (tmp_path / "works.toml").write_text('[[work]]\nid = "w"\ntexts = ["t1", "t2"]\n')
    works = files.work_map(spark, str(tmp_path / "works.toml"))
    rows = spark.createDataFrame([("t1",), ("t9",)], "text_id string")
    assert {tuple(r) for r in files.with_work(rows, works).select("text_id", "work").collect()} == {("t1", "w"), ("t9", "t9")}
    (tmp_path / "ids.txt").write_text(" a \n\nb\n  \n")
    assert [r.id for r in files.id_lines(spark, str(tmp_path / "ids.txt")).collect()] == ["a", "b"]
    (tmp_path / "m.json").write_text(json.dumps({"n": 2, "splits": {"c1": "train", "c2": "val"}}, indent=1))
    assert {tuple(r) for r in files.split_manifest(spark, str(tmp_path / "m.json")).collect()} == {("c1", "train"), ("c2", "val")}
    docs = tmp_path / "docs"
    docs.mkdir()
    for name in ("x", "y", "_skip"):
        (docs / f"{name}.json").write_text(json.dumps({"work": name}, indent=2))
    assert {(r.work, r.file) for r in files.json_documents(spark, f"{docs}/*.json", "work string").collect()} == {("x", "x.json"), ("y", "y.json")}
    (tmp_path / "t.csv").write_text("a,b\n1,x\nbad,y\n")
    assert [tuple(r) for r in files.csv_table(spark, str(tmp_path / "t.csv"), {"a": "int", "b": "string"}).collect()] == [(1, "x"), (None, "y")]
    (tmp_path / "t.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert [r.a for r in files.json_lines(spark, str(tmp_path / "t.jsonl"), "a int").collect()] == [1, 2]
    with_it = files.optional_column(rows, "extra", "double")
    assert with_it.columns == ["text_id", "extra"] and files.optional_column(with_it, "extra", "int").schema == with_it.schema
    row = files.file_digests(spark, str(tmp_path / "ids.txt")).first()
    assert (row.file, row.sha256) == ("ids.txt", hashlib.sha256((tmp_path / "ids.txt").read_bytes()).hexdigest())


def test_layer_vectors_read_one_partition(spark, tmp_path):
    rows = [(f"c{i}", layer, pool, [float(i), float(layer)]) for i in range(3) for layer in (1, 2) for pool in ("mean", "last")]
    sinks.write_vectors(spark.createDataFrame(rows, "chunk_id string, layer int, pooling string, vec array<double>"), str(tmp_path / "v"))
    got = files.layer_vectors(spark, str(tmp_path / "v"), 2, "last")
    assert {(r.chunk_id, tuple(r.vec)) for r in got.collect()} == {(f"c{i}", (float(i), 2.0)) for i in range(3)}
    assert "PartitionFilters: [isnotnull(layer" in got._jdf.queryExecution().toString()


def test_lines_tables_and_reports_are_written(spark, tmp_path):
    df = spark.createDataFrame([(1, 'é "q", x', None), (2, "a|b", 0.5)], "k int, s string, x double")
    sinks.write_json_lines(df, str(tmp_path / "j"))
    text = "".join(p.read_text() for p in (tmp_path / "j").glob("*.json"))
    assert "é" in text and '"x":null' in text
    for name, write, sep in (("c", sinks.write_csv, ","), ("t", sinks.write_tsv, "\t")):
        write(df, str(tmp_path / name))
        back = spark.read.option("header", True).option("sep", sep).option("escape", '"').csv(str(tmp_path / name))
        assert {r.s for r in back.collect()} == {'é "q", x', "a|b"}
    assert sinks.markdown(df.where("k = 2")) == "| k | s | x |\n|---|---|---|\n| 2 | a\\|b | 0.5 |\n"
    with pytest.raises(ValueError):
        sinks.markdown(df, most=1)
    sinks.withheld(df, ["k"], ["x"], str(tmp_path / "shown"), str(tmp_path / "key"))
    assert set(spark.read.json(str(tmp_path / "shown")).columns) == {"k", "s"} and set(spark.read.json(str(tmp_path / "key")).columns) == {"k", "x"}
    good = spark.createDataFrame([(True,)], "may_freeze boolean")
    sinks.frozen(good, df, str(tmp_path / "frozen"))
    with pytest.raises(ValueError):
        sinks.frozen(good.selectExpr("NOT may_freeze AS may_freeze"), df, str(tmp_path / "other"))
    with pytest.raises(FileExistsError):
        sinks.frozen(good, df, str(tmp_path / "frozen"))


def test_snapshots_caches_and_keyed_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, s string, at int")
    at = datetime(2025, 3, 1, tzinfo=UTC)
    root = str(tmp_path / "snap")
    assert sinks.snapshot({"t": df, "u": df.limit(1)}, root, "x", at) == "2025-03-01T00-00-00Z-x"
    row = spark.read.json(f"{root}/2025-03-01T00-00-00Z-x/manifest.json").first()
    assert (row.counts.t, row.counts.u) == (2, 1)
    calls = []
    compute = lambda: calls.append(1) or df
    for _ in range(2):
        assert sinks.keyed_by_snapshot(spark, root, str(tmp_path / "cache"), compute).count() == 2
    sinks.snapshot({"t": df}, root, at=at.replace(year=2026))
    sinks.keyed_by_snapshot(spark, root, str(tmp_path / "cache"), compute)
    assert len(calls) == 2
    progress = str(tmp_path / "progress")
    sinks.upsert(spark, progress, df, ["k"], "at", at)
    new = spark.createDataFrame([(1, "old", 0), (2, "new", 1), (3, "c", 5)], "k int, s string, at int")
    assert {tuple(r) for r in sinks.upsert(spark, progress, new, ["k"], "at", at).collect()} == {(1, "a", 1), (2, "new", 1), (3, "c", 5)}
    stamped = spark.createDataFrame([(at,)], "t timestamp").select(sinks.stamp_of(F.col("t")).alias("s")).first().s
    assert stamped == sinks.stamp(at) == "2025-03-01T00-00-00Z"


def test_reopening_is_dry_until_executed(spark, tmp_path):
    tags = spark.createDataFrame([(1, "c", "t.x.1", "accepted", "why"), (2, "c", "u.x.1", "accepted", None), (3, "c", "t.x.2", "pending", None)], "id int, concept_id string, chunk_id string, status string, justification string")
    suspects = spark.createDataFrame([("c", "t")], "concept_id string, tradition string")
    new = pairs.reopened(tags, suspects, "batch-1")
    where = (str(tmp_path / "new"), str(tmp_path / "backup"), "batch-1")
    assert sinks.reopen(tags, new, *where) == {"planned": 1} and not (tmp_path / "new").exists()
    assert sinks.reopen(tags, new, *where, execute=True) == {"planned": 1, "marked": 1, "rows": 3}
    assert spark.read.parquet(where[1]).where("status = 'accepted'").count() == 2


def test_models_answer_with_errors_and_retries(spark):
    def client():
        tried = {}

        def ask(text):
            tried[text] = tried.get(text, 0) + 1
            if text == "bad" or (text == "flaky" and tried[text] < 3):
                raise TimeoutError("slow")
            return text.upper()

        return ask

    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, "flaky"), (4, None)], "i int, prompt string")
    got = {r.i: (r.raw, r.error) for r in models.generated(df, client, wait=0.0).collect()}
    assert got == {1: ("A", None), 2: (None, "TimeoutError: slow"), 3: ("FLAKY", None), 4: (None, "no prompt")}
    row = models.throughput(models.generated(df, client, wait=0.0)).first()
    assert row.n == 4 and row.rows_per_s > 0
    vectors_ = models.embedded(df, lambda: lambda texts: [[float(len(t))] for t in texts], "prompt", batch=2)
    assert {r.i: r.v for r in vectors_.collect()} == {1: [1.0], 2: [3.0], 3: [5.0], 4: None}
    sizes = [len(r.prompt) for r in models.by_length(df.where("prompt IS NOT NULL"), "prompt", 2).collect()]
    assert sizes == [5, 3, 1]


def test_percent_and_sign(spark):
    row = spark.range(1).select(columns.percent(F.lit(1), F.lit(8)).alias("p"), columns.percent(F.lit(1), F.lit(0)).alias("q"), columns.signed(F.lit(0.25)).alias("s"), columns.signed(F.lit(-1.0), 1).alias("t")).first()
    assert tuple(row) == (" 12.5%", "  --  ", "+0.250", "-1.0")


def test_stream_keeps_the_first_row_of_each_key(spark, tmp_path):
    q = incremental.first_of_key(incremental.event_stream(spark, SF), ["user_id", "event_type"], "ts", "3650 days")
    q.writeStream.format("memory").queryName("firsts").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    keys = spark.read.parquet(f"{SF}/events.parquet").select("user_id", "event_type").distinct()
    assert spark.table("firsts").count() == keys.count()


def test_running_sums_over_ranges(spark):
    rng = np.random.default_rng(2)
    values = rng.permutation(500).tolist()
    df = spark.createDataFrame([(float(v), int(v) % 7) for v in values], "x double, n long").repartition(5)
    for r in working.running_sums(df, "x", {"n": "before"}).collect():
        assert r.before == sum(v % 7 for v in range(int(r.x)))


@pytest.mark.parametrize("top_k", [1, 4])
def test_derived_panels_equal_a_plain_version(spark, top_k):
    rng = np.random.default_rng(8)
    rows = [(f"c{c}", i, f"t{min(i % 9, 3)}", round(float(rng.random()), 2)) for c in range(5) for i in range(120) if rng.random() < 0.8]
    got = {(r.anchor, r.partner): (r.via, r["round"]) for r in geometry.derived_panels(spark.createDataFrame(rows, "via string, chunk long, tradition string, score double"), 0.4, top_k).collect()}
    lists, trad = {}, {}
    for via, chunk, t, score in rows:
        trad[chunk] = t
        if score >= 0.4:
            lists.setdefault(via, []).append((-score, chunk))
    order = {v: [c for _, c in sorted(x)] for v, x in lists.items()}
    want = {}
    for anchor in trad:
        mine = [v for v in sorted(order) if anchor in order[v]]
        found, k = {}, 0
        while len(found) < 2 * top_k and any(k < len(order[v]) for v in mine):
            for v in mine:
                if k < len(order[v]) and trad[order[v][k]] != trad[anchor]:
                    found.setdefault(order[v][k], (v, k + 1))
            k += 1
        want |= {(anchor, p): x for p, x in found.items()}
    assert got == want


def test_hybrid_equals_brute_force(spark):
    vs, labels, sims = _parts(spark)
    key = lambda r: "|".join(sorted((vs[r.a].tradition, vs[r.b].tradition)))
    t = Tables(spark, SF)
    sure = {(r.a, r.b) for r in vectors.unordered(vectors.neighbours(t.vectors, 3)).collect()}
    quotas = {r.block: r.quota for r in vectors.allocate(vectors.tradition_weights(t.vectors, t.vector_labels), 1000, 10).collect()}
    blocks = {}
    for r in sims:
        if (r.a, r.b) not in sure:
            blocks.setdefault(key(r), []).append(r)
    want = set(sure)
    for k, rows in blocks.items():
        want |= _fill(rows, lambda r, k=k: k, {k: quotas[k]}, 3)
    assert {(r.a, r.b) for r in QUERIES["select_hybrid"](spark, SF).collect()} == want


def test_fill_goes_on_until_quotas_are_met(spark, monkeypatch):
    # a hub that all the most similar pairs share is used up by the cap at once
    monkeypatch.setattr(vectors, "POOL", 1)
    rng = np.random.default_rng(1)
    v = rng.normal(size=(80, 6))
    v[:40, 0] += 4
    v[40] = [9, 0, 0, 0, 0, 0]
    df = spark.createDataFrame([(i, f"t{i // 40}", v[i].tolist()) for i in range(80)], "vec_id long, tradition string, v array<double>")
    quotas = spark.createDataFrame([("t0|t1", 20)], "block string, quota int")
    rows = vectors.all_pairs(df).collect()
    want = _fill(rows, lambda r: "t0|t1", {"t0|t1": 20}, 1)
    assert len(want) == 20
    for most in (200_000, 0):
        monkeypatch.setattr(vectors, "MOST_BLOCKS", most)
        assert {(r.a, r.b) for r in vectors.fill_from(df, "tradition", quotas, 1).collect()} == want


def test_log_has_each_row_once_over_restarts(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"r{i}") for i in range(20)], "id long, raw string")
    for k in range(2):
        rows.where(f"id % 2 = {k}").write.mode("append").parquet(str(tmp_path / "in"))
        for _ in range(2):
            stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
            incremental.append_stream(stream, str(tmp_path / "log"), str(tmp_path / "check")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "log")).count() == 10 * (k + 1)


def test_verdicts_without_an_order_come_first(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x", None), (1, "y", -5), (2, "z", None)], "id long, verdict string, at long")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = incremental.last_verdicts(stream, "id", "verdict", "at").writeStream.format("memory").queryName("unordered").outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.id: r.verdict for r in spark.table("unordered").collect()} == {1: "y", 2: "z"}


def test_containments_equal_a_plain_version(spark):
    rng = np.random.default_rng(9)
    words = "a bb ccc dd e\nf".split(" ")
    texts = [" ".join(rng.choice(words, int(rng.integers(0, 40))).tolist()) for _ in range(60)]
    items = [" ".join(rng.choice(words, int(rng.integers(1, 12))).tolist()) for _ in range(40)] + [t[3:40] for t in texts[:20]] + ["", "zz"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "doc_id long, text string")
    got = {r.item_id: r.n_leaks for r in tagging.containments(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    assert got == {k: sum(x in t for t in texts) for k, x in enumerate(items)}
