"""Calls of models: rates, repetitions, errors that are kept, pair scores that are cached."""

from __future__ import annotations

import hashlib
import math
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagmill.sources import models
from tagmill.streaming import incremental


class Clock:
    """A time that passes only while someone sleeps."""

    def __init__(self):
        self.now, self.slept = 0.0, []

    def __call__(self):
        return self.now

    def sleep(self, seconds):
        self.slept.append(seconds)
        self.now += seconds


@pytest.mark.parametrize("rate, burst", [(10, 1), (3, 5), (0.5, 2)])
def test_permits_never_exceed_the_rate(rate, burst):
    clock, rng, given = Clock(), random.Random(2), []
    bucket = models.TokenBucket(rate, burst, clock, clock.sleep)
    for _ in range(300):
        bucket.take()
        given.append(clock.now)
        clock.now += rng.choice([0, 0, 0.01, 1.5])
    for i, a in enumerate(given):
        for j in range(i, len(given)):
            assert j - i + 1 <= burst + rate * (given[j] - a) + 1e-6
    # and are not held back without need
    clock = Clock()
    bucket = models.TokenBucket(rate, burst, clock, clock.sleep)
    for _ in range(100):
        bucket.take()
    assert clock.now == pytest.approx((100 - burst) / rate)


def test_repetitions_wait_longer_and_longer_and_take_permits():
    clock, calls = Clock(), []

    class Busy(Exception):
        retry_after = 60

    def fails(kind):
        calls.append(clock.now)
        raise kind("no")

    permits = models.TokenBucket(1000, 3, clock, clock.sleep)
    assert models.patiently(lambda: fails(ValueError), 3, 2.0, permits, clock.sleep) == (None, "ValueError: no")
    waits = [s for s in clock.slept if s > 0.5]
    assert len(calls) == 4 and len(waits) == 3
    assert all(0.5 * 2 * k <= w <= 1.5 * 2 * k for k, w in enumerate(waits, 1))
    clock.slept.clear()
    assert models.patiently(lambda: fails(Busy), 1, 2.0, None, clock.sleep) == (None, "Busy: no")
    assert clock.slept == [60]
    answers = iter([ValueError, None])

    def second():
        if (e := next(answers)) is not None:
            raise e("once")
        return "yes"

    assert models.patiently(second, 1, 0.0, None, clock.sleep) == ("yes", None)


def test_all_tasks_together_keep_the_rate_and_lose_no_row(spark):
    def client():
        def ask(text):
            if text == "bad":
                raise ValueError("bad")
            return str(time.time())

        return ask

    rows = [(i, f"p{i}" if i != 5 else "bad", 2**60 + i if i % 2 else None) for i in range(48)] + [(99, None, 1)]
    df = spark.createDataFrame(rows, "i int, prompt string, big long")
    got = models.generated(df, client, retries=1, wait=0.0, parallel=4, rate=40, burst=2).collect()
    assert sorted((r.i, r.prompt, r.big) for r in got) == sorted(rows)
    assert {r.i: r.error for r in got if r.error} == {5: "ValueError: bad", 99: "no prompt"}
    times = sorted(float(r.raw) for r in got if r.raw)
    for i in range(len(times)):
        for j in range(i, len(times)):
            # each of 4 tasks may start with 2
            assert j - i + 1 <= 8 + 40 * (times[j] - times[i]) + 1.0


def test_embeddings_keep_errors_and_halve_failing_batches(spark, tmp_path):
    log = str(tmp_path / "calls")

    def client():
        def embed(texts):
            with open(log, "a") as f:
                f.write(f"{len(texts)}\n")
            if any(t.startswith("bad") for t in texts):
                raise RuntimeError("cannot")
            return [np.float32([len(t), 1]) for t in texts] if "short" not in texts else [[1.0]]

        return embed

    texts = [f"t{'x' * i}" for i in range(30)] + ["bad one", None, "short", "bad two"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1)
    got = {r.i: r for r in models.embedded(df, client, batch=8, retries=1, wait=0.0).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        if t is None:
            assert got[i].v is None and got[i].v_error is None
        elif t.startswith("bad"):
            assert got[i].v is None and got[i].v_error == "RuntimeError: cannot"
        else:
            assert got[i].v == ([1.0] if t == "short" else [float(len(t)), 1.0]) and got[i].v_error is None
    sizes = [int(x) for x in open(log)]
    assert max(sizes) == 8 and sizes.count(1) >= 3
    wrong = models.embedded(df.limit(1), lambda: lambda texts: [], retries=0).first()
    assert wrong.v is None and wrong.v_error == "ValueError: 0 vectors for 1 texts"


def _scorer(log, fail_at=None):
    """A model whose openings and calls are written down; fails at a pair of the given query."""

    def open_model():
        with open(f"{log}.opened", "a") as f:
            f.write(f"{os.getpid()}\n")

        def score(pairs):
            with open(f"{log}.calls", "a") as f:
                longest = max(len(a) + len(b) for a, b in pairs)
                f.write(f"{len(pairs)} {longest} {sum(len(a) + len(b) for a, b in pairs)}\n")
            if any(a == fail_at for a, _ in pairs):
                raise RuntimeError("interrupted")
            return [_plain(a, b) for a, b in pairs]

        return score

    return open_model


def _plain(a, b):
    return len(set(a) & set(b)) - 0.01 * len(b)


def _lines(path):
    return [tuple(map(int, x.split())) for x in open(path)] if os.path.exists(path) else []


def test_pair_scores_equal_a_plain_loop_with_little_padding(spark, tmp_path):
    rng, log = random.Random(1), str(tmp_path / "log")
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    rows = [(i, word(rng.randint(0, 20)), word(int(10 ** rng.uniform(0, 3.5)))) for i in range(400)]
    rows += [(400, None, "x"), (401, "x", None), (402, "", ""), (403, "q", "y" * 9000), (404, "q", "y" * 9000)]
    df = spark.createDataFrame(rows, "i int, query string, body string")
    how = {"name": "plain", "batch": 32, "padded": 6000, "parts": 4}
    got = {r.i: r.score for _ in range(2) for r in models.scored_pairs(df, _scorer(log), **how).collect()}
    for i, a, b in rows:
        assert got[i] == (None if a is None or b is None else pytest.approx(_plain(a, b)))
    opened, calls = _lines(f"{log}.opened"), _lines(f"{log}.calls")
    assert len(opened) == len(set(opened))  # once for each worker, over two jobs of four tasks each
    assert all(n <= 32 and (n == 1 or n * longest <= 6000) for n, longest, _ in calls)
    assert sum(total for _, _, total in calls) / sum(n * longest for n, longest, _ in calls) > 0.8
    assert df.limit(0).count() == 0 and models.scored_pairs(df.limit(0), _scorer(log), name="none").count() == 0


def test_scores_that_are_no_number_are_no_nulls(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "query string, body string")
    got = models.scored_pairs(df, lambda: lambda pairs: [math.nan] * len(pairs), name="nan").collect()
    assert math.isnan(got[0].score) and got[1].score is None


def test_batches_by_length():
    lengths = np.array([5, 1, 50, 2, 2, 0, 7])
    got = [lengths[b].tolist() for b in models.length_batches(lengths, 3, 14)]
    assert got == [[50], [7, 5], [2, 2, 1], [0]]
    assert list(models.length_batches(np.empty(0, np.int64), 3, 14)) == []


def test_an_interrupted_run_scores_only_the_rest(spark, tmp_path):
    cache, rows = str(tmp_path / "cache"), [(f"query {i % 9}", f"c{i}", f"body {i}") for i in range(40)]
    df = spark.createDataFrame([*rows, rows[0]], "query string, chunk_id string, body string")
    key = lambda q: hashlib.sha256(q.encode()).hexdigest()[:16]
    assert {r.qh for r in models.pair_keys(df).collect()} == {key(q) for q, _, _ in rows}
    done = 0
    for attempt, stop in enumerate(("query 3", "query 5", None)):
        log = str(tmp_path / f"log{attempt}")
        try:
            incremental.score_pairs(df, cache, _scorer(log, stop), slices=6, name=f"run {attempt}")
            assert stop is None
        except Exception as e:
            assert stop and "interrupted" in str(e)
        before, done = done, spark.read.parquet(cache).count() if os.path.exists(cache) else 0
        if stop is None:
            assert sum(n for n, _, _ in _lines(f"{log}.calls")) == len(rows) - before
    scored = spark.read.parquet(cache).collect()
    assert sorted((r.qh, r.chunk_id, round(r.teacher_logit, 6)) for r in scored) == sorted((key(q), c, round(_plain(q, b), 6)) for q, c, b in rows)
    log = str(tmp_path / "again")
    incremental.score_pairs(df, cache, _scorer(log), slices=6, name="again")
    assert _lines(f"{log}.calls") == [] and spark.read.parquet(cache).count() == len(rows)
    joined = models.pair_keys(df.distinct()).join(spark.read.parquet(cache), ["qh", "chunk_id"])
    assert joined.agg(F.count("*")).first()[0] == len(rows)
