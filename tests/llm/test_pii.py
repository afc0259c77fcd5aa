"""Personal data: base spans against Python's regular expressions, learning on planted votes, odd and very long texts."""

from __future__ import annotations

import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagmill.llm import pii

SF = "/root/testdata/sf0.001"
RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _passes(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def _plain(text):
    """Base spans by the definition."""
    out = [(m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(RULES.items()) for m in re.finditer(p, text or "") if _passes(kind, m.group())]
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def _base(row):
    return [(s.kind, s.start, s.end) for s in row.spans if s.base]


def _frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def _found(spark, texts):
    """Base spans of texts, and all spans as texts by kind."""
    rows = pii.find_pii(_frame(spark, texts)).orderBy("doc_id").collect()
    return rows, [[(s.kind, r.text[s.start : s.end]) for s in r.spans] for r in rows]


def test_op13_equals_the_rules_and_keeps_them(spark):
    from tagmill.llm.queries import queries

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries()["op13_pii_spans"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        want = _plain(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in want) for kind in RULES]
        told = [f"{k}:{a}:{b}" for k, a, b in want]
        assert r.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert set(told) <= set(filter(None, r.spans.split(",")))
        # of these tables only quoted tokens are personal data besides
        added = [s.split(":") for s in r.spans.split(",") if s and s not in told]
        secrets = [m.span(1) for m in re.finditer(r'(?i)token = "([0-9a-f]+)"', texts[r.doc_id] or "")]
        assert [(int(a), int(b)) for _, a, b in added] == secrets and all(k == "secret" for k, _, _ in added)


@pytest.mark.parametrize("alphabet", ["a@.-", "a1.@_+", "12.5", "0123456789 -", "+1 ().-2", "aé😀@.1 ", "+14 1-.@a"])
def test_base_spans_equal_the_rules_on_random_texts(spark, alphabet):
    rng = random.Random(alphabet)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    if alphabet == "0123456789 -":  # random digits seldom pass
        texts += [f"{4 * 10**15 + i}"[: rng.randint(14, 16)] + rng.choice(["", " 1", "-12", "x"]) for i in range(500)]
    for r in _found(spark, texts)[0]:
        assert _base(r) == _plain(r.text), r.text


def test_odd_rows(spark, odd_rows, no_rows):
    out = pii.find_pii(odd_rows)
    assert out.columns == [*odd_rows.columns, "spans"]
    assert [r.spans for r in out.collect()] == [[]] * odd_rows.count()
    assert pii.find_pii(no_rows).count() == 0
    named = odd_rows.withColumn("spans", F.lit("mine")).withColumn("candidates", F.lit(1)).withColumn("t", F.lit(2)).withColumn("of_ip", F.lit(3))
    rows = pii.find_pii(named.withColumn("text", F.lit("at a@b.de"))).collect()
    assert {(r.spans, r.candidates, r.t, r.of_ip) for r in rows} == {("mine", 1, 2, 3)}
    assert all([s.kind for s in r["_spans"]] == ["email"] for r in rows)


def test_added_spans_follow_their_evidence(spark):
    hexes = ["".join(random.Random(i).choices("0123456789abcdef", k=40)) for i in range(8)]
    texts = [f'log in with token = "{h}" today' for h in hexes] + [
        "pay to IBAN DE89 3704 0044 0532 0130 00 now",
        "our plan XX12 3456 7890 1234 is old",
        "write to jane.doe [at] mail [dot] com please",
        "ask Dr. Maria Lopez about it",
        "Sr. Casa de la",
        "card number 4111 1111 1111 1112",
        "version 2024-01-15 12 of 1234567890123",
        "some-long-hyphenated-compound-word-2 here",
        "phone: 555-123-4567",
    ]
    rows, found = _found(spark, texts)
    assert [f for f in found[:8]] == [[("secret", h)] for h in hexes]
    assert found[8] == [("account", "DE89 3704 0044 0532 0130 00")]
    assert found[9] == [] and found[12] == [] and found[14] == [] and found[15] == []
    assert found[10] == [("email", "jane.doe [at] mail [dot] com")]
    assert found[11] == [("person", "Dr. Maria Lopez")]
    assert found[16] == [("phone", "555-123-4567")]
    assert all(not s.base and s.score >= pii.THRESHOLD for r in rows for s in r.spans)


def test_added_spans_overlap_no_base_span(spark):
    texts = ["+1 (499) 555-6503", "mail some-long-name-with-1-in-it@example.com", "10.20.30.40 123456789012 +4 4111 1111 1111 1111"]
    for r in _found(spark, texts)[0]:
        assert _base(r) == _plain(r.text)
        own = [s for s in r.spans if not s.base]
        assert not any(s.start < b.end and b.start < s.end for s in own for b in r.spans if b is not s)


def test_running_values_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(pii, "STEP", 4)
    rng = random.Random(4)
    lists = [[rng.randint(-9, 9) for _ in range(n)] for n in (0, 1, 3, 4, 5, 8, 17, 40)]
    df = spark.createDataFrame([(x,) for x in lists], "v array<bigint>")
    for out, merge, least in (("s", lambda a, b: a + b, 0), ("g", F.greatest, -100)):
        for stage in pii._running("v", out, merge, least):
            df = df.withColumns(stage)
    for r in df.collect():
        assert r.s == np.cumsum(r.v).tolist()
        assert r.g == (np.maximum.accumulate(r.v).tolist() if r.v else [])


def _planted(n=4000, seed=0):
    """Votes of labelers of known reliability on known truths, and all other factors at random."""
    rng = np.random.default_rng(seed)
    truth = rng.random(n) < 0.4
    good, bad = np.array([0.02, 0.18, 0.8]), np.array([0.7, 0.25, 0.05])
    counts, truths = {}, {}
    for y in truth.tolist():
        levels = [0, *rng.choice(3, 3, p=good if y else bad).tolist(), *rng.choice(3, 2, p=[0.2, 0.6, 0.2]).tolist(), *rng.integers(0, 3, 3).tolist()]
        code = 0
        for size, level in zip(pii.FACTORS, levels):
            code = code * size + level
        counts[code] = counts.get(code, 0) + 1
        truths.setdefault(code, []).append(y)
    return counts, truths


def test_estimates_find_reliabilities_and_truths():
    counts, truths = _planted()
    theta, prior, posterior = pii.estimate(counts)
    assert abs(prior[0] - 0.4) < 0.05
    for j in range(3):
        assert np.abs(theta[j, 0, 1] - [0.02, 0.18, 0.8]).max() < 0.06
        assert np.abs(theta[j, 0, 0] - [0.7, 0.25, 0.05]).max() < 0.06
    # the last two vote alike on both
    assert np.abs(theta[3, 0, 1] - theta[3, 0, 0]).max() < 0.08
    right = sum((posterior[c] >= 0.5) == y for c, ys in truths.items() for y in ys)
    assert right > 0.97 * 4000
    weights, bias = pii.fit(counts, posterior)
    for c, p in posterior.items():
        x = bias + sum(w[level] for w, level in zip(weights, pii.levels_of(c)))
        assert abs(1 / (1 + np.exp(-x)) - p) < 0.35
    told = sum((bias + sum(w[v] for w, v in zip(weights, pii.levels_of(c))) >= 0) == y for c, ys in truths.items() for y in ys)
    assert told > 0.96 * 4000


def test_learning_from_nothing():
    theta, prior, posterior = pii.estimate({})
    assert posterior == {} and (prior == 0.25).all() and np.allclose(theta.sum(-1), 1)
    weights, bias = pii.fit({}, {})
    assert bias == 0 and not any(map(any, weights))


def test_very_long_texts_take_seconds(spark):
    """Runs on which careless patterns go back and forth, recurse or copy what they have again and again."""
    texts = [
        "a@b" + ".c" * 500_000,
        "a" * 1_000_000,
        "a@" * 400_000,
        "1" * 1_000_000,
        "1.2." * 250_000,
        "+1" + "(" * 1_000_000,
        "+1 " * 300_000,
        "1 2-" * 250_000,
        "me@example.com " * 60_000,
        "0" * 500_000 + "1.2.3.4",
        ("x" * 15 + " ") * 60_000,
    ]
    began = time.time()
    rows = pii.find_pii(_frame(spark, texts)).select("doc_id", F.filter("spans", lambda x: x.base).alias("spans")).orderBy("doc_id").collect()
    assert time.time() - began < 240
    assert [len(r.spans) for r in rows] == [1, 0, 0, 0, 125_000, 0, 0, 0, 60_000, 1, 0]
    assert rows[8].spans[-1].asDict() | {"score": 0} == {"kind": "email", "start": 15 * 59_999, "end": 15 * 59_999 + 14, "base": True, "score": 0}
    assert (rows[0].spans[0].start, rows[0].spans[0].end) == (0, len(texts[0]))


def test_the_plan_holds_no_python(spark):
    plan = pii.find_pii(_frame(spark, ["a@b.de"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan.split("Scan")[0])
    assert "Exchange" not in plan
