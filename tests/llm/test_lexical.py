"""Ranked lexical search against a plain version of its definition, and against SQL."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagmill.llm import lexical
from tagmill.llm.common import forget
from tests.compare import canonical, connect

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string"


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _plain(docs, items, k=10):
    """By the definition: every item against every document."""
    counts = [(d, Counter(_terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        found = []
        for d, c in counts:
            m, score = 25 + 75 * sum(c.values()) * n_docs // n_terms, 0
            for t in _terms(text):
                if t in c:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, d is None, d or 0, d, score))
        out += [(item, r, d, s) for r, (_, _, _, d, s) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def _ours(index, items, **more):
    return sorted([tuple(r) for r in lexical.search(index, items, **more).collect()], key=str)


def test_op11_equals_its_sql(spark):
    from tagmill.llm.queries import oracle_sql, queries

    ours = queries()["op11_lexical_search"](spark, SF).toPandas()
    assert canonical(ours).equals(canonical(connect(SF).execute(oracle_sql()["op11_lexical_search"]).df()))


@pytest.mark.parametrize("shard_bytes, batch_bytes", [(12_000_000, 1 << 20), (40, 30)])
def test_search_equals_a_plain_version(spark, monkeypatch, shard_bytes, batch_bytes):
    """Also with many shards of few texts and many batches of few items."""
    monkeypatch.setattr(lexical, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(lexical, "BATCH_BYTES", batch_bytes)
    monkeypatch.setattr(lexical, "_AT_ONCE", 5)
    rng = np.random.default_rng(3)
    words = "Ab ab a1 b2 é É 日本 x-y z_z o'clock THE the".split()
    docs = [(int(i), " ".join(rng.choice(words, rng.integers(0, 12)))) for i in rng.permutation(60)] + [(None, "ab the"), (None, None), (7, ""), (7, " ,;")]
    docs += [docs[0], docs[0]]
    items = [(int(i), " ".join(rng.choice(words, rng.integers(0, 6)))) for i in range(12)] + [(3, "the the é"), (3, "the the é"), (None, "AB"), (99, None), (98, "nowhere")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("key", F.lit(None)).repartition(3)
    index = lexical.build_index(df)
    assert _ours(index, spark.createDataFrame(items, ITEMS)) == _plain(docs, items)
    assert _ours(index, spark.createDataFrame(items, ITEMS), k=2) == _plain(docs, items, k=2)
    forget(index.shards)


def test_search_over_odd_rows(spark, odd_rows, no_rows):
    docs = [(r.doc_id, r.text) for r in odd_rows.collect()]
    items = [(1, "one"), (2, "word b C"), (3, "日本"), (4, "x" * 20_000), (5, " \n")]
    asked = spark.createDataFrame(items, ITEMS)
    index = lexical.build_index(odd_rows)
    assert _ours(index, asked) == _plain(docs, items)
    assert _ours(index, asked.limit(0)) == []
    empty = lexical.build_index(no_rows)
    assert (empty.documents, empty.terms) == (0, 0) and _ours(empty, asked) == []
    renamed = lexical.search(index, asked.withColumnRenamed("item_id", "rank"), key="rank")
    assert renamed.columns == ["_rank", "rank", "doc_id", "score"]


def test_a_very_long_text_is_a_shard_of_its_own(spark):
    text = "lorem ipsum Dolor " * 150_000
    docs = [(1, text), (2, "dolor"), (3, None)]
    index = lexical.build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    items = [(1, "dolor sit"), (2, "lorem")]
    assert _ours(index, spark.createDataFrame(items, ITEMS)) == _plain(docs, items)


def test_terms_that_one_hash_confuses_are_told_apart(monkeypatch):
    real = lexical.hashes_of
    monkeypatch.setattr(lexical, "hashes_of", lambda d, s, e, lane=0: real(d, s, e, lane) if lane else np.zeros(len(s), np.uint64))
    raw = np.frombuffer(b"aa bb aa cc bb", np.uint8)
    starts, ends, _ = lexical.term_spans(raw, np.array([0, len(raw)]))
    first, back = lexical.dictionary(raw, starts, ends)
    words = [bytes(raw[starts[i] : ends[i]]) for i in first]
    assert sorted(words) == [b"aa", b"bb", b"cc"]
    assert [words[b] for b in back] == [b"aa", b"bb", b"aa", b"cc", b"bb"]
    wanted = lexical._Terms(["cc dd aa"])
    terms, rows = wanted.places(b"".join(words), np.array([2, 2, 2]))
    assert sorted((wanted.words[t], words[r]) for t, r in zip(terms, rows)) == [(b"aa", b"aa"), (b"cc", b"cc")]


def test_best_cuts_ties_by_id():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(0, 30))
        scores, ids, known = rng.integers(0, 4, n), rng.integers(0, 9, n), rng.random(n) < 0.8
        k = int(rng.integers(1, 8))
        want = sorted((i for i in range(n) if scores[i] > 0), key=lambda i: (-scores[i], not known[i], ids[i]))[:k]
        got = lexical.best(scores, ids, known, k).tolist()
        rank = lambda i: (scores[i], known[i], ids[i])
        assert [rank(i) for i in got] == [rank(i) for i in want]


def test_impacts_beyond_64_bits_stay_exact():
    lengths = np.array([10**9, 3], np.int64)
    got = lexical.impacts_of(np.array([5, 1]), np.array([0, 1]), lengths, 10**12, 10**15)
    want = [1_000_000_000 * tf // (1000 * tf + 8 * (25 + 75 * n * 10**12 // 10**15)) for tf, n in ((5, 10**9), (1, 3))]
    assert got.tolist() == want


def test_every_shard_is_searched_in_blocks_of_items(spark, monkeypatch):
    """The number of passes follows the items' bytes."""
    monkeypatch.setattr(lexical, "BATCH_BYTES", 64)
    passes = []
    real = lexical._frequencies
    monkeypatch.setattr(lexical, "_frequencies", lambda index, wanted: passes.append(len(wanted.items)) or real(index, wanted))
    docs = [(i, f"w{i} shared") for i in range(20)]
    items = [(i, f"w{i} and shared") for i in range(20)]
    index = lexical.build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    got = defaultdict(list)
    for item, rank, doc, _ in _ours(index, spark.createDataFrame(items, ITEMS)):
        got[item].append((rank, doc))
    assert all(min(got[i])[1] == i for i in range(20))
    assert len(passes) == 5 and sum(passes) == 20
