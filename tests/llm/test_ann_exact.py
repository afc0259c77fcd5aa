"""The index on rows that its codes tell badly apart."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagmill.llm import ann


@pytest.mark.parametrize("kind", ["tight clusters", "one far place", "few numbers", "mixed lengths"])
def test_no_true_neighbour_is_missed(spark, kind):
    rng = np.random.default_rng(4)
    n, d = 3000, 16
    v = {
        "tight clusters": lambda: rng.normal(size=(3, d))[rng.integers(0, 3, n)] + 1e-5 * rng.normal(size=(n, d)),
        "one far place": lambda: 1000 + rng.normal(size=(n, d)),
        "few numbers": lambda: rng.integers(0, 2, (n, d)).astype(float) + np.eye(d)[0],
        "mixed lengths": lambda: rng.normal(size=(n, d)) * 10.0 ** rng.integers(-3, 4, (n, 1)),
    }[kind]()
    df = spark.createDataFrame([(i, [float(c) for c in x]) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(3)
    got: dict[int, list] = {}
    for r in ann.search(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, n, 100))
    for i, found in got.items():
        true = np.sqrt(((v - v[i]) ** 2).sum(1))
        true[i] = np.inf
        order = np.lexsort((np.arange(n), np.round(true, 12)))[:10]
        np.testing.assert_allclose([s for _, s in found], true[order], rtol=1e-9)
        if kind != "few numbers":
            assert [j for j, _ in found] == order.tolist()
