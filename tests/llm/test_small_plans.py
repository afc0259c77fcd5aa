"""Plans stay small, as the driver holds them: what two parts of a plan read is a table, not a plan in each of them."""

from __future__ import annotations

from tagmill.llm import near_dedup, quality


def _counted(module, monkeypatch) -> list[tuple[str, int, int]]:
    """Name, aggregates and exchanges of the plan of each table that the module's code stores from now on."""
    seen, plain = [], module.stored

    def stored(df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        seen.append((name, plan.count("Aggregate("), plan.count("Exchange ")))
        return plain(df, name)

    monkeypatch.setattr(module, "stored", stored)
    return seen


def test_pairs_are_joined_with_both_sides_without_counting_again(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[i % 3 :])) for i in range(12)] + [(3, " ".join(words))]
    seen = _counted(near_dedup, monkeypatch)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0} and len(got) == 13
    joined = [x for x in seen if x[0] in ("pairs", "verified")]
    assert len(joined) >= 3
    # the last comparison has six of its own; before, the pairs of the estimates had 18
    assert max(a for _, a, _ in joined) <= 6, joined


def test_the_model_is_a_union_of_tables(spark, monkeypatch):
    texts = spark.createDataFrame([("some text of words",), ("other words of a text",)], "text string")
    seen = _counted(quality, monkeypatch)
    model = quality.train(texts)
    assert model.where("p IS NOT NULL").groupBy("order").count().count() == 6
    assert [(a, e) for name, a, e in seen if name == "model"] == [(0, 0)]
