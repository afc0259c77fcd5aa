"""The quality model sees its whole fold of the trusted texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagmill.llm import quality


def test_the_model_is_fitted_on_the_whole_fold(spark, monkeypatch):
    monkeypatch.setattr(quality, "TRAIN_TEXTS", 4)
    docs = spark.range(120).select(F.col("id").alias("doc_id"), F.concat(F.lit("some text with number "), F.col("id").cast("string"), F.lit(" in words")).alias("text"), F.lit("en").alias("lang"))
    fold = docs.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(12)) < 4)
    fitted, plain = [], quality.train
    monkeypatch.setattr(quality, "train", lambda texts, *a: fitted.append(texts.count()) or plain(texts, *a))
    assert quality.assess(docs, docs.select("doc_id")).count() == 120
    assert fitted == [fold.count()] and fitted[0] > quality.TRAIN_TEXTS
