"""Scores of predictions against teachers and people."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.functions.columns import f1, precision, ratio, recall, rounded

_T, _M = "teacher_score >= 1", "model_score >= 1"


def outcome_counts() -> list[Column]:
    """tp, fn, fp, and fp outside the taxonomy, of cells."""
    return [
        F.count_if(F.expr(f"{_T} AND {_M}")).alias("tp"),
        F.count_if(F.expr(f"{_T} AND NOT {_M}")).alias("fn"),
        F.count_if(F.expr(f"NOT ({_T}) AND {_M}")).alias("fp"),
        F.count_if(F.expr(f"NOT ({_T}) AND {_M} AND in_taxonomy = 0")).alias("oot"),
    ]


def prf_columns(df: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return df.withColumns({"precision": rounded(precision(tp, fp)), "recall": rounded(recall(tp, fn)), "f1": rounded(f1(tp, fp, fn))})


def bench_cells(teacher: DataFrame, predicted: DataFrame, concepts: DataFrame) -> DataFrame:
    """Teacher and predicted scores side by side where either is 1 or more; a missing one is 0."""
    keys = ["model", "chunk_id", "concept_id"]
    both = teacher.join(predicted, keys, "full").na.fill(0, ["teacher_score", "model_score"]).na.fill("", ["human_status"])
    known = F.broadcast(concepts.select("concept_id", F.lit(1).alias("in_taxonomy")))
    return both.where(f"{_T} OR {_M}").join(known, "concept_id", "left").na.fill(0, ["in_taxonomy"])


def model_summary(cells: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """tp, fp, fn, oot, precision, recall, f1, and the mean error of scores over true positives."""
    error = F.avg(F.when(F.expr(f"{_T} AND {_M}"), F.abs(F.col("teacher_score") - F.col("model_score"))))
    out = cells.groupBy(*by).agg(*outcome_counts(), rounded(error).alias("mae"), F.countDistinct("chunk_id").alias("n_chunks"))
    return prf_columns(out)


def concept_f1(cells: DataFrame, by: Sequence[str] = ("model", "concept_id")) -> DataFrame:
    """Counts and f1 of each concept."""
    out = cells.groupBy(*by).agg(*outcome_counts())
    return out.withColumn("f1", f1(F.col("tp"), F.col("fp"), F.col("fn"))).withColumn("positives", F.col("tp") + F.col("fn"))


def macro_f1(cells: DataFrame) -> DataFrame:
    return concept_f1(cells).where("tp + fp + fn > 0").groupBy("model").agg(rounded(F.avg("f1")).alias("macro_f1"), F.count("*").alias("n_concepts"))


def score_confusion(cells: DataFrame) -> DataFrame:
    """Counts of model scores 0 to 3 by model and teacher score."""
    return cells.groupBy("model", "teacher_score").agg(*[F.count_if(F.col("model_score") == s).alias(f"m{s}") for s in range(4)])


def run_summary(runs: DataFrame) -> DataFrame:
    """Parse share of all runs; means over runs with a latency only."""
    timed = F.col("latency_s").isNotNull()
    return runs.groupBy("model").agg(
        F.count("*").alias("n"),
        rounded(100 * F.sum("parse_ok") / F.count("*")).alias("parse_pct"),
        rounded(F.avg("latency_s")).alias("mean_latency"),
        rounded(F.avg(F.when(timed, F.col("n_emitted")))).alias("mean_emitted"),
        F.sum(F.when(timed, (F.col("n_out_of_taxonomy") > 0).cast("int"))).alias("n_oot_chunks"),
    )


def worst_concepts(cells: DataFrame, least: int, k: int = 5) -> DataFrame:
    w = Window.partitionBy("model").orderBy("f1", "concept_id")
    ranked = concept_f1(cells).where(F.col("positives") >= least).withColumn("f1", rounded("f1")).withColumn("place", F.row_number().over(w))
    return ranked.where(F.col("place") <= k).select("model", "place", "concept_id", "f1", "positives")


def human_metrics(cells: DataFrame) -> DataFrame:
    """People's verdicts as truth, by model and split and over all splits."""
    fired, good, bad = F.expr(_M), F.col("human_status") == "accepted", F.col("human_status") == "rejected"
    counts = [
        F.count_if(good & fired).alias("tp"),
        F.count_if(bad & fired).alias("fp"),
        F.count_if(good & ~fired).alias("fn"),
        F.count_if(bad & ~fired).alias("tn"),
    ]
    judged = cells.where(good | bad).na.fill("unknown", ["split"])
    both = judged.groupBy("model", "split").agg(*counts)
    every = both.groupBy("model").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")]).withColumn("split", F.lit("ALL"))
    out = prf_columns(both.unionByName(every))
    return out.withColumn("specificity", rounded(ratio(F.col("tn"), F.col("tn") + F.col("fp"))))


def emission(cells: DataFrame) -> DataFrame:
    """The shares of scores 1, 2 and 3 among what each model, and the teacher once for each cell, gives."""
    teacher = cells.groupBy("chunk_id", "concept_id").agg(F.min_by("teacher_score", "model").alias("score")).withColumn("actor", F.lit("teacher"))
    models = cells.select("chunk_id", "concept_id", F.col("model_score").alias("score"), F.col("model").alias("actor"))
    given = models.unionByName(teacher).where("score >= 1")
    return given.groupBy("actor").agg(F.count("*").alias("n"), *[rounded(F.avg((F.col("score") == s).cast("double"))).alias(f"share{s}") for s in (1, 2, 3)])


def concept_deltas(cells: DataFrame, a: str, b: str, least: int, k: int = 10) -> DataFrame:
    """The k largest gains and k largest losses in f1 from model a to model b, with positives counted in a."""
    per = concept_f1(cells)
    left = per.where(F.col("model") == a).select("concept_id", F.col("f1").alias("f1_a"), F.col("positives").alias("n"))
    right = per.where(F.col("model") == b).select("concept_id", F.col("f1").alias("f1_b"))
    both = left.join(right, "concept_id", "left").na.fill(0.0, ["f1_b"]).where(F.col("n") >= least)
    both = both.withColumn("delta", rounded(F.col("f1_b") - F.col("f1_a")))
    top = both.orderBy(F.desc("delta"), "concept_id").limit(k).withColumn("side", F.lit("gain"))
    low = both.orderBy("delta", "concept_id").limit(k).withColumn("side", F.lit("loss"))
    return top.unionByName(low).withColumns({"f1_a": rounded("f1_a"), "f1_b": rounded("f1_b")})


def probe_recall(probes: DataFrame, predicted: DataFrame) -> DataFrame:
    """How many probes fire, at 1 and at 2 or more, by model and concept and in all; unpredicted probes are silent."""
    grid = probes.join(predicted, ["model", "chunk_id", "concept_id"], "left").na.fill(0, ["model_score"])
    counts = [F.count("*").alias("n"), F.count_if(F.col("model_score") >= 1).alias("fired1"), F.count_if(F.col("model_score") >= 2).alias("fired2")]
    per = grid.groupBy("model", "concept_id").agg(*counts)
    total = per.groupBy("model").agg(*[F.sum(c).alias(c) for c in ("n", "fired1", "fired2")]).withColumn("concept_id", F.lit("TOTAL"))
    return per.unionByName(total)
