"""Agreement, rank and separation statistics as aggregates over DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.functions.columns import rounded
from tagmill.functions.working import running_sums


def kappa(a: Column, b: Column) -> Column:
    """Cohen's kappa of two boolean columns; null where chance agreement is 1."""
    x, y = F.avg(a.cast("double")), F.avg(b.cast("double"))
    chance = x * y + (1 - x) * (1 - y)
    return F.try_divide(F.avg((a == b).cast("double")) - chance, 1 - chance)


def mid_ranks(df: DataFrame, value: str, by: list[str], out: str) -> DataFrame:
    """`df` with the mean rank of each row's value among ties; counts of distinct values first, so ties cost nothing."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("c_"))
    ranked = _before(counts, value, {"c_": "b_"}, by).withColumn(out, F.col("b_") + (F.col("c_") + 1) / 2).drop("c_", "b_")
    return df.join(ranked, [*by, value])


def _before(counts: DataFrame, order: str, sums: dict[str, str], by: list[str]) -> DataFrame:
    """Sums of columns over all rows of a group before each one: a group to a task, or without groups by ranges."""
    if not by:
        return running_sums(counts, order, sums)
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumns({name: F.coalesce(F.sum(c).over(w), F.lit(0)) for c, name in sums.items()})


def auc(df: DataFrame, score: str, positive: str, by: list[str] | None = None, ties: str = "mid") -> DataFrame:
    """Area under the ROC curve; tied scores count a half, or with ties="strict" nothing. Null with one class only."""
    by = by or []
    counts = df.groupBy(*by, score).agg(F.count_if(F.col(positive)).alias("p"), F.count_if(~F.col(positive)).alias("q"))
    below = _before(counts, score, {"q": "below"}, by)
    won = F.col("p") * (F.col("below") + (F.col("q") / 2 if ties == "mid" else F.lit(0)))
    return below.groupBy(*by).agg(rounded(F.try_divide(F.sum(won).cast("double"), (F.sum("p") * F.sum("q")).cast("double"))).alias("auc"), F.sum("p").alias("n_pos"), F.sum("q").alias("n_neg"))


def spearman(df: DataFrame, x: str, y: str, by: list[str] | None = None) -> DataFrame:
    """Correlation of mid-ranks; 0 if either side has no spread."""
    by = by or []
    ranked = mid_ranks(mid_ranks(df, x, by, "rx"), y, by, "ry")
    r = F.coalesce(F.nanvl(F.corr("rx", "ry"), F.lit(0.0)), F.lit(0.0))
    return ranked.groupBy(*by).agg(rounded(r).alias("spearman"), F.count("*").alias("n"))


def separation(df: DataFrame, value: str, positive: str) -> DataFrame:
    """Means and population deviations of a value in both classes, and their distance in pooled deviations."""
    p = F.col(positive)
    out = df.agg(
        F.avg(F.when(p, F.col(value))).alias("mp"),
        F.stddev_pop(F.when(p, F.col(value))).alias("sp"),
        F.avg(F.when(~p, F.col(value))).alias("mq"),
        F.stddev_pop(F.when(~p, F.col(value))).alias("sq"),
    )
    d = F.try_divide(F.col("mp") - F.col("mq"), F.sqrt((F.col("sp") ** 2 + F.col("sq") ** 2) / 2))
    return out.select(*[rounded(c).alias(n) for c, n in (("mp", "mean_pos"), ("sp", "sd_pos"), ("mq", "mean_neg"), ("sq", "sd_neg"))], rounded(d).alias("d"))
