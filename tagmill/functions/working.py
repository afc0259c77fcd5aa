"""Working tables in the folder that the cluster shares, and sums over an order without a task that sees all rows."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` written to spark.checkpoint.dir and read from there; where that is unset, to a folder of our own."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            local = context.master.startswith("local")
            base = "file://" + tempfile.mkdtemp(prefix="tagmill-") if local else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/tagmill-work"
        context.setCheckpointDir(base)
    return df.checkpoint()


def running_sums(rows: DataFrame, order: str, sums: dict[str, str]) -> DataFrame:
    """`rows`, of distinct values of `order`, with the sum of columns over all rows before each one; sums: new name by column."""
    return sums_within(rows, [], [F.col(order)], sums)


def sums_within(rows: DataFrame, keys: list[str], order: list[Column], sums: dict[str, str]) -> DataFrame:
    """`rows` with the sum of columns over the rows of the same keys that come before each one; sums: new name by column.

    One key may hold all rows: rows are dealt by ranges of keys and order, each range is summed by itself, and
    starts from the sums of its key's earlier ranges, which come to it as a row of their own. No task sees more
    than a range of rows, or a row for each range of one key. Null keys are keys; a null to be summed adds
    nothing; rows that are equal in keys and order share a range and follow each other in any order.
    """
    dealt = checkpointed(rows.repartitionByRange(*[F.col(k) for k in keys], *order).withColumn("range_", F.spark_partition_id()))
    earlier = Window.partitionBy(*keys or [F.lit(0)]).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*keys, "range_").agg(*[F.sum(c).alias(f"{c}_") for c in sums])
    starts = totals.select(*keys, "range_", F.lit(0).alias("row_"), *[F.coalesce(F.sum(f"{c}_").over(earlier), F.lit(0)).alias(f"{c}_") for c in sums])
    both = dealt.withColumns({"row_": F.lit(1)} | {f"{c}_": F.col(c) for c in sums}).unionByName(starts, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "range_").orderBy("row_", *order).rowsBetween(Window.unboundedPreceding, -1)
    out = both.withColumns({name: F.sum(f"{c}_").over(inside) for c, name in sums.items()})
    return out.where("row_ = 1").drop("range_", "row_", *[f"{c}_" for c in sums])


def places_within(rows: DataFrame, keys: list[str], order: list[Column], place: str) -> DataFrame:
    """`rows` with their place, from 1, among the rows of the same keys; a key may hold all rows."""
    placed = sums_within(rows.withColumn("one_", F.lit(1)), keys, order, {"one_": place})
    return placed.withColumn(place, F.col(place) + 1).drop("one_")
