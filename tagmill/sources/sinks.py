"""Writers: lines, tables, reports, snapshots with manifests, withheld keys, keyed tables, guards."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmill.sources.files import latest_snapshot
from tagmill.sources.versions import Commit, Overtaken, Versions, write_whole


def stamp(at: datetime | None = None) -> str:
    """A UTC time as a name that sorts by time."""
    return (at or datetime.now(UTC)).astimezone(UTC).strftime("%Y-%m-%dT%H-%M-%SZ")


def stamp_of(at: Column) -> Column:
    """The same of a column of instants."""
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH-mm-ss'Z'")


def write_json_lines(df: DataFrame, path: str) -> None:
    """JSON lines with null fields written and letters kept as they are."""
    df.write.mode("errorifexists").option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """A CSV with a header in each part; a quote inside a value is doubled."""
    df.write.mode("errorifexists").option("sep", sep).option("header", True).option("escape", '"').csv(path)


def write_tsv(df: DataFrame, path: str) -> None:
    write_csv(df, path, "\t")


def write_report(report: DataFrame, path: str) -> None:
    """A report of few rows as one JSON document a line, in one file."""
    report.coalesce(1).write.mode("errorifexists").option("ignoreNullFields", False).json(path)


def markdown(report: DataFrame, most: int = 1000) -> str:
    """A report of at most `most` rows as a Markdown table; a longer one is refused."""
    rows = report.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    cell = lambda x: "" if x is None else str(x).replace("|", "\\|").replace("\n", " ")
    line = lambda cells: "| " + " | ".join(map(cell, cells)) + " |"
    return "\n".join([line(report.columns), "|" + "---|" * len(report.columns), *map(line, rows)]) + "\n"


def write_vectors(vectors: DataFrame, path: str) -> None:
    """chunk_id, layer, pooling, vec as a table partitioned by layer and pooling."""
    vectors.select("chunk_id", "vec", "layer", "pooling").write.mode("errorifexists").partitionBy("layer", "pooling").parquet(path)


def snapshot(tables: dict[str, DataFrame], root: str, label: str | None = None, at: datetime | None = None) -> str:
    """Copy tables to <root>/<stamp>[-label]/<name>, write a manifest of their counts, and commit; the snapshot's name.

    A name that a lost write has used gets "-1" behind it.
    """
    spark = next(iter(tables.values())).sparkSession
    versions = Versions(spark, root)
    versions.begin()
    name, last = stamp(at) + (f"-{label}" if label else ""), versions.latest()
    while versions.taken(name):
        name += "-1"
    path = f"{root.rstrip('/')}/{name}"
    for t, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{path}/{t}")
    counts = [spark.read.schema(df.schema).parquet(f"{path}/{t}").agg(F.count("*").alias("n")).select(F.lit(t).alias("name"), "n") for t, df in tables.items()]
    union = counts[0]
    for c in counts[1:]:
        union = union.union(c)
    row = union.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "n")))).alias("counts"))
    write_report(row.select(F.lit(name).alias("created_at"), "counts"), f"{path}/manifest.json")
    number = last.number + 1 if last else 0
    while True:
        try:
            versions.publish(Commit(number, name, {"0": name}))
            return name
        except Overtaken:  # snapshots do not rest on one another
            number += 1


def keyed_by_snapshot(spark: SparkSession, root: str, cache: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """The table that `compute` makes from the last snapshot under `root`: from the cache if that has this snapshot's.

    A cache whose write was lost has nothing of that snapshot and is made again.
    """
    name, versions = latest_snapshot(spark, root), Versions(spark, cache)
    found = versions.named(name)
    if found is None:
        try:
            found = versions.write(compute(), name)
        except Overtaken:  # by a writer of this or another snapshot
            found = versions.named(name) or versions.write(compute(), name)
    return versions.read(found)


def upsert(spark: SparkSession, root: str, rows: DataFrame, keys: list[str], order: str, at: datetime | None = None, buckets: int = 64) -> DataFrame:
    """Merge rows into a keyed table: of each key the row with the largest `order` stays, of equal ones the new.

    Every merge is a commit under `root`: readers keep their version, a lost write changes nothing, and only the
    buckets of keys that the rows touch are rewritten.
    """

    def name(last: str) -> str:
        wanted = stamp(at)
        return wanted if wanted > last else last + "-1"  # a second merge within one second

    versions = Versions(spark, root)
    return versions.read(versions.merge(rows, keys, order, name, buckets))


def withheld(df: DataFrame, key: list[str], hidden: list[str], shown_path: str, hidden_path: str) -> None:
    """Two outputs of one table: what judges see, and the key columns with the withheld ones."""
    write_json_lines(df.drop(*hidden), shown_path)
    write_json_lines(df.select(*key, *hidden), hidden_path)


def reopen(tags: DataFrame, changed: DataFrame, path: str, backup: str, mark: str, execute: bool = False) -> dict[str, int]:
    """Write a reopened version of the tags: the old one is backed up first, and marked rows are counted after.

    Without `execute` nothing is written. The counts: rows to reopen, and of an executed run pending rows with
    the mark and rows in all.
    """
    is_marked = F.contains(F.coalesce("justification", F.lit("")), F.lit(mark)) & (F.col("status") == "pending")
    out = {"planned": changed.where(is_marked).count() - tags.where(is_marked).count()}
    if execute:
        write_whole(tags, backup)
        write_whole(changed, path)
        row = tags.sparkSession.read.parquet(path).agg(F.count_if(is_marked).alias("marked"), F.count("*").alias("rows")).first()
        out |= row.asDict()
    return out


def guarded(path: str, live: str) -> str:
    """`path`, or an error if it is the live snapshot or lies inside it."""
    a, b = path.rstrip("/") + "/", live.rstrip("/") + "/"
    if a.startswith(b):
        raise ValueError(f"{path} is inside the live data")
    return path


def frozen(report: DataFrame, df: DataFrame, path: str) -> None:
    """Write `df` once, if its one-row completeness report allows it."""
    row = report.first()
    if not row["may_freeze"]:
        raise ValueError(f"not complete: {row.asDict()}")
    write_whole(df, path)
