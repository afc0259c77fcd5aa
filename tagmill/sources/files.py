"""Readers of the file shapes around the tables: JSON lines and documents, CSV, TOML, vectors, snapshots."""

from __future__ import annotations

import json
import tomllib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagmill.sources.versions import Versions


def optional_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    """`df` with the column, null where the table has none."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def latest_snapshot(spark: SparkSession, root: str) -> str:
    """The name of the last whole snapshot folder under `root`; names are UTC stamps, so the largest is the last.

    Where there is a log of commits only what it lists counts. Folders that others made count unless a write that
    was lost left its temporary files in them or in a table of theirs.
    """
    versions = Versions(spark, root)
    if versions.logged():
        names = [versions.at(n).name for n in versions.numbers()]
    else:
        names = versions.foreign()
    if not names:
        raise FileNotFoundError(f"no snapshot in {root}")
    return max(names)


def json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines with a fixed schema; blank lines count for nothing."""
    return spark.read.schema(schema).json(path)


def csv_table(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """A CSV with a header, read as text and cast; a malformed number is null."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*[F.col(c).try_cast(k).alias(c) for c, k in columns.items()])


def _passages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for files in batches:
        rows = []
        for path, content in zip(files["path"], files["content"], strict=True):
            tradition, text, _, name = path.rsplit("/", 3)[-4:] if path.count("/") >= 3 else ("", "", "", path)
            tradition = tradition.rsplit("/", 1)[-1]
            data = tomllib.loads(bytes(content).decode())
            seq = name.removesuffix(".toml")
            body, chunk = data.get("content", {}).get("body"), data.get("chunk", {})
            rows.append((f"{tradition}.{text}.{seq}", tradition, text, seq, body, chunk.get("text_name"), chunk.get("section")))
        yield pd.DataFrame(rows, columns=["chunk_id", "tradition", "text_id", "seq", "body", "text_name", "section"])


def toml_passages(spark: SparkSession, root: str) -> DataFrame:
    """Passages from <root>/<tradition>/<text>/chunks/<seq>.toml, as one table to join with."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.toml").load(root)
    schema = "chunk_id string, tradition string, text_id string, seq string, body string, text_name string, section string"
    return files.select("path", "content").mapInPandas(_passages, schema)


def _entries_of(node: object) -> object:
    """A TOML table as its entries in the document's order, which a variant object would lose; texts stay, the rest is null."""
    if isinstance(node, dict):
        return [{"k": k, "v": _entries_of(v)} for k, v in node.items()]
    return node if isinstance(node, str) else None


def toml_trees(spark: SparkSession, path: str) -> DataFrame:
    """file, tree: each TOML of a glob as a VARIANT of entries {k, v}, v a text or entries again; parsed in tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            made = [json.dumps(_entries_of(tomllib.loads(bytes(c).decode()))) for c in files["content"]]
            yield pd.DataFrame({"file": files["file"], "made": made})

    raw = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_name").alias("file"), "content")
    return raw.mapInPandas(run, "file string, made string").select("file", F.parse_json("made").alias("tree"))


_WALK = """
WITH RECURSIVE walk(file, path, keys, node) AS (
  SELECT file, array(e.pos), array(variant_get(e.value, '$.k', 'string')), variant_get(e.value, '$.v', 'variant')
  FROM {trees}, LATERAL variant_explode(tree) AS e
  UNION ALL
  SELECT file, array_append(path, e.pos), array_append(keys, variant_get(e.value, '$.k', 'string')), variant_get(e.value, '$.v', 'variant')
  FROM walk, LATERAL variant_explode(node) AS e
)
SELECT file, path, keys, variant_get(node, '$', 'string') AS text FROM walk WHERE schema_of_variant(node) = 'STRING'
"""


def text_leaves(trees: DataFrame) -> DataFrame:
    """file, path, keys, text: the texts of trees as toml_trees() makes them, one level of the recursion for each depth.

    `path` has the places of the entries on the way and sorts as the document is written. Values that are neither
    tables nor texts are left out. Trees of more than 100 levels, or 1,000,000 entries together, are an error.
    """
    return trees.sparkSession.sql(_WALK, trees=trees)


def taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """domain, family, concept_id, definition from TOMLs of three levels; texts at other depths are left out."""
    k = lambda i: F.get("keys", F.lit(i))
    deep = text_leaves(toml_trees(spark, path)).where(F.size("keys") == 3)
    return deep.select(k(0).alias("domain"), k(1).alias("family"), k(2).alias("concept_id"), F.col("text").alias("definition"))


def concept_leaves(spark: SparkSession, path: str) -> DataFrame:
    """concept_id ("concept." and the key) and definition of every text in a TOML of any depth.

    A key that stands in several places keeps its last definition.
    """
    named = text_leaves(toml_trees(spark, path)).withColumn("concept_id", F.concat(F.lit("concept."), F.element_at("keys", -1)))
    return named.groupBy("concept_id").agg(F.max_by("text", F.struct("file", "path")).alias("definition"))


def work_map(spark: SparkSession, path: str) -> DataFrame:
    """text_id, work: the texts of works of several texts, from a TOML's array of tables; one small file."""
    text = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0]).decode()
    made = tomllib.loads(text)
    rows = [(w.get("texts", w.get("members", [])), w["id"]) for w in made.get("work") or made.get("works") or []]
    listed = spark.createDataFrame(rows, "texts array<string>, work string")
    return listed.select(F.explode("texts").alias("text_id"), "work")


def with_work(rows: DataFrame, works: DataFrame, text: str = "text_id") -> DataFrame:
    """`rows` with their work; a text that no work names is a work of its own. The map is one small file."""
    named = rows.join(F.broadcast(works.withColumnRenamed("text_id", text)), text, "left")
    return named.withColumn("work", F.coalesce("work", text))


def id_lines(spark: SparkSession, path: str) -> DataFrame:
    """id: one for each line of a text that is not blank, without the space around it."""
    return spark.read.text(path).select(F.trim("value").alias("id")).where("id <> ''")


def split_manifest(spark: SparkSession, path: str, field: str = "splits") -> DataFrame:
    """key, value: the entries of one object in a JSON document, such as the split of each chunk."""
    whole = spark.read.text(path, wholetext=True)
    made = whole.select(F.from_json(F.get_json_object("value", f"$.{field}"), "map<string,string>").alias("m"))
    return made.select(F.explode("m").alias("key", "value"))


def json_documents(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One row for each JSON document of a glob, with `file`; names that start with "_" are left out."""
    docs = spark.read.schema(schema).option("multiLine", True).json(path)
    return docs.select("*", F.col("_metadata.file_name").alias("file")).where(~F.startswith("file", F.lit("_")))


def _grades(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema("idx long, edge_type string, confidence double, justification string, broken string")
    meta = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    # within a block of a file, ids rise with the lines
    return raw.option("columnNameOfCorruptRecord", "broken").json(path).select("*", *meta).withColumn("line", F.monotonically_increasing_id())


def merged_grades(spark: SparkSession, path: str, kinds: list[str]) -> DataFrame:
    """Grades of several JSON-lines files: the last file, and in it the last line, wins for each idx.

    Malformed rows and unknown kinds go; `times` says how often an idx was graded.
    """
    rows = _grades(spark, path)
    good = rows.where(F.col("broken").isNull() & F.col("idx").isNotNull() & F.col("edge_type").isin(*kinds))
    w = Window.partitionBy("idx")
    last = w.orderBy(F.desc("file"), F.desc("block"), F.desc("line"))
    ranked = good.withColumns({"rn": F.row_number().over(last), "times": F.count("*").over(w)})
    return ranked.where("rn = 1").drop("rn", "broken", "block", "line")


def rejected_grades(spark: SparkSession, path: str, kinds: list[str]) -> DataFrame:
    """The rows that merged_grades leaves out, with a reason: malformed, no idx, or unknown kind."""
    why = F.when(F.col("broken").isNotNull(), "malformed").when(F.col("idx").isNull(), "no idx").when(~F.coalesce(F.col("edge_type").isin(*kinds), F.lit(False)), "unknown kind")
    return _grades(spark, path).withColumn("reason", why).where("reason IS NOT NULL").drop("block", "line")


def layer_vectors(spark: SparkSession, path: str, layer: int, pooling: str) -> DataFrame:
    """chunk_id, vec of one layer and pooling, from a table partitioned by both, so that no other is read."""
    return spark.read.parquet(path).where((F.col("layer") == layer) & (F.col("pooling") == pooling)).select("chunk_id", "vec")


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """file, n_bytes and sha256 of the files of a glob."""
    found = spark.read.format("binaryFile").load(path)
    return found.select(F.col("_metadata.file_name").alias("file"), F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


def decoded_vectors(blobs: DataFrame, dim: int) -> DataFrame:
    """chunk_id, v: unit vectors from little-endian 32-bit blobs of `dim` numbers; others are left out."""
    import numpy as np

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows = rows[[b is not None and len(b) == 4 * dim for b in rows["vector"]]]
            v = np.frombuffer(b"".join(map(bytes, rows["vector"])), "<f4").reshape(-1, dim).astype(np.float64)
            n = np.linalg.norm(v, axis=1, keepdims=True)
            yield pd.DataFrame({"chunk_id": rows["chunk_id"], "v": pd.Series(np.divide(v, n, out=v.copy(), where=n > 0).tolist(), index=rows.index, dtype=object)})

    return blobs.select("chunk_id", "vector").mapInPandas(run, "chunk_id string, v array<double>")
