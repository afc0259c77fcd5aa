"""Record shapes of the tagging data, built from the driver's relational tables.

One class gives every adapter as a lazy DataFrame; only the columns a query touches reach the Parquet scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Total order of adapter rows that come from line items.
LINE_ORDER = ("k1", "k2", "k3")


class Tables:
    """All adapters over one directory of Parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def chunks(self) -> DataFrame:
        """o_orderkey, tradition_id, text_id, seq, chunk_id: one passage for each order."""
        people = self.raw("customer").join(F.broadcast(self.raw("nation")), F.expr("c_nationkey = n_nationkey"))
        return (
            self.raw("orders")
            .join(people, F.expr("o_custkey = c_custkey"))
            .selectExpr(
                "o_orderkey",
                "lower(n_name) AS tradition_id",
                "concat('w', c_nationkey % 3, '-', lower(c_mktsegment)) AS text_id",
                "lpad(cast(o_orderkey AS string), 6, '0') AS seq",
            )
            .withColumn("chunk_id", F.concat_ws(".", "tradition_id", "text_id", "seq"))
        )

    @cached_property
    def passages(self) -> DataFrame:
        """chunk_id, doc_id of its text; about one in eleven has none there."""
        modulus = int(1.1 * self.raw("documents").count())
        return self.chunks.select("chunk_id", (F.col("o_orderkey") % modulus).alias("doc_id"))

    @cached_property
    def texts(self) -> DataFrame:
        """doc_id, body."""
        return self.raw("documents").select("doc_id", F.col("text").alias("body"))

    @cached_property
    def bodies(self) -> DataFrame:
        """chunk_id, body for chunks with a text; about one in eleven has none."""
        return self.passages.join(self.texts, "doc_id").select("chunk_id", "body")

    @cached_property
    def concepts(self) -> DataFrame:
        """concept_id, family, domain, definition."""
        named = self.raw("part").withColumn("concept_id", F.expr("concat('concept_', p_partkey % 80)"))
        return named.groupBy("concept_id").agg(
            F.min("p_brand").alias("family"), F.min("p_type").alias("domain"), F.min("p_name").alias("definition")
        )

    @cached_property
    def nodes(self) -> DataFrame:
        """id, type, tradition_id; the tradition is null for every 11th chunk."""
        chunk = self.chunks.selectExpr("chunk_id AS id", "'chunk' AS type", "if(o_orderkey % 11 = 0, NULL, tradition_id) AS tradition_id")
        return chunk.unionByName(self.concepts.selectExpr("concept_id AS id", "'concept' AS type", "cast(NULL AS string) AS tradition_id"))

    @cached_property
    def lines(self) -> DataFrame:
        """Line items with the total order key."""
        return self.raw("lineitem").selectExpr("*", "l_partkey AS k1", "l_suppkey AS k2", "l_extendedprice AS k3")

    @cached_property
    def staged_tags(self) -> DataFrame:
        """chunk_id, concept_id, score, status, prompt_version, model, justification, is_new_concept, k1..k3."""
        return self.lines.join(self.chunks, F.expr("l_orderkey = o_orderkey")).selectExpr(
            "chunk_id",
            "concat('concept_', l_partkey % 80) AS concept_id",
            "l_linenumber % 4 AS score",
            "CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'pending' ELSE 'rejected' END AS status",
            "if(l_linestatus = 'F', 'v1', 'v2') AS prompt_version",
            "CASE l_suppkey % 10 WHEN 0 THEN 'Student-A' WHEN 1 THEN 'STUDENT-b' WHEN 2 THEN 'weak-9b' WHEN 3 THEN NULL ELSE 'teacher-27b' END AS model",
            "if(l_linenumber = 7, NULL, concat(l_returnflag, '-', l_linenumber)) AS justification",
            "l_partkey % 17 = 0 AS is_new_concept",
            *LINE_ORDER,
        )

    @cached_property
    def staged_edges(self) -> DataFrame:
        """source_chunk, target_chunk, edge_type, status, confidence, rank, k1..k3."""
        a = self.chunks.selectExpr("o_orderkey AS a_key", "chunk_id AS source_chunk")
        b = self.chunks.selectExpr("o_orderkey AS b_key", "chunk_id AS target_chunk")
        return (
            self.lines.join(a, F.expr("l_orderkey = a_key"))
            .join(b, F.expr("l_partkey = b_key"))
            .selectExpr(
                "source_chunk",
                "target_chunk",
                "CASE WHEN l_linenumber <= 3 THEN 'PARALLELS' WHEN l_linenumber = 4 THEN 'CONTRASTS' WHEN l_linenumber <= 6 THEN 'surface_only' ELSE 'unrelated' END AS edge_type",
                "CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'pending' ELSE 'rejected' END AS status",
                "if(l_tax = 0, NULL, l_discount * 10) AS confidence",
                "cast(l_quantity AS int) AS rank",
                *LINE_ORDER,
            )
        )

    @cached_property
    def edges(self) -> DataFrame:
        """source_id, target_id, type: accepted EXPRESSES and PARALLELS."""
        tags = self.staged_tags.where("status = 'accepted'").selectExpr("chunk_id AS source_id", "concept_id AS target_id", "'EXPRESSES' AS type")
        pairs = self.staged_edges.where("status = 'accepted' AND edge_type = 'PARALLELS' AND source_chunk <> target_chunk")
        return tags.union(pairs.selectExpr("source_chunk", "target_chunk", "'PARALLELS'")).distinct()

    @cached_property
    def vectors(self) -> DataFrame:
        """vec_id, tradition, work, chunk_id, v: unit vectors in double precision."""
        return self.raw("embeddings").selectExpr(
            "vec_id",
            "concat('trad_', label) AS tradition",
            "concat('trad_', label, '/w', vec_id % 13) AS work",
            "concat('trad_', label, '.w', vec_id % 13, '.', vec_id) AS chunk_id",
            "cast(embedding AS array<double>) AS v",
        )

    @cached_property
    def vector_labels(self) -> DataFrame:
        """a, b, positive for unordered pairs of vectors of different traditions; the last row of a pair wins."""
        lab = self.raw("embeddings").select("vec_id", "label")
        # at most 250,000 pairs of numbers are left before any join, however many line items there are
        at, last = F.struct(*LINE_ORDER), F.max_by("positive", "at").alias("positive")
        x = self.lines.select(F.expr("l_suppkey % 500").alias("x"), F.expr("l_partkey % 500").alias("y"), F.expr("l_returnflag = 'A'").alias("positive"), at.alias("at"))
        x = x.groupBy("x", "y").agg(last, F.max("at").alias("at"))
        x = x.join(lab.selectExpr("vec_id AS x", "label AS lx"), "x").join(lab.selectExpr("vec_id AS y", "label AS ly"), "y").where("lx <> ly")
        return x.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(last)

    @cached_property
    def cells(self) -> DataFrame:
        """model, chunk_id, concept_id, teacher_score, model_score, in_taxonomy, human_status, tradition."""
        named = self.lines.join(self.chunks, F.expr("l_orderkey = o_orderkey")).selectExpr(
            "CASE l_suppkey % 3 WHEN 0 THEN 'base' WHEN 1 THEN 'v1' ELSE 'v2' END AS model",
            "chunk_id",
            "concat('concept_', l_partkey % 80) AS concept_id",
            "l_linenumber % 4 AS t",
            "cast(floor(l_quantity) AS int) % 4 AS m",
            "cast(l_partkey % 17 <> 0 AS int) AS x",
            "CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'rejected' ELSE '' END AS h",
        )
        grouped = named.groupBy("model", "chunk_id", "concept_id").agg(
            F.max("t").alias("teacher_score"), F.max("m").alias("model_score"), F.max("x").alias("in_taxonomy"), F.max("h").alias("human_status")
        )
        return grouped.where("teacher_score >= 1 OR model_score >= 1").withColumn("tradition", F.split_part("chunk_id", F.lit("."), F.lit(1)))

    @cached_property
    def runs(self) -> DataFrame:
        """model, chunk_id, parse_ok, n_emitted, n_out_of_taxonomy, latency_s."""
        models = self.spark.createDataFrame([("base",), ("v1",), ("v2",)], "model string")
        orders = self.raw("orders").join(self.chunks.select("o_orderkey", "chunk_id"), "o_orderkey")
        # three rows
        return orders.crossJoin(F.broadcast(models)).selectExpr(
            "model",
            "chunk_id",
            "cast(o_orderkey % 31 <> 0 AS int) AS parse_ok",
            "cast(o_orderkey % 12 AS int) AS n_emitted",
            "cast(o_orderkey % 5 AS int) AS n_out_of_taxonomy",
            "if(o_orderkey % 31 = 0, NULL, o_totalprice / 10000) AS latency_s",
        )

    @cached_property
    def grades(self) -> DataFrame:
        """idx, g1, g2, score, stratum: two binary graders over labelled documents."""
        return self.raw("labels").join(self.raw("documents"), "doc_id").selectExpr(
            "doc_id AS idx", "quality AS g1", "1 - toxic AS g2", "n_chars AS score", "lang AS stratum"
        )

    @cached_property
    def queries(self) -> DataFrame:
        """query, work, kind, source, ord: search queries by work."""
        return self.raw("conversations").where("role = 'user'").selectExpr(
            "text AS query",
            "concat('work_', conv_id % 23) AS work",
            "if(turn = 0, 'probe', 'relevance') AS kind",
            "concat('src_', conv_id % 3) AS source",
            "conv_id * 1000 + turn AS ord",
        )
