"""The adapters of sources/tables.py as SQL for DuckDB, and the assembly of a query's WITH clause."""

from __future__ import annotations

import re

_STATUS = "CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'pending' ELSE 'rejected' END"

VIEWS = {
    "chunks": """SELECT o_orderkey, lower(n_name) AS tradition_id, 'w' || (c_nationkey % 3) || '-' || lower(c_mktsegment) AS text_id,
        lpad(o_orderkey::VARCHAR, 6, '0') AS seq,
        lower(n_name) || '.w' || (c_nationkey % 3) || '-' || lower(c_mktsegment) || '.' || lpad(o_orderkey::VARCHAR, 6, '0') AS chunk_id
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "bodies": """SELECT chunk_id, text AS body FROM chunks JOIN documents
        ON doc_id = o_orderkey % (SELECT floor(1.1::DOUBLE * count(*))::BIGINT FROM documents)""",
    "concepts": """SELECT 'concept_' || (p_partkey % 80) AS concept_id, min(p_brand) AS family, min(p_type) AS domain,
        min(p_name) AS definition FROM part GROUP BY 1""",
    "nodes": """SELECT chunk_id AS id, 'chunk' AS type, CASE WHEN o_orderkey % 11 <> 0 THEN tradition_id END AS tradition_id FROM chunks
        UNION ALL SELECT concept_id, 'concept', NULL FROM concepts""",
    "lines": "SELECT *, l_partkey AS k1, l_suppkey AS k2, l_extendedprice AS k3 FROM lineitem",
    "staged_tags": f"""SELECT chunk_id, 'concept_' || (l_partkey % 80) AS concept_id, l_linenumber % 4 AS score, {_STATUS} AS status,
        CASE WHEN l_linestatus = 'F' THEN 'v1' ELSE 'v2' END AS prompt_version,
        CASE l_suppkey % 10 WHEN 0 THEN 'Student-A' WHEN 1 THEN 'STUDENT-b' WHEN 2 THEN 'weak-9b' WHEN 3 THEN NULL ELSE 'teacher-27b' END AS model,
        CASE WHEN l_linenumber <> 7 THEN l_returnflag || '-' || l_linenumber END AS justification,
        l_partkey % 17 = 0 AS is_new_concept, k1, k2, k3 FROM lines JOIN chunks ON l_orderkey = o_orderkey""",
    "staged_edges": f"""SELECT a.chunk_id AS source_chunk, b.chunk_id AS target_chunk,
        CASE WHEN l_linenumber <= 3 THEN 'PARALLELS' WHEN l_linenumber = 4 THEN 'CONTRASTS' WHEN l_linenumber <= 6 THEN 'surface_only' ELSE 'unrelated' END AS edge_type,
        {_STATUS} AS status, CASE WHEN l_tax <> 0 THEN l_discount * 10 END AS confidence, l_quantity::INT AS rank, k1, k2, k3
        FROM lines JOIN chunks a ON l_orderkey = a.o_orderkey JOIN chunks b ON l_partkey = b.o_orderkey""",
    "edges": """SELECT DISTINCT * FROM (SELECT chunk_id AS source_id, concept_id AS target_id, 'EXPRESSES' AS type FROM staged_tags WHERE status = 'accepted'
        UNION ALL SELECT source_chunk, target_chunk, 'PARALLELS' FROM staged_edges
        WHERE status = 'accepted' AND edge_type = 'PARALLELS' AND source_chunk <> target_chunk)""",
    "vectors": """SELECT vec_id, 'trad_' || label AS tradition, 'trad_' || label || '/w' || (vec_id % 13) AS work,
        'trad_' || label || '.w' || (vec_id % 13) || '.' || vec_id AS chunk_id, embedding::DOUBLE[] AS v FROM embeddings""",
    "vector_labels": """SELECT least(x, y) AS a, greatest(x, y) AS b, max_by(positive, (k1, k2, k3)) AS positive FROM
        (SELECT l_suppkey % 500 AS x, l_partkey % 500 AS y, l_returnflag = 'A' AS positive, k1, k2, k3 FROM lines)
        JOIN embeddings p ON p.vec_id = x JOIN embeddings q ON q.vec_id = y WHERE p.label <> q.label GROUP BY 1, 2""",
    "cells": """SELECT *, split_part(chunk_id, '.', 1) AS tradition FROM (SELECT CASE l_suppkey % 3 WHEN 0 THEN 'base' WHEN 1 THEN 'v1' ELSE 'v2' END AS model, chunk_id,
        'concept_' || (l_partkey % 80) AS concept_id, max(l_linenumber % 4) AS teacher_score, max(floor(l_quantity)::INT % 4) AS model_score,
        max((l_partkey % 17 <> 0)::INT) AS in_taxonomy,
        max(CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'rejected' ELSE '' END) AS human_status
        FROM lines JOIN chunks ON l_orderkey = o_orderkey GROUP BY 1, 2, 3) WHERE teacher_score >= 1 OR model_score >= 1""",
    "runs": """SELECT model, chunk_id, (o_orderkey % 31 <> 0)::INT AS parse_ok, (o_orderkey % 12)::INT AS n_emitted, (o_orderkey % 5)::INT AS n_out_of_taxonomy,
        CASE WHEN o_orderkey % 31 <> 0 THEN o_totalprice / 10000 END AS latency_s
        FROM orders JOIN chunks USING (o_orderkey), (VALUES ('base'), ('v1'), ('v2')) m(model)""",
    "grades": "SELECT doc_id AS idx, quality AS g1, 1 - toxic AS g2, n_chars AS score, lang AS stratum FROM labels JOIN documents USING (doc_id)",
    "queries": """SELECT text AS query, 'work_' || (conv_id % 23) AS work, CASE WHEN turn = 0 THEN 'probe' ELSE 'relevance' END AS kind,
        'src_' || (conv_id % 3) AS source, conv_id * 1000 + turn AS ord FROM conversations WHERE role = 'user'""",
}


def _needs(sql: str) -> list[str]:
    return [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """`sql` with a WITH clause of all adapters that it names, directly or not; extra: further views in order."""
    used: list[str] = []

    def visit(name: str) -> None:
        for dep in _needs(VIEWS[name]):
            if dep != name and dep not in used:
                visit(dep)
        if name not in used:
            used.append(name)

    extra = extra or {}
    for text in [*extra.values(), sql]:
        for name in _needs(text):
            if name not in used:
                visit(name)
    parts = [f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in used] + [f"{n} AS MATERIALIZED ({t})" for n, t in extra.items()]
    return f"WITH {', '.join(parts)} {sql}" if parts else sql
