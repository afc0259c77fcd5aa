"""Queries on tags, passages, prompts and model outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.functions import parsing
from tagmill.functions.columns import query_hash, rounded, text_of, tradition_of, work_of
from tagmill.operators import prompts, tagging
from tagmill.plans.registry import query
from tagmill.sources.tables import LINE_ORDER, Tables

_EXPORTABLE = "status IN ('accepted', 'pending') AND model NOT ILIKE 'student%' AND model NOT IN ('weak-9b')"
SUPERSEDED = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id, concept_id
    ORDER BY (status = 'accepted') DESC, score DESC, k1, k2, k3) AS rn FROM {0}) WHERE rn = 1"""
BUCKET = "('0x' || substr(sha256({0}), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0"
SPLIT = f"CASE WHEN {BUCKET} < 0.05 THEN 'val' WHEN {BUCKET} < 0.1 THEN 'test' ELSE 'train' END"
_OF_CHUNK = "'0:' || chunk_id"


def _exportable(t: Tables) -> DataFrame:
    return tagging.eligible(t.staged_tags, ("accepted", "pending"), prefixes=("student",), models=("weak-9b",))


def _one_tag(t: Tables) -> DataFrame:
    return tagging.supersede(_exportable(t), order=LINE_ORDER)


@query("SELECT chunk_id, concept_id, score, status FROM staged_tags WHERE status IN ('accepted', 'rejected')")
def tags_status_filter(t: Tables) -> DataFrame:
    return t.staged_tags.where(F.col("status").isin("accepted", "rejected")).select("chunk_id", "concept_id", "score", "status")


@query("SELECT chunk_id, concept_id, model FROM staged_tags WHERE model NOT ILIKE 'student%'")
def tags_denylist_prefix(t: Tables) -> DataFrame:
    return tagging.without_prefixes(t.staged_tags, ("student",)).select("chunk_id", "concept_id", "model")


@query("SELECT chunk_id, concept_id, score, model FROM staged_tags WHERE status = 'accepted' AND prompt_version = 'v2' AND model NOT ILIKE 'student%' AND model NOT IN ('weak-9b')")
def export_eligible_tags(t: Tables) -> DataFrame:
    return tagging.eligible(t.staged_tags, ("accepted",), "v2", ("student",), ("weak-9b",)).select("chunk_id", "concept_id", "score", "model")


@query("SELECT chunk_id, length(body) AS n_chars FROM bodies WHERE body <> ''")
def chunks_with_body(t: Tables) -> DataFrame:
    return t.bodies.where("body <> ''").select("chunk_id", F.length("body").cast("long").alias("n_chars"))


@query("SELECT s.chunk_id, s.concept_id, s.score, n.tradition_id FROM staged_tags s JOIN nodes n ON n.id = s.chunk_id WHERE n.type = 'chunk'")
def tags_join_nodes(t: Tables) -> DataFrame:
    chunk = t.nodes.where("type = 'chunk'").selectExpr("id AS chunk_id", "tradition_id")
    return t.staged_tags.join(chunk, "chunk_id").select("chunk_id", "concept_id", "score", "tradition_id")


@query("SELECT chunk_id, concept_id, score, status, k1, k2, k3 FROM one", {"one": SUPERSEDED.format("staged_tags")})
def supersede_dedupe(t: Tables) -> DataFrame:
    return tagging.supersede(t.staged_tags, order=LINE_ORDER).select("chunk_id", "concept_id", "score", "status", *LINE_ORDER)


@query(
    """SELECT chunk_id, count(*) AS n_tags, string_agg(concept_id || ':' || score || ':' || coalesce(justification, '-'), ',' ORDER BY concept_id) AS tags
    FROM one GROUP BY chunk_id""",
    {"ok": f"SELECT * FROM staged_tags WHERE {_EXPORTABLE}", "one": SUPERSEDED.format("ok")},
)
def tagged_chunks(t: Tables) -> DataFrame:
    shown = F.transform("tags", lambda x: F.concat(x["concept_id"], F.lit(":"), x["score"], F.lit(":"), F.coalesce(x["justification"], F.lit("-"))))
    return tagging.tagged_chunks(_one_tag(t)).select("chunk_id", "n_tags", F.array_join(shown, ",").alias("tags"))


@query("SELECT model, prompt_version, status, count(*) AS n FROM staged_tags GROUP BY ALL ORDER BY n DESC")
def stats_counts(t: Tables) -> DataFrame:
    return t.staged_tags.groupBy("model", "prompt_version", "status").agg(F.count("*").alias("n")).orderBy(F.desc("n"))


@query(
    """SELECT model, count(*) AS n_rows, count_if(chunk_id IN (SELECT chunk_id FROM bodies)) AS n_exported FROM ok GROUP BY model""",
    {"ok": f"SELECT * FROM staged_tags WHERE {_EXPORTABLE}"},
)
def contributing_models(t: Tables) -> DataFrame:
    return tagging.contributions(_exportable(t), t.nodes, t.bodies)


@query(
    """SELECT (SELECT count(*) FROM nodes WHERE type = 'chunk') AS n_chunks, (SELECT count(*) FROM nodes WHERE type = 'concept') AS n_concepts,
    (SELECT count(*) FROM staged_tags) AS n_tags, (SELECT count(*) FROM staged_tags WHERE status = 'accepted') AS n_accepted,
    (SELECT count(*) FROM edges WHERE type = 'EXPRESSES') AS n_expresses, (SELECT count(*) FROM edges WHERE type = 'PARALLELS') AS n_parallels"""
)
def snapshot_manifest(t: Tables) -> DataFrame:
    return tagging.manifest(t.nodes, t.staged_tags, t.edges)


@query(f"SELECT chunk_id, round_even({BUCKET.format(_OF_CHUNK)}, 6) AS bucket, {SPLIT.format(_OF_CHUNK)} AS split FROM chunks")
def assign_split(t: Tables) -> DataFrame:
    return tagging.assign_split(t.chunks).withColumn("bucket", rounded("bucket"))


@query(
    "SELECT count_if(s = 'train') AS train, count_if(s = 'val') AS val, count_if(s = 'test') AS test FROM sp",
    {"sp": f"SELECT {SPLIT.format(_OF_CHUNK)} AS s FROM chunks"},
)
def split_counts(t: Tables) -> DataFrame:
    s = F.col("split")
    return tagging.assign_split(t.chunks).agg(*[F.count_if(s == k).alias(k) for k in ("train", "val", "test")])


@query(
    """SELECT chunk_id, tradition_id, CASE WHEN place < 0.1 THEN 'val' WHEN place < 0.2 THEN 'test' ELSE 'train' END AS split FROM
    (SELECT *, (row_number() OVER (PARTITION BY tradition_id ORDER BY sha256('7:' || chunk_id)) - 1)::DOUBLE / count(*) OVER (PARTITION BY tradition_id) AS place FROM chunks)"""
)
def stratified_split(t: Tables) -> DataFrame:
    return tagging.stratified_split(t.chunks, "tradition_id", seed="7").select("chunk_id", "tradition_id", "split")


@query(
    "SELECT chunk_id, concept_id, score FROM one JOIN bodies USING (chunk_id) ORDER BY chunk_id, concept_id LIMIT 500",
    {"ok": f"SELECT * FROM staged_tags WHERE {_EXPORTABLE}", "one": SUPERSEDED.format("ok")},
)
def export_limit(t: Tables) -> DataFrame:
    """The limit is the feature: it counts exported rows, after the body join."""
    return _one_tag(t).join(t.bodies.select("chunk_id"), "chunk_id").orderBy("chunk_id", "concept_id").limit(500).select("chunk_id", "concept_id", "score")


@query("SELECT chunk_id, split_part(chunk_id, '.', 1) AS tradition, tradition_id || '.' || text_id AS text, regexp_replace(chunk_id, '\\.[^.]*$', '') AS work FROM chunks")
def id_parts(t: Tables) -> DataFrame:
    return t.chunks.select("chunk_id", tradition_of("chunk_id").alias("tradition"), text_of("chunk_id").alias("text"), work_of("chunk_id").alias("work"))


@query(
    """SELECT chunk_id, CASE WHEN o_orderkey % 7 = 0 THEN chunk_id WHEN o_orderkey % 3 = 0 THEN text_id ELSE text_id || ' — ' || seq END AS citation FROM chunks"""
)
def citations(t: Tables) -> DataFrame:
    name = F.expr("if(o_orderkey % 7 = 0, NULL, text_id)")
    section = F.expr("if(o_orderkey % 3 = 0, NULL, seq)")
    return t.chunks.select("chunk_id", prompts.citation(name, section, F.col("chunk_id")).alias("citation"))


@query(
    """SELECT count_if(n <= 512) AS kept, count_if(n > 512) AS dropped, sum(n) FILTER (n <= 512)::BIGINT AS kept_tokens FROM
    (SELECT (length(body) - length(replace(body, ' ', '')) + 1) AS n FROM bodies)"""
)
def length_filter(t: Tables) -> DataFrame:
    """Passages over 512 tokens are dropped, never cut; the token count is pluggable, here blanks plus one."""
    n = F.length("body") - F.length(F.replace("body", F.lit(" "), F.lit(""))) + 1
    counted = t.bodies.select(n.cast("long").alias("n"))
    fits = F.col("n") <= 512
    return counted.agg(F.count_if(fits).alias("kept"), F.count_if(~fits).alias("dropped"), F.sum(F.when(fits, F.col("n"))).alias("kept_tokens"))


@query(
    """SELECT c.chunk_id, coalesce(s.split, 'train') AS split FROM chunks c LEFT JOIN sp s USING (chunk_id) WHERE coalesce(s.split, 'train') = 'train'""",
    {"sp": f"SELECT chunk_id, {SPLIT.format(_OF_CHUNK)} AS split FROM chunks WHERE o_orderkey % 11 <> 0"},
)
def split_select(t: Tables) -> DataFrame:
    """A chunk that no split names is for training."""
    known = tagging.assign_split(t.chunks.where("o_orderkey % 11 <> 0")).select("chunk_id", "split")
    return t.chunks.select("chunk_id").join(known, "chunk_id", "left").na.fill("train", ["split"]).where("split = 'train'")


@query("SELECT chunk_id FROM chunks WHERE chunk_id IN (SELECT chunk_id FROM staged_tags WHERE status IN ('accepted', 'rejected'))")
def curated_chunks(t: Tables) -> DataFrame:
    reviewed = t.staged_tags.where(F.col("status").isin("accepted", "rejected")).select("chunk_id")
    return t.chunks.select("chunk_id").join(reviewed, "chunk_id", "left_semi")


@query("SELECT doc_id FROM documents WHERE starts_with(text, 'The') OR starts_with(text, 'Licensed') OR starts_with(text, 'En ')")
def apparatus_prefix(t: Tables) -> DataFrame:
    hit = F.lit(False)
    for p in ("The", "Licensed", "En "):
        hit = hit | F.startswith(F.col("text"), F.lit(p))
    return t.raw("documents").where(hit).select("doc_id")


@query("SELECT doc_id, regexp_matches(text, '(?i)footnote|copyright|\\band\\b') AS apparatus FROM documents")
def apparatus_regex(t: Tables) -> DataFrame:
    return t.raw("documents").select("doc_id", F.col("text").rlike(r"(?i)footnote|copyright|\band\b").alias("apparatus"))


@query("SELECT query, work, kind FROM queries WHERE work NOT IN ('work_1', 'work_5', 'work_9')")
def frozen_exclusion(t: Tables) -> DataFrame:
    frozen = t.queries.where(F.col("work").isin("work_1", "work_5", "work_9"))
    return tagging.exclude_frozen(t.queries, frozen).select("query", "work", "kind")


@query("SELECT b.item_id, count(d.doc_id) AS n_leaks FROM benchmark b LEFT JOIN documents d ON contains(d.text, b.text) GROUP BY 1")
def frozen_leakage(t: Tables) -> DataFrame:
    """How many documents hold a frozen item's text."""
    return tagging.containments(t.raw("documents").select("doc_id", "text"), t.raw("benchmark").select("item_id", "text"))


@query("SELECT chunk_id, length(substring(body, 1, 2400)) AS n, substring(body, 1, 40) AS head FROM bodies")
def body_truncate(t: Tables) -> DataFrame:
    return t.bodies.select("chunk_id", F.length(F.substring("body", 1, 2400)).cast("long").alias("n"), F.substring("body", 1, 40).alias("head"))


@query("SELECT ord, substr(sha256(query), 1, 16) AS qh FROM queries")
def query_hash_key(t: Tables) -> DataFrame:
    return t.queries.select("ord", query_hash("query").alias("qh"))


@query(
    """SELECT qh, CASE WHEN row_number() OVER (ORDER BY sha256('11:' || qh)) <= greatest(1, floor(count(*) OVER () * 0.1)) THEN 'val' ELSE 'train' END AS split
    FROM (SELECT DISTINCT substr(sha256(query), 1, 16) AS qh FROM queries)"""
)
def query_split(t: Tables) -> DataFrame:
    return tagging.keyed_split(t.queries.select(query_hash("query").alias("qh")), "qh", "11")


@query("SELECT min_by(query, ord) AS query, count(*) AS n FROM (SELECT *, lower(trim(query, chr(9) || chr(10) || chr(13) || ' ')) AS k FROM queries) GROUP BY k")
def query_dedupe(t: Tables) -> DataFrame:
    return tagging.dedupe_queries(t.queries, "ord")


@query("SELECT source, kind, count(*) AS n, count(DISTINCT work) AS n_works FROM queries GROUP BY 1, 2")
def pool_stats(t: Tables) -> DataFrame:
    return t.queries.groupBy("source", "kind").agg(F.count("*").alias("n"), F.countDistinct("work").alias("n_works"))


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _passage_sql(label: str, cite: str, body: str) -> str:
    quotes = '"""'
    return f"'{label} (' || {cite} || '):' || chr(10) || '{quotes}' || chr(10) || {body} || chr(10) || '{quotes}' || chr(10) || chr(10)"


@query(
    f"""SELECT chunk_id, length(p)::BIGINT AS n, sha256(p) AS digest FROM (SELECT chunk_id, {_passage_sql('Passage', 'chunk_id', 'body')} || {_q(prompts.TAG_SCALE)}
    || (SELECT string_agg('  {{"id": "' || concept_id || '", "definition": "' || definition || '"}}', chr(10) ORDER BY concept_id) FROM concepts)
    || {_q(prompts.TAG_TAIL)} AS p FROM bodies)"""
)
def tag_prompts(t: Tables) -> DataFrame:
    made = prompts.tag_prompts(t.bodies.withColumn("citation", F.col("chunk_id")), t.concepts)
    return made.select("chunk_id", F.length("prompt").cast("long").alias("n"), F.sha2("prompt", 256).alias("digest"))


_PAIRED = """SELECT e.k1, e.k2, e.k3, a.chunk_id AS citation_a, a.body AS body_a, b.chunk_id AS citation_b, b.body AS body_b, e.edge_type
    FROM staged_edges e JOIN bodies a ON a.chunk_id = source_chunk JOIN bodies b ON b.chunk_id = target_chunk WHERE status = 'accepted' AND edge_type = 'CONTRASTS'"""


def _paired(t: Tables) -> DataFrame:
    # passages are known by their documents' ids first: texts are joined to the pairs alone
    side = lambda s: t.passages.selectExpr(f"chunk_id AS citation_{s}", f"doc_id AS doc_{s}")
    text = lambda s: t.texts.selectExpr(f"doc_id AS doc_{s}", f"body AS body_{s}")
    e = t.staged_edges.where("status = 'accepted' AND edge_type = 'CONTRASTS'")
    e = e.selectExpr("source_chunk AS citation_a", "target_chunk AS citation_b", "edge_type", *LINE_ORDER)
    known = e.join(side("a"), "citation_a").join(side("b"), "citation_b")
    return known.join(text("a"), "doc_a").join(text("b"), "doc_b").drop("doc_a", "doc_b")


@query(
    f"""SELECT k1, k2, k3, sha256({_passage_sql('Passage A', 'citation_a', 'body_a')} || {_passage_sql('Passage B', 'citation_b', 'body_b')} || {_q(prompts.PAIR_TAIL)}) AS digest FROM pr""",
    {"pr": _PAIRED},
)
def pair_prompts(t: Tables) -> DataFrame:
    return prompts.pair_prompts(_paired(t)).select(*LINE_ORDER, F.sha2("prompt", 256).alias("digest"))


@query(
    f"""SELECT k1, k2, k3, sha256('Judge.' || chr(10) || chr(10) || {_passage_sql('A', 'citation_a', 'substring(body_a, 1, 400)')} || {_passage_sql('B', 'citation_b', 'substring(body_b, 1, 400)')}
    || CASE WHEN k2 % 2 = 0 THEN 'Proposed: ' || edge_type || chr(10) ELSE '' END) AS digest FROM pr""",
    {"pr": _PAIRED},
)
def review_prompts(t: Tables) -> DataFrame:
    rows = _paired(t).withColumn("proposal", F.expr("if(k2 % 2 = 0, edge_type, NULL)"))
    return prompts.review_prompts(rows, "Judge.").select(*LINE_ORDER, F.sha2("prompt", 256).alias("digest"))


@query(
    f"""SELECT {_q(prompts.GRAMMAR_HEAD)} || 'cid       ::= ' || (SELECT string_agg('"\\"' || concept_id || '\\""', ' | ' ORDER BY concept_id) FROM concepts) || chr(10) AS grammar"""
)
def grammar_strict(t: Tables) -> DataFrame:
    return prompts.grammar(t.concepts)


@query("SELECT concept_id, score, regexp_full_match(concept_id, '[a-z][a-z0-9_]*') AND score BETWEEN 0 AND 3 AS valid FROM (SELECT CASE WHEN k2 % 5 = 0 THEN upper(concept_id) ELSE concept_id END AS concept_id, score + (k2 % 3)::INT AS score FROM staged_tags)")
def tag_schema_valid(t: Tables) -> DataFrame:
    rows = t.staged_tags.selectExpr("if(k2 % 5 = 0, upper(concept_id), concept_id) AS concept_id", "score + cast(k2 % 3 AS int) AS score")
    return rows.withColumn("valid", parsing.schema_valid())


@query(
    f"""SELECT b.chunk_id, p.pos, p.role, CASE p.pos WHEN 0 THEN {_q(prompts.TAG_SYSTEM)} WHEN 1 THEN {_passage_sql('Passage', 'b.chunk_id', 'body')} || {_q(prompts.TAG_SCALE)}
    || (SELECT string_agg('  {{"id": "' || concept_id || '", "definition": "' || definition || '"}}', chr(10) ORDER BY concept_id) FROM concepts) || {_q(prompts.TAG_TAIL)}
    ELSE tags END AS content FROM bodies b JOIN (SELECT chunk_id, '[' || string_agg('{{"concept_id": "' || concept_id || '", "score": ' || score || ', "justification": "' || coalesce(justification, '') || '", "is_new_concept": '
    || is_new_concept || ', "new_concept_def": null}}', ', ' ORDER BY concept_id) || ']' AS tags FROM one GROUP BY 1) g USING (chunk_id), (VALUES (0, 'system'), (1, 'user'), (2, 'assistant')) p(pos, role)""",
    {"ok": f"SELECT * FROM staged_tags WHERE {_EXPORTABLE}", "one": SUPERSEDED.format("ok")},
)
def sft_messages(t: Tables) -> DataFrame:
    """The messages of every training example, one row each."""
    # texts come last: until then rows hold ids and tags
    tagged = t.passages.join(tagging.tagged_chunks(_one_tag(t)), "chunk_id").join(t.texts, "doc_id")
    examples = prompts.messages(tagged.withColumn("citation", F.col("chunk_id")), t.concepts)
    return examples.select("chunk_id", F.posexplode("messages").alias("pos", "m")).select("chunk_id", "pos", "m.role", "m.content")


_RAW = """CASE k2 % 8 WHEN 0 THEN '[{"concept_id": "' || concept_id || '", "score": ' || score || '}]'
    WHEN 1 THEN '{"tags": [{"concept_id": "' || concept_id || '", "score": "' || score || '"}]}'
    WHEN 2 THEN '```json' || chr(10) || '[{"concept_id": "' || concept_id || '"}]' || chr(10) || '```'
    WHEN 3 THEN '[{"concept_id": "' || concept_id || '", "score": 1}, {"concept_id": "cut", "sc'
    WHEN 4 THEN '[]' WHEN 5 THEN '[{"concept_id": "a", "score": 1}, 5, {"concept_id": "a", "score": 2.7}, {"concept_id": "b", "score": "2.7"}]'
    WHEN 6 THEN 'nothing here' ELSE '7' END"""


def raw_outputs(t: Tables) -> DataFrame:
    return t.staged_tags.select("chunk_id", "k1", "k2", "k3", F.expr(_RAW.replace("chr(10)", "char(10)")).alias("raw"), "concept_id", "score").withColumnsRenamed({"concept_id": "c", "score": "s"})


@query(
    """SELECT k1, k2, k3, parse_ok, concept_id, score FROM (SELECT k1, k2, k3, k2 % 8 <> 6 AS parse_ok,
    CASE WHEN k2 % 8 <= 3 THEN concept_id END AS concept_id, CASE k2 % 8 WHEN 0 THEN score WHEN 1 THEN score WHEN 2 THEN 0 WHEN 3 THEN 1 END::BIGINT AS score
    FROM staged_tags WHERE k2 % 8 <> 5 UNION ALL SELECT k1, k2, k3, true, 'a', 2 FROM staged_tags WHERE k2 % 8 = 5)"""
)
def parse_tags(t: Tables) -> DataFrame:
    return parsing.parse_tags(raw_outputs(t)).select(*LINE_ORDER, "parse_ok", "concept_id", "score")


_VERDICT = """CASE k2 % 5 WHEN 0 THEN 'Well } then: {"edge_type": "PARALLELS", "confidence": 0.5, "justification": "a {b} c"} {"edge_type": "unrelated"}'
    WHEN 1 THEN '{"note": 1} {"edge_type": "kindred", "confidence": "high"}'
    WHEN 2 THEN '{"edge_type": "CONTRASTS", "confidence": "0.25"}' WHEN 3 THEN 'none' ELSE '{"edge_type": "unrelated", "conf' END"""


@query(
    """SELECT k1, k2, k3, CASE k2 % 5 WHEN 0 THEN 'PARALLELS' WHEN 2 THEN 'CONTRASTS' END AS edge_type, CASE k2 % 5 WHEN 0 THEN 0.5::DOUBLE WHEN 2 THEN 0.25::DOUBLE END AS confidence,
    CASE k2 % 5 WHEN 0 THEN 'a {b} c' ELSE '' END AS justification FROM staged_tags"""
)
def parse_verdict(t: Tables) -> DataFrame:
    read = t.staged_tags.select(*LINE_ORDER, parsing.verdict_of(F.expr(_VERDICT)).alias("v"))
    return read.select(*LINE_ORDER, "v.edge_type", "v.confidence", "v.justification")


@query(
    """SELECT edge_type, confidence, count(*) AS n FROM (SELECT CASE WHEN k2 % 4 = 0 THEN NULL ELSE edge_type END AS edge_type, CASE WHEN k2 % 3 = 0 THEN NULL ELSE (l || '.5')::DOUBLE END AS confidence
    FROM (SELECT edge_type, k2, rank % 3 AS l FROM staged_edges)) GROUP BY 1, 2"""
)
def verdict_norm(t: Tables) -> DataFrame:
    kind = F.expr("if(k2 % 4 = 0, 'kindred', edge_type)")
    sure = F.expr("if(k2 % 3 = 0, 'high', concat(rank % 3, '.5'))")
    rows = t.staged_edges.select(F.when(kind.isin(*parsing.EDGE_TYPES), kind).alias("edge_type"), sure.try_cast("double").alias("confidence"))
    return rows.groupBy("edge_type", "confidence").agg(F.count("*").alias("n"))
