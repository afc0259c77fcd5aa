"""Queries on vectors: neighbours, candidate strategies, samples, geometry and derived relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagmill.functions import agreement
from tagmill.functions.columns import norm, pair_key, rounded, shuffle_key
from tagmill.functions.working import checkpointed
from tagmill.operators import geometry as geo
from tagmill.operators import pairs, tagging
from tagmill.operators import vectors as vec
from tagmill.plans.registry import query
from tagmill.sources.tables import Tables

_UV = {"uv": "SELECT vec_id, tradition, work, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM vectors"}
_SIMS = _UV | {"sims": "SELECT a.vec_id AS i, b.vec_id AS j, a.tradition AS ti, b.tradition AS tj, list_dot_product(a.v, b.v) AS sim FROM uv a, uv b WHERE a.tradition <> b.tradition"}
_NN = _SIMS | {"nn": "SELECT * FROM (SELECT i, j, sim, row_number() OVER (PARTITION BY i ORDER BY sim DESC, j) AS rank FROM sims) WHERE rank <= 50"}
_UN = _NN | {"un": "SELECT least(i, j) AS a, greatest(i, j) AS b, max(sim) AS sim, min(rank) AS rank FROM nn GROUP BY 1, 2"}
_CUR = _UN | {"cur": "SELECT DISTINCT least(i, j) AS a, greatest(i, j) AS b, sim FROM (SELECT i, j, round(sim, 9) AS sim FROM nn WHERE rank <= 10 AND sim >= 0.2)"}
_BAND = "CASE WHEN rank BETWEEN 6 AND 10 THEN '06-10' WHEN rank BETWEEN 11 AND 25 THEN '11-25' WHEN rank BETWEEN 26 AND 50 THEN '26-50' END"


def _current(t: Tables, near: DataFrame | None = None) -> DataFrame:
    """Everyone's ten nearest of other traditions at 0.2 or more, each pair once; near: ten neighbours or more, if known."""
    near = vec.neighbours(t.vectors, 10, 0.2) if near is None else near.where("rank <= 10 AND sim >= 0.2")
    return vec.unordered(near).select("a", "b", "sim")


@query("SELECT vec_id, round_even(sqrt(list_dot_product(v, v)), 6) AS n FROM vectors")
def vec_norm(t: Tables) -> DataFrame:
    return t.vectors.select("vec_id", rounded(norm("v")).alias("n"))


@query("SELECT i, j, rank, round_even(sim, 6) AS sim FROM nn", _NN)
def neighbour_rank(t: Tables) -> DataFrame:
    return vec.neighbours(t.vectors, 50).select("i", "j", "rank", rounded("sim").alias("sim"))


@query("SELECT i, j, rank, round_even(sim, 6) AS sim FROM nn", _NN)
def cross_pairs_topn(t: Tables) -> DataFrame:
    """The fifty nearest of other traditions for every vector: the suite's heaviest product."""
    return vec.neighbours(t.vectors, 50).select("i", "j", "rank", rounded("sim").alias("sim"))


@query("SELECT i, j, rank FROM nn WHERE rank <= 10", _NN)
def knn_topn(t: Tables) -> DataFrame:
    return vec.neighbours(t.vectors, 10).select("i", "j", "rank")


@query("SELECT a, b, rank FROM un", _UN)
def best_direction_rank(t: Tables) -> DataFrame:
    return vec.unordered(vec.neighbours(t.vectors, 50)).select("a", "b", "rank")


@query("SELECT i, j FROM nn WHERE rank <= 10 AND sim >= 0.3", _NN)
def knn_floor(t: Tables) -> DataFrame:
    return vec.neighbours(t.vectors, 10, 0.3).select("i", "j")


@query(f"SELECT {_BAND} AS band, count(*) AS n FROM un GROUP BY 1", _UN)
def rank_sub_band(t: Tables) -> DataFrame:
    ranked = vec.unordered(vec.neighbours(t.vectors, 50))
    return ranked.groupBy(vec.sub_band(F.col("rank")).alias("band")).agg(F.count("*").alias("n"))


_ALLP = _SIMS | {"ap": "SELECT i AS a, j AS b, least(ti, tj) || '|' || greatest(ti, tj) AS block, sim FROM sims WHERE i < j"}


@query(
    "SELECT block, round_even(f, 6) AS floor, count(*) AS n, count_if(sim >= f - 1e-12) AS eligible FROM ap JOIN (SELECT block, quantile_cont(sim, 0.9) AS f FROM ap GROUP BY 1) USING (block) GROUP BY 1, f",
    _ALLP,
)
def block_percentile_floor(t: Tables) -> DataFrame:
    return vec.block_floors(t.vectors, "tradition", 0.9).withColumn("floor", rounded("floor"))


@query("SELECT l.a, l.b, round_even(list_dot_product(p.v, q.v), 6) AS sim FROM vector_labels l JOIN uv p ON p.vec_id = a JOIN uv q ON q.vec_id = b", _UV)
def similarity_backfill(t: Tables) -> DataFrame:
    return vec.listed_similarity(t.vector_labels.select("a", "b"), t.vectors).withColumn("sim", rounded("sim"))


@query(
    """SELECT CASE WHEN sim < 0 THEN '<0' WHEN sim < 0.05 THEN '[.00,.05)' WHEN sim < 0.1 THEN '[.05,.10)' WHEN sim < 0.15 THEN '[.10,.15)' ELSE '[.15,1]' END AS bucket, count(*) AS n, count_if(positive) AS good
    FROM (SELECT positive, list_dot_product(p.v, q.v) AS sim FROM vector_labels l JOIN uv p ON p.vec_id = a JOIN uv q ON q.vec_id = b) GROUP BY 1""",
    _UV,
)
def similarity_buckets(t: Tables) -> DataFrame:
    """Half-open buckets of similarity with their positives."""
    s = F.col("sim")
    bucket = F.when(s < 0, "<0").when(s < 0.05, "[.00,.05)").when(s < 0.1, "[.05,.10)").when(s < 0.15, "[.10,.15)").otherwise("[.15,1]")
    return vec.listed_similarity(t.vector_labels, t.vectors).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), F.count_if("positive").alias("good"))


@query(
    """SELECT q, j, rank FROM (SELECT a.vec_id AS q, b.vec_id AS j, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_dot_product(a.v, b.v) DESC, b.vec_id) AS rank
    FROM (SELECT * FROM uv WHERE vec_id % 50 = 0) a, uv b WHERE a.vec_id <> b.vec_id) WHERE rank <= 10""",
    _UV,
)
def query_rank(t: Tables) -> DataFrame:
    """The ten best of all vectors for a stated query set; each query its own tradition, so only itself is left out."""
    own = t.vectors.withColumn("tradition", F.concat(F.lit("v"), "vec_id"))
    asked = vec.neighbours(own, 10, asks=F.col("vec_id") % 50 == 0)
    return asked.select(F.col("i").alias("q"), "j", "rank")


@query("SELECT u.a, u.b, u.rank, l.positive FROM un u LEFT JOIN vector_labels l USING (a, b)", _UN)
def candidates_labelled(t: Tables) -> DataFrame:
    return vec.unordered(vec.neighbours(t.vectors, 50)).join(t.vector_labels, ["a", "b"], "left").select("a", "b", "rank", "positive")


@query("SELECT a, b, rank FROM un ANTI JOIN vector_labels USING (a, b)", _UN)
def unlabelled_candidates(t: Tables) -> DataFrame:
    return vec.unordered(vec.neighbours(t.vectors, 50)).join(t.vector_labels, ["a", "b"], "left_anti").select("a", "b", "rank")


@query("SELECT DISTINCT a, b FROM cur", _CUR)
def select_current(t: Tables) -> DataFrame:
    return _current(t).select("a", "b")


_STRAT = {
    "sb": "SELECT c.a, c.b, least(p.tradition, q.tradition) || '|' || greatest(p.tradition, q.tradition) AS block, l.positive FROM (SELECT DISTINCT a, b FROM cur) c JOIN uv p ON p.vec_id = c.a JOIN uv q ON q.vec_id = c.b LEFT JOIN vector_labels l ON l.a = c.a AND l.b = c.b",
    "pb": "SELECT block, count(*) AS n, sum(count(*)) OVER () AS total FROM sb GROUP BY 1",
}


@query(
    """SELECT count(*) AS pairs, (SELECT count(DISTINCT x) FROM (SELECT a AS x FROM sb UNION ALL SELECT b FROM sb)) AS covered,
    round_even((SELECT count(DISTINCT x) FROM (SELECT a AS x FROM sb UNION ALL SELECT b FROM sb)) / (SELECT count(*) FROM uv), 6) AS coverage, count(DISTINCT block) AS blocks,
    (SELECT (count(DISTINCT tradition) * (count(DISTINCT tradition) - 1) / 2)::BIGINT FROM uv) AS max_blocks, count(positive) AS labelled, round_even(count_if(positive) / nullif(count(positive), 0), 6) AS yield,
    round_even((SELECT sum(-(n / total) * ln(n / total)) FROM pb) / ln((SELECT count(DISTINCT tradition) * (count(DISTINCT tradition) - 1) / 2 FROM uv)), 6) AS entropy FROM sb""",
    _CUR | _STRAT,
)
def strategy_eval(t: Tables) -> DataFrame:
    return vec.strategy_report(_current(t), t.vectors, t.vector_labels)


@query(
    """SELECT block, count(a) AS n FROM (SELECT x.tradition || '|' || y.tradition AS block FROM (SELECT DISTINCT tradition FROM vectors) x, (SELECT DISTINCT tradition FROM vectors) y WHERE x.tradition < y.tradition)
    LEFT JOIN sb USING (block) GROUP BY 1 ORDER BY n, block LIMIT 4""",
    _CUR | _STRAT,
)
def starved_blocks(t: Tables) -> DataFrame:
    """The limit is the feature: the four pairs of traditions with the fewest selected pairs."""
    return vec.starved(_current(t), t.vectors, 4)


_LOWER = "greatest(0, (p + 3.8416 / (2 * n) - 1.96 * sqrt((p * (1 - p) + 3.8416 / (4 * n)) / n)) / (1 + 3.8416 / n))"
_ALLOC = {
    "pt": "SELECT tradition, count(*) AS n FROM vectors GROUP BY 1",
    "lb": """SELECT block, n, CASE WHEN n >= 20 THEN """
    + _LOWER
    + """ END AS lower FROM (SELECT least(p.tradition, q.tradition) || '|' || greatest(p.tradition, q.tradition) AS block, count(*) AS n, count_if(positive) / count(*) AS p
        FROM vector_labels JOIN vectors p ON p.vec_id = a JOIN vectors q ON q.vec_id = b GROUP BY 1)""",
    "wt": "SELECT x.tradition || '|' || y.tradition AS block, (coalesce(lower, 0.15) + 0.15) * sqrt(x.n * y.n) AS weight FROM pt x JOIN pt y ON x.tradition < y.tradition LEFT JOIN lb ON block = x.tradition || '|' || y.tradition",
}


def _quotas(t: Tables, budget: int = 1000) -> DataFrame:
    """Of every pair of traditions, labelled or not."""
    return vec.allocate(vec.tradition_weights(t.vectors, t.vector_labels), budget, 10)


@query("SELECT block, (least(10, floor(1000 / n)) + round_even((1000 - least(10, floor(1000 / n)) * n) * weight / s, 0))::INT AS quota FROM (SELECT *, count(*) OVER () AS n, sum(weight) OVER () AS s FROM wt)", _ALLOC)
def budget_alloc(t: Tables) -> DataFrame:
    """A floor and a share by weight for every pair of traditions, labelled or not."""
    return _quotas(t).select("block", "quota")


@query()
def select_budget(t: Tables) -> DataFrame:
    return vec.fill_from(t.vectors, "tradition", _quotas(t), cap=3)


@query()
def select_hybrid(t: Tables) -> DataFrame:
    """Everyone's three nearest in any case, and the budgeted fill of the rest."""
    near = checkpointed(vec.neighbours(t.vectors, 3))
    sure = checkpointed(vec.unordered(near).select("a", "b", "sim"))
    third = near.where("rank = 3").select(F.col("i").alias("vec_id"), F.col("sim").alias("known"))
    return sure.unionByName(vec.fill_from(t.vectors, "tradition", _quotas(t), cap=3, but=sure, known=third))


@query()
def select_worklevel(t: Tables) -> DataFrame:
    """Blocks of works: pairs at their block's 90th percentile or more, filled by quotas from shrunk yields that spend as much as select_current."""
    quotas = vec.allocate_whole(vec.work_weights(t.vectors, t.vector_labels), _current(t).count())
    return vec.fill_from(t.vectors, "work", quotas, cap=2, share=0.9)


@query("SELECT DISTINCT a, b FROM (SELECT a, b FROM cur UNION ALL SELECT a, b FROM un WHERE rank <= 2)", _CUR)
def hybrid_candidates(t: Tables) -> DataFrame:
    # a pair's better rank is 2 or less if one of its ends has it among its two nearest: ten hold both selections
    near = checkpointed(vec.neighbours(t.vectors, 10))
    first = vec.unordered(near.where("rank <= 2")).select("a", "b")
    return _current(t, near).select("a", "b").union(first).distinct()


#: Vectors whose passage has a text.
_READABLE = {"readable": "SELECT DISTINCT doc_id AS vec_id FROM documents WHERE length(text) > 0"}


def _readable(t: Tables) -> DataFrame:
    return t.raw("documents").where(F.length("text") > 0).select(F.col("doc_id").alias("vec_id")).distinct()


_ARMS = _CUR | {
    "ch": "SELECT a, b FROM un WHERE rank BETWEEN 2 AND 12",
    "pa": """SELECT 'shared' AS arm, a, b FROM (SELECT DISTINCT a, b FROM cur) SEMI JOIN ch USING (a, b) UNION ALL SELECT 'current_only', a, b FROM (SELECT DISTINCT a, b FROM cur) ANTI JOIN ch USING (a, b)
        UNION ALL SELECT 'challenger_only', a, b FROM ch ANTI JOIN cur USING (a, b)""",
}


@query("SELECT arm, a, b FROM (SELECT *, row_number() OVER (PARTITION BY arm ORDER BY sha256('13:' || a || ':' || b)) AS r FROM pa WHERE a IN (SELECT vec_id FROM readable) AND b IN (SELECT vec_id FROM readable)) WHERE r <= 60", _ARMS | _READABLE)
def probe_arms(t: Tables) -> DataFrame:
    # better ranks up to 12 show among the twelve nearest; both sides are read twice
    near = checkpointed(vec.neighbours(t.vectors, 12))
    challenger = checkpointed(vec.unordered(near).where("rank BETWEEN 2 AND 12").select("a", "b"))
    current = checkpointed(_current(t, near).select("a", "b"))
    return pairs.probe_arms(current, challenger, _readable(t), 60, "13")


_DRAW = "('0x' || substr(sha256('17:' || {side} || ':' || r), 1, 8))::BIGINT"
_RANDOM = {
    "pl": "SELECT vec_id, tradition, row_number() OVER (ORDER BY sha256('17:' || vec_id), vec_id) - 1 AS place, count(*) OVER () AS n FROM vectors",
    "dw": f"SELECT r, {_DRAW.format(side=chr(39) + 'x' + chr(39))} % n AS x, {_DRAW.format(side=chr(39) + 'y' + chr(39))} % n AS y FROM range(2000) t(r), (SELECT max(n) AS n FROM pl)",
    "pr": "SELECT least(p.vec_id, q.vec_id) AS a, greatest(p.vec_id, q.vec_id) AS b, min(r) AS r FROM dw JOIN pl p ON p.place = x JOIN pl q ON q.place = y WHERE p.tradition <> q.tradition GROUP BY 1, 2",
}


@query("SELECT a, b FROM (SELECT *, row_number() OVER (ORDER BY r) AS k FROM pr ANTI JOIN vector_labels USING (a, b)) WHERE k <= 100", _RANDOM)
def random_pairs(t: Tables) -> DataFrame:
    """The first hundred of 2,000 hashed draws of two places that are unlabelled pairs of different traditions, each once."""
    return vec.drawn_pairs(t.vectors, t.vector_labels, 100, 2000, "17")


_SCORER = _RANDOM | _SIMS | {
    "n2": "SELECT * FROM (SELECT i, j, row_number() OVER (PARTITION BY i ORDER BY sim DESC, j) AS rank FROM sims) WHERE rank <= 200",
    "ed": "SELECT i, j FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY sha256('37:' || i || ':' || j)) AS k FROM (SELECT a AS i, b AS j FROM vector_labels WHERE positive UNION SELECT b, a FROM vector_labels WHERE positive)) WHERE k <= 8",
    "hn": "SELECT i, j FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY sha256('37:' || i || ':' || j)) AS k FROM n2 WHERE rank >= 16) WHERE k <= 5",
    "rd": "SELECT p.vec_id AS i, q.vec_id AS j FROM pl p, range(2) t(r) JOIN pl q ON q.place = ('0x' || substr(sha256('37:' || p.vec_id || ':' || r), 1, 8))::BIGINT % p.n WHERE p.vec_id <> q.vec_id",
    "al": "SELECT i, j, 1 AS s FROM n2 WHERE rank <= 15 UNION ALL SELECT i, j, 2 FROM ed UNION ALL SELECT i, j, 3 FROM hn UNION ALL SELECT i, j, 4 FROM rd",
}


@query("SELECT i, j, ['baseline', 'edge', 'hardneg', 'random'][min(s)] AS stratum FROM al GROUP BY 1, 2", _SCORER)
def scorer_pairs(t: Tables) -> DataFrame:
    """Query and passage pairs: the 15 nearest, up to 8 known partners, 5 drawn from ranks 16 to 200, 2 of all; the first stratum keeps a pair."""
    return vec.scorer_pairs(t.vectors, t.vector_labels.where("positive"), "37")


@query("SELECT a, b, positive FROM (SELECT *, row_number() OVER (PARTITION BY positive ORDER BY sha256('19:' || a || ':' || b)) AS r FROM vector_labels SEMI JOIN un USING (a, b)) WHERE r <= 40", _UN)
def calibration_arm(t: Tables) -> DataFrame:
    """Labelled pairs among the candidates, as many of each label, whose gold column is withheld from judges."""
    known = t.vector_labels.join(vec.unordered(vec.neighbours(t.vectors, 50)), ["a", "b"], "left_semi")
    w = Window.partitionBy("positive").orderBy(shuffle_key("19", "a", "b"))
    return known.withColumn("r", F.row_number().over(w)).where("r <= 40").select("a", "b", "positive")


_HELD = {
    "un_": "SELECT tradition, work, row_number() OVER (PARTITION BY tradition ORDER BY sha256('43:' || work), work) AS place, count(*) OVER (PARTITION BY tradition) AS n FROM (SELECT DISTINCT tradition, work FROM vectors)",
    "hd": "SELECT work, n = 1 AS only FROM un_ WHERE n = 1 OR place <= least(n - 1, greatest(1, round_even(n * 0.3, 0)))",
}


@query(
    f"""SELECT a, b, band, turn, leak FROM (SELECT *, row_number() OVER (ORDER BY turn, band, ta) AS pick FROM (SELECT *, row_number() OVER (PARTITION BY band, ta ORDER BY sha256('23:' || a || '-' || b), a || '-' || b) AS turn FROM
    (SELECT u.a, u.b, {_BAND} AS band, p.tradition AS ta, CASE WHEN x.only OR y.only THEN 'text-disjoint' ELSE 'work-disjoint' END AS leak FROM un u ANTI JOIN vector_labels l ON l.a = u.a AND l.b = u.b
    JOIN vectors p ON p.vec_id = u.a JOIN vectors q ON q.vec_id = u.b JOIN hd x ON x.work = p.work JOIN hd y ON y.work = q.work
    WHERE rank > 5 AND u.a IN (SELECT vec_id FROM readable) AND u.b IN (SELECT vec_id FROM readable)))) WHERE pick <= 120""",
    _UN | _READABLE | _HELD,
)
def band_eval_set(t: Tables) -> DataFrame:
    """Unlabelled candidates below rank 5 with texts, inside the held-out works, one of each band and tradition in turn."""
    c = vec.unordered(vec.neighbours(t.vectors, 50)).where("rank > 5").join(t.vector_labels, ["a", "b"], "left_anti")
    held = pairs.held_candidates(c, t.vectors, _readable(t), 0.3, "43")
    held = held.withColumns({"band": vec.sub_band(F.col("rank")), "key": F.concat_ws("-", "a", "b")})
    return pairs.stratified(held, ["band", "ta"], 120, "23", "key").select("a", "b", "band", "turn", "leak")


# Geometry.
_CELLS = {"vc": "SELECT vec_id, tradition, work, 'c' || (vec_id % 7) AS concept, v FROM vectors"}
_LONG = {
    "lg": "SELECT vec_id, tradition, concept, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS pos FROM vc",
    "cm": "SELECT tradition, concept, pos, avg(x) AS x, count(*) AS n FROM lg GROUP BY 1, 2, 3",
    "tm": "SELECT tradition, pos, avg(x) AS x FROM lg GROUP BY 1, 2",
    "df": "SELECT c.tradition, c.concept, c.pos, c.x - t.x AS x FROM cm c JOIN tm t USING (tradition, pos) WHERE n >= 5",
    "dr": "SELECT tradition, concept, list(x / l ORDER BY pos) AS v FROM df JOIN (SELECT tradition, concept, sqrt(sum(x * x)) AS l FROM df GROUP BY 1, 2) USING (tradition, concept) WHERE l > 0 GROUP BY 1, 2",
}
_GOLD = _CELLS | _LONG | {
    "gd": """SELECT a.tradition AS ta, b.tradition AS tb, a.concept, (substr(a.tradition, 6)::INT + substr(b.tradition, 6)::INT + substr(a.concept, 2)::INT) % 5 AS verdict
        FROM (SELECT DISTINCT tradition, concept FROM vc) a JOIN (SELECT DISTINCT tradition, concept FROM vc) b ON a.concept = b.concept AND a.tradition < b.tradition
        WHERE (substr(a.tradition, 6)::INT * 3 + substr(b.tradition, 6)::INT) % 4 = 0""",
    "gc": "SELECT g.*, list_dot_product(a.v, b.v) AS cosine FROM gd g LEFT JOIN dr a ON a.tradition = ta AND a.concept = g.concept LEFT JOIN dr b ON b.tradition = tb AND b.concept = g.concept",
}


def _cells(t: Tables) -> DataFrame:
    return t.vectors.selectExpr("vec_id", "tradition", "work", "concat('c', vec_id % 7) AS concept", "v")


def _gold(t: Tables) -> DataFrame:
    c = _cells(t).select("tradition", "concept").distinct()
    both = c.selectExpr("tradition AS ta", "concept").join(c.selectExpr("tradition AS tb", "concept"), "concept").where("ta < tb")
    num = lambda x: f"cast(substring({x}, 6) AS int)"
    return both.where(f"({num('ta')} * 3 + {num('tb')}) % 4 = 0").withColumn("verdict", F.expr(f"({num('ta')} + {num('tb')} + cast(substring(concept, 2) AS int)) % 5"))


def _scored(t: Tables) -> DataFrame:
    return geo.pair_cosines(_gold(t), geo.directions(_cells(t), 5))


@query("SELECT tradition_id AS tradition, target_id AS concept, count(*) AS n FROM edges JOIN nodes ON id = source_id WHERE edges.type = 'EXPRESSES' AND nodes.type = 'chunk' GROUP BY 1, 2 HAVING count(*) >= 2")
def expresses_cells(t: Tables) -> DataFrame:
    chunk = t.nodes.where("type = 'chunk'").selectExpr("id AS source_id", "tradition_id AS tradition")
    cells = t.edges.where("type = 'EXPRESSES'").join(chunk, "source_id").groupBy("tradition", F.col("target_id").alias("concept"))
    return cells.agg(F.count("*").alias("n")).where("n >= 2")


@query(
    """SELECT tradition, concept, chunk_id, n FROM (SELECT tradition_id AS tradition, target_id AS concept, source_id AS chunk_id, count(*) OVER (PARTITION BY tradition_id, target_id) AS n
    FROM edges JOIN nodes ON id = source_id WHERE edges.type = 'EXPRESSES' AND nodes.type = 'chunk') WHERE n >= 2"""
)
def cell_table(t: Tables) -> DataFrame:
    """The passages of each cell of concept and tradition that holds enough of them."""
    chunk = t.nodes.where("type = 'chunk'").selectExpr("id AS source_id", "tradition_id AS tradition")
    tagged = t.edges.where("type = 'EXPRESSES'").join(chunk, "source_id").selectExpr("tradition", "target_id AS concept", "source_id AS chunk_id")
    return geo.cell_table(tagged, 2)


@query("SELECT ta, tb, concept, verdict FROM gd WHERE verdict <> 0", _GOLD)
def gold_kept(t: Tables) -> DataFrame:
    """Gold pairs without the rejected ones."""
    return _gold(t).where("verdict <> 0")


@query("SELECT tradition, concept, pos, round_even(x, 6) AS x FROM cm WHERE n >= 5", _CELLS | _LONG)
def cell_centroids(t: Tables) -> DataFrame:
    means = geo.mean_vectors(_cells(t), ["tradition", "concept"], 5)
    return means.select("tradition", "concept", F.posexplode("v").alias("pos", "x")).withColumn("x", rounded("x"))


@query("SELECT tradition, concept, unnest(generate_series(0, 63)) AS pos, round_even(unnest(v), 6) AS x FROM dr", _CELLS | _LONG)
def centroid_directions(t: Tables) -> DataFrame:
    return geo.directions(_cells(t), 5).select("tradition", "concept", F.posexplode("v").alias("pos", "x")).withColumn("x", rounded("x"))


_NEG = _CELLS | {
    "wk": "SELECT tradition, work, count_if(concept = 'c1') AS k, count_if(concept <> 'c1') AS avail FROM vc GROUP BY 1, 2",
    "ng": """SELECT n.vec_id, n.tradition, n.place <= least(k * 3, avail) AS w FROM (SELECT *, row_number() OVER (PARTITION BY tradition, work ORDER BY sha256('29:' || vec_id)) AS place FROM vc WHERE concept <> 'c1') n JOIN wk USING (tradition, work)""",
}


@query(
    """SELECT vec_id, tradition, 'work' AS pick FROM ng WHERE w UNION ALL SELECT vec_id, tradition, 'rest' FROM (SELECT *, row_number() OVER (PARTITION BY tradition ORDER BY sha256('29:' || vec_id)) AS r FROM ng WHERE NOT w)
    JOIN (SELECT tradition, sum(k * 3 - least(k * 3, avail)) AS due FROM wk GROUP BY 1) USING (tradition) WHERE r <= due""",
    _NEG,
)
def matched_negatives(t: Tables) -> DataFrame:
    return geo.matched_negatives(_cells(t).drop("v"), "c1", "29")


@query(
    """SELECT tradition, pos, round_even(x / l, 6) AS x FROM dm JOIN (SELECT tradition, sqrt(sum(x * x)) AS l FROM dm GROUP BY 1) USING (tradition) WHERE l > 0""",
    _NEG
    | {
        "pk": """SELECT vec_id, tradition FROM ng WHERE w UNION ALL SELECT vec_id, tradition FROM (SELECT *, row_number() OVER (PARTITION BY tradition ORDER BY sha256('29:' || vec_id)) AS r FROM ng WHERE NOT w)
            JOIN (SELECT tradition, sum(k * 3 - least(k * 3, avail)) AS due FROM wk GROUP BY 1) USING (tradition) WHERE r <= due""",
        "lg": "SELECT vec_id, tradition, concept, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS pos FROM vc",
        "dm": """SELECT tradition, pos, h.x - n.x AS x FROM (SELECT tradition, pos, avg(x) AS x FROM lg WHERE concept = 'c1' GROUP BY 1, 2) h
            JOIN (SELECT tradition, pos, avg(x) AS x FROM lg SEMI JOIN pk USING (vec_id) GROUP BY 1, 2) n USING (tradition, pos)""",
    },
)
def dom_directions(t: Tables) -> DataFrame:
    dirs = geo.difference_directions(_cells(t), "c1", "29")
    return dirs.select("tradition", F.posexplode("v").alias("pos", "x")).withColumn("x", rounded("x"))


@query("SELECT ta, tb, concept, verdict, round_even(cosine, 6) AS cosine FROM gc ORDER BY cosine DESC NULLS LAST", _GOLD)
def gold_cosine(t: Tables) -> DataFrame:
    return _scored(t).select("ta", "tb", "concept", "verdict", rounded("cosine").alias("cosine")).orderBy(F.desc_nulls_last("cosine"))


@query(
    """SELECT g.ta, g.tb, g.concept, round_even(100 * avg((n.c < g.cosine - 1e-12)::INT), 6) AS percentile FROM gc g JOIN
    (SELECT a.tradition AS ta, b.tradition AS tb, list_dot_product(a.v, b.v) AS c FROM dr a, dr b WHERE a.tradition < b.tradition) n USING (ta, tb) WHERE g.cosine IS NOT NULL GROUP BY 1, 2, 3""",
    _GOLD,
)
def null_percentile(t: Tables) -> DataFrame:
    out = geo.null_percentiles(_scored(t).where("cosine IS NOT NULL"), geo.directions(_cells(t), 5))
    return out.select("ta", "tb", "concept", rounded("percentile").alias("percentile"))


@query("SELECT CASE WHEN verdict <= 1 THEN '0-1' WHEN verdict = 2 THEN '2' ELSE '3-4' END AS band, count(*) AS n, round_even(avg(cosine), 6) AS mean FROM gc WHERE cosine IS NOT NULL GROUP BY 1", _GOLD)
def gold_metrics(t: Tables) -> DataFrame:
    return geo.gold_metrics(_scored(t))


@query("SELECT round_even(avg(CASE WHEN p.cosine > q.cosine THEN 1 ELSE 0 END), 6) AS auc, count(DISTINCT p) AS n_pos, count(DISTINCT q) AS n_neg FROM (SELECT * FROM gc WHERE verdict >= 3 AND cosine IS NOT NULL) p, (SELECT * FROM gc WHERE verdict <= 1 AND cosine IS NOT NULL) q", _GOLD)
def tail_auc(t: Tables) -> DataFrame:
    tails = _scored(t).where("cosine IS NOT NULL AND verdict <> 2").withColumn("pos", F.col("verdict") >= 3)
    return agreement.auc(tails, "cosine", "pos", ties="strict")


_SWEEP = _GOLD | {
    "dn": "SELECT d.*, n FROM dr3 d JOIN (SELECT tradition, concept, max(n) AS n FROM cm GROUP BY 1, 2) USING (tradition, concept)",
    "sw": """SELECT CASE WHEN substr(sha256('31:' || ta || ':' || tb || ':' || g.concept), 1, 1) < '8' THEN 'tune' ELSE 'test' END AS half, setting, verdict, round(list_dot_product(a.v, b.v), 12) AS cosine
        FROM gd g, (VALUES (3), (7), (8)) s(setting), dn a, dn b WHERE a.tradition = ta AND a.concept = g.concept AND b.tradition = tb AND b.concept = g.concept AND a.n >= setting AND b.n >= setting""",
}
_SWEEP = {k: v for k, v in _SWEEP.items() if k not in ("dr", "gc", "df", "dn", "sw")} | {
    "df": _LONG["df"].replace("n >= 5", "n >= 3"),
    "dr3": _LONG["dr"],
    "dn": _SWEEP["dn"],
    "sw": _SWEEP["sw"],
}


_RHO = """SELECT half, setting, count(*) AS n, round_even(coalesce(nullif(corr(rx, ry), 'nan'::DOUBLE), 0), 6) AS spearman FROM (SELECT *, rank() OVER (PARTITION BY half, setting ORDER BY cosine) + (count(*) OVER (PARTITION BY half, setting, cosine) - 1) / 2 AS rx,
    rank() OVER (PARTITION BY half, setting ORDER BY verdict) + (count(*) OVER (PARTITION BY half, setting, verdict) - 1) / 2 AS ry FROM sw) GROUP BY 1, 2"""


@query(_RHO, _SWEEP)
def sweep_select(t: Tables) -> DataFrame:
    """Rank correlation of verdict and cosine on the tuning half and the test half for several settings."""
    half = _gold(t).withColumn("half", F.when(F.substring(shuffle_key("31", "ta", "tb", "concept"), 1, 1) < "8", "tune").otherwise("test"))
    out = None
    for least in (3, 7, 8):
        scored = geo.pair_cosines(half, geo.directions(_cells(t), least)).where("cosine IS NOT NULL").withColumn("cosine", F.round("cosine", 12))
        one = agreement.spearman(scored, "cosine", "verdict", ["half"]).withColumn("setting", F.lit(least))
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "SELECT x.setting, x.spearman AS tune, y.spearman AS test FROM rs x LEFT JOIN rs y ON y.setting = x.setting AND y.half = 'test' WHERE x.half = 'tune' ORDER BY x.spearman DESC, x.setting LIMIT 1",
    _SWEEP | {"rs": _RHO},
)
def best_config(t: Tables) -> DataFrame:
    """The limit is the feature: the setting that the tuning half likes best, the first on ties, and what the test half says of it."""
    rows = checkpointed(sweep_select(t))
    test = rows.where("half = 'test'").select("setting", F.col("spearman").alias("test"))
    best = rows.where("half = 'tune'").orderBy(F.desc("spearman"), "setting").limit(1)
    return best.join(test, "setting", "left").select("setting", F.col("spearman").alias("tune"), "test")


# Derived relations.
_VIA = {
    "pe": "SELECT source_id, target_id FROM edges WHERE type = 'PARALLELS'",
    "ex": "SELECT source_id AS chunk, target_id AS via FROM edges WHERE type = 'EXPRESSES'",
    "ev": "SELECT p.source_id, p.target_id, x.via FROM pe p LEFT JOIN (SELECT p.source_id, p.target_id, a.via FROM pe p JOIN ex a ON a.chunk = p.source_id JOIN ex b ON b.chunk = p.target_id AND b.via = a.via) x USING (source_id, target_id)",
    "cs": "SELECT chunk_id, concept_id, max(score) AS score FROM staged_tags WHERE status <> 'rejected' GROUP BY 1, 2",
    "eg": """SELECT source_id, target_id, count(via) AS n_vias, max(g) AS grade, max_by(via, (g, 1)) FILTER (false) AS x, (min(struct_pack(a := -g, b := via)) FILTER (g IS NOT NULL)).b AS via FROM
        (SELECT e.*, CASE WHEN s.score IS NOT NULL AND t.score IS NOT NULL THEN least(s.score, t.score) END AS g FROM ev e LEFT JOIN cs s ON s.chunk_id = source_id AND s.concept_id = via LEFT JOIN cs t ON t.chunk_id = target_id AND t.concept_id = via) GROUP BY 1, 2""",
}


def _parallels(t: Tables) -> DataFrame:
    return t.edges.where("type = 'PARALLELS'").select("source_id", "target_id")


def _vias(t: Tables) -> DataFrame:
    return geo.edge_vias(_parallels(t), t.edges.where("type = 'EXPRESSES'"))


def _grades(t: Tables) -> DataFrame:
    scores = t.staged_tags.where("status <> 'rejected'").groupBy("chunk_id", "concept_id").agg(F.max("score").alias("score"))
    return geo.edge_grades(_vias(t), scores)


@query("SELECT source_id, target_id, via FROM ev", _VIA)
def edge_via(t: Tables) -> DataFrame:
    return _vias(t)


@query("SELECT source_id, target_id, n_vias, grade, via FROM eg", _VIA)
def edge_grades(t: Tables) -> DataFrame:
    return _grades(t)


@query("SELECT source_id, target_id, n_vias = 0 AS empty FROM eg WHERE n_vias = 0 OR grade <= (SELECT quantile_cont(grade, 0.1) FROM eg)", _VIA)
def suspect_queue(t: Tables) -> DataFrame:
    g = _grades(t)
    low = g.agg(F.percentile("grade", F.lit(0.1)).alias("p10"))  # one row
    return g.crossJoin(F.broadcast(low)).where("n_vias = 0 OR grade <= p10").select("source_id", "target_id", (F.col("n_vias") == 0).alias("empty"))


@query(
    """SELECT least(n_vias, 5) AS vias, count(*) AS n, round_even(quantile_cont(grade, 0.05), 6) AS p05, round_even(quantile_cont(grade, 0.5), 6) AS p50, round_even(quantile_cont(grade, 0.95), 6) AS p95 FROM eg GROUP BY 1""",
    _VIA,
)
def curation_report(t: Tables) -> DataFrame:
    p = lambda q: rounded(F.percentile("grade", F.lit(q)))
    return _grades(t).groupBy(F.least(F.lit(5), "n_vias").alias("vias")).agg(F.count("*").alias("n"), p(0.05).alias("p05"), p(0.5).alias("p50"), p(0.95).alias("p95"))


@query("SELECT node, count(*) AS degree FROM (SELECT source_id AS node FROM pe UNION ALL SELECT target_id FROM pe) GROUP BY 1 ORDER BY degree DESC, node LIMIT 10", _VIA)
def degree_hubs(t: Tables) -> DataFrame:
    """The limit is the feature: the ten best-connected passages."""
    ends = _parallels(t).select(F.explode(F.array("source_id", "target_id")).alias("node"))
    return ends.groupBy("node").agg(F.count("*").alias("degree")).orderBy(F.desc("degree"), "node").limit(10)


_PANEL = {
    "sc": "SELECT 'c' || c AS via, vec_id AS chunk, tradition, ((vec_id * 37 + c * 11 + (vec_id % 13) * c) % 100) / 100 AS score FROM vectors, range(7) r(c)",
    "gs": "SELECT * FROM sc WHERE score >= 0.7",
    "rn": "SELECT via, chunk AS partner, tradition AS tp, row_number() OVER (PARTITION BY via ORDER BY score DESC, chunk) AS round FROM gs",
    "ft": "SELECT anchor, partner, x.round AS round, x.via AS via FROM (SELECT g.chunk AS anchor, r.partner, min(struct_pack(round := r.round, via := r.via)) AS x FROM gs g JOIN rn r USING (via) WHERE g.tradition <> r.tp GROUP BY 1, 2)",
    "rd": "SELECT anchor, round, coalesce(sum(c) OVER (PARTITION BY anchor ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM (SELECT anchor, round, count(*) AS c FROM ft GROUP BY 1, 2)",
    "dp": "SELECT f.* FROM ft f JOIN rd USING (anchor, round) WHERE b < 10",
}


def _panels(t: Tables) -> DataFrame:
    concept = F.explode(F.sequence(F.lit(0), F.lit(6))).alias("c")
    s = t.vectors.select("vec_id", "tradition", concept).selectExpr("concat('c', c) AS via", "vec_id AS chunk", "tradition", "((vec_id * 37 + c * 11 + (vec_id % 13) * c) % 100) / 100 AS score")
    return geo.derived_panels(s, 0.7, 5)


@query("SELECT anchor, partner, via, round FROM dp", _PANEL)
def derived_panels(t: Tables) -> DataFrame:
    return _panels(t)


_DU = _PANEL | {"du": "SELECT a, b, x.via AS via FROM (SELECT least(anchor, partner) AS a, greatest(anchor, partner) AS b, min(struct_pack(round := round, anchor := anchor, via := via)) AS x FROM dp GROUP BY 1, 2)"}


def _unique(t: Tables) -> DataFrame:
    p = _panels(t).groupBy(F.least("anchor", "partner").alias("a"), F.greatest("anchor", "partner").alias("b"))
    return p.agg(F.min(F.struct("round", "anchor", "via")).alias("x")).select("a", "b", "x.via")


@query("SELECT a, b, via FROM du", _DU)
def derived_unique_pairs(t: Tables) -> DataFrame:
    return _unique(t)


@query("SELECT via, count(*) AS n, min('via ' || replace(c.concept_id, '_', ' ') || ': ' || split_part(c.definition, '.', 1)) AS note FROM du JOIN concepts c ON c.concept_id = 'concept_' || substr(via, 2) GROUP BY 1", _DU)
def derived_annotation(t: Tables) -> DataFrame:
    named = _unique(t).withColumn("concept_id", F.concat(F.lit("concept_"), F.substring("via", 2, 9))).join(F.broadcast(t.concepts), "concept_id")
    note = F.concat(F.lit("via "), F.translate("concept_id", "_", " "), F.lit(": "), F.substring_index("definition", ".", 1))
    return named.groupBy("via").agg(F.count("*").alias("n"), F.min(note).alias("note"))


@query(
    """SELECT i, j, rank, kind FROM (SELECT i, j, rank, 'entrant' AS kind FROM (SELECT * FROM nn WHERE rank <= 12 AND j % 3 <> 0) x ANTI JOIN (SELECT i, j FROM nn WHERE rank <= 8) y USING (i, j)
    UNION ALL SELECT i, j, row_number() OVER (PARTITION BY i ORDER BY rank) AS rank, 'displaced' FROM (SELECT * FROM nn WHERE rank <= 8) y ANTI JOIN (SELECT i, j FROM nn WHERE rank <= 12 AND j % 3 <> 0) x USING (i, j)) WHERE kind = 'entrant' OR rank <= 3""",
    _NN,
)
def ab_entrants(t: Tables) -> DataFrame:
    """What an arm shows that the baseline does not, and the first three that it displaces."""
    # read four times, made once
    nn = checkpointed(vec.neighbours(t.vectors, 50).where("rank <= 12").select("i", "j", "rank"))
    base, arm = nn.where("rank <= 8"), nn.where("rank <= 12 AND j % 3 <> 0")
    new = arm.join(base, ["i", "j"], "left_anti").select("i", "j", "rank", F.lit("entrant").alias("kind"))
    w = Window.partitionBy("i").orderBy("rank")
    gone = base.join(arm, ["i", "j"], "left_anti").withColumn("rank", F.row_number().over(w)).where("rank <= 3")
    return new.unionByName(gone.select("i", "j", "rank", F.lit("displaced").alias("kind")))


@query(
    """SELECT tradition, count(*) AS n, list_sort(list(rank))[(count(*) // 2 + 1)::INT] AS upper_median, round_even(avg((rank <= 20)::INT), 6) AS share, count(DISTINCT tj) AS n_traditions
    FROM (SELECT n.*, p.tradition, q.tradition AS tj FROM nn n JOIN vectors p ON p.vec_id = i JOIN vectors q ON q.vec_id = j WHERE (i + j) % 5 = 0) GROUP BY 1""",
    _NN,
)
def novelty_report(t: Tables) -> DataFrame:
    """Upper median of ranks, share near the top, and traditions reached, of chosen pairs by tradition."""
    tr = t.vectors.select("vec_id", "tradition")
    rows = vec.neighbours(t.vectors, 50).where("(i + j) % 5 = 0").join(tr.selectExpr("vec_id AS i", "tradition"), "i").join(tr.selectExpr("vec_id AS j", "tradition AS tj"), "j")
    # ranks are at most 50: counts of them give the median without a list of all rows
    per = rows.groupBy("tradition", "rank").agg(F.count("*").alias("c"))
    w = Window.partitionBy("tradition")
    run = per.withColumns({"upto": F.sum("c").over(w.orderBy("rank")), "n": F.sum("c").over(w)})
    mid = run.where("upto > floor(n / 2)").groupBy("tradition").agg(F.min("rank").alias("upper_median"))
    share = rows.groupBy("tradition").agg(F.count("*").alias("n"), rounded(F.avg((F.col("rank") <= 20).cast("double"))).alias("share"), F.countDistinct("tj").alias("n_traditions"))
    return share.join(mid, "tradition")


@query("SELECT user_id, event_type, max_by(event_id, ts) AS event_id FROM events GROUP BY 1, 2")
def surfaced_unique(t: Tables) -> DataFrame:
    """The last row of each key."""
    return tagging.latest(t.raw("events"), ["user_id", "event_type"], ["ts"]).select("user_id", "event_type", "event_id")
