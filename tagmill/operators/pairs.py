"""Relations between passages: outcome matrices, judges' reliability, evaluation sets and quarantine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.functions.columns import pair_key, ratio, rounded, shuffle_key, text_of, tradition_of, wilson_lower
from tagmill.functions.working import places_within
from tagmill.operators.tagging import hash_ranked, with_tradition

EDGE_TYPES = ("PARALLELS", "CONTRASTS", "surface_only", "unrelated")
REVIEWED = ("accepted", "rejected", "reclassified")


def with_traditions(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends' traditions and the unordered pair of them."""
    both = with_tradition(with_tradition(edges, nodes, "source_chunk", "source_tradition"), nodes, "target_chunk", "target_tradition")
    return both.withColumn("tradition_pair", pair_key("source_tradition", "target_tradition"))


def outcome_matrix(edges: DataFrame) -> DataFrame:
    """Outcomes by tradition pair, by text pair and in total: one pass over grouping sets.

    Counts of types are of reviewed rows; accept_rate is the share of positive types accepted among reviewed.
    """
    seen = F.col("status").isin(*REVIEWED)
    positive = seen & (F.col("status") == "accepted") & F.col("edge_type").isin("PARALLELS", "CONTRASTS")
    rows = edges.withColumn("text_pair", pair_key(text_of("source_chunk"), text_of("target_chunk")))
    rows = rows.groupingSets([["tradition_pair"], ["text_pair"], []], "tradition_pair", "text_pair").agg(
        F.grouping_id().alias("level"),
        *[F.count_if(seen & (F.col("edge_type") == k)).alias(k.lower()) for k in EDGE_TYPES],
        F.count_if(F.col("status") == "pending").alias("pending"),
        F.count_if(seen).alias("reviewed"),
        F.count_if(positive).alias("positives"),
        rounded(F.avg(F.when(seen, F.col("confidence")))).alias("mean_conf"),
    )
    return rows.withColumns(
        {
            "accept_rate": rounded(ratio(F.col("positives"), F.col("reviewed"))),
            "wilson": rounded(wilson_lower(F.col("positives"), F.col("reviewed"))),
        }
    )


def yields(edges: DataFrame, key: Column) -> DataFrame:
    """accepted and total reviewed edges of each unordered key."""
    seen = edges.where(F.col("status").isin(*REVIEWED))
    return seen.groupBy(key.alias("key")).agg(F.count_if(F.col("status") == "accepted").alias("accepted"), F.count("*").alias("total"))


def shrunk(works: DataFrame, groups: DataFrame, k: float = 5.0) -> DataFrame:
    """Yields of works pulled towards those of their tradition pair: (accepted + k rate) / (total + k); 0.5 without one."""
    rates = groups.select(F.col("key").alias("tradition_pair"), ratio(F.col("accepted"), F.col("total")).alias("rate"))
    joined = works.join(F.broadcast(rates), "tradition_pair", "left").na.fill(0.5, ["rate"])
    return joined.withColumn("shrunk", rounded((F.col("accepted") + k * F.col("rate")) / (F.col("total") + k)))


def partition_cost(edges: DataFrame, holdout: DataFrame) -> DataFrame:
    """Edges with no, both or one end in the holdout, each once, however often the holdout has an id."""
    held = holdout.select(F.col("chunk_id").alias("c"), F.lit(1).alias("in_")).distinct()
    side = lambda df, c: df.join(held.select(F.col("c").alias(c), F.col("in_").alias(f"in_{c}")), c, "left")
    both = side(side(edges, "source_chunk"), "target_chunk").na.fill(0, ["in_source_chunk", "in_target_chunk"])
    ends = F.col("in_source_chunk") + F.col("in_target_chunk")
    kind = F.when(ends == 0, "train").when(ends == 2, "eval").otherwise("straddle")
    return both.groupBy(kind.alias("part")).agg(F.count("*").alias("n"))


def symmetry(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """How far verdicts in both orders agree with each other and with the gold label; unparsed rows do not count."""
    positive = lambda c: F.col(c).isin("PARALLELS", "CONTRASTS")
    ab, ba, gold = positive("ab_edge_type"), positive("ba_edge_type"), F.col("gold_positive")
    both = results.where(F.col("ab_edge_type").isNotNull() & F.col("ba_edge_type").isNotNull())
    share = lambda c: F.avg(c.cast("double"))
    consistent = ab == ba
    out = both.groupBy(*(by or [])).agg(
        F.count("*").alias("n"),
        share(F.col("ab_edge_type") == F.col("ba_edge_type")).alias("exact"),
        share(consistent).alias("binary"),
        share(~consistent).alias("flip"),
        share(ab == gold).alias("ab_agree"),
        share(ba == gold).alias("ba_agree"),
        F.avg(F.when(consistent, (ab == gold).cast("double"))).alias("agree_consistent"),
    )
    out = out.withColumn("lift", F.try_divide("agree_consistent", "ab_agree"))
    return out.select(*(by or []), "n", *[rounded(c).alias(c) for c in out.columns if c not in [*(by or []), "n"]])


def arm_rates(judged: DataFrame) -> DataFrame:
    """Rates of each arm, and the challenger's less the judge's bias on the shared arm, not below 0."""
    labelled = F.col("gold").isNotNull()
    per = judged.groupBy("arm").agg(
        F.count("*").alias("n"),
        F.avg(F.col("judge").cast("double")).alias("judge_pos"),
        F.avg(F.col("gold").cast("double")).alias("gold_pos"),
        F.avg(F.when(labelled, (F.col("judge") == F.col("gold")).cast("double"))).alias("agree"),
    )
    bias = per.where("arm = 'shared'").select((F.col("judge_pos") - F.col("gold_pos")).alias("bias"))  # one row
    out = per.crossJoin(F.broadcast(bias)).withColumn("corrected", F.greatest(F.lit(0.0), F.col("judge_pos") - F.col("bias")))
    return out.select("arm", "n", *[rounded(c).alias(c) for c in ("judge_pos", "gold_pos", "agree", "bias", "corrected")])


def completeness(expected: DataFrame, graded: DataFrame, valid: Column) -> DataFrame:
    """Counts of missing, repeated, unexpected and malformed grades, and whether the set may be frozen."""
    ids = graded.where(valid).groupBy("idx").agg(F.count("*").alias("times"))
    both = expected.select("idx", F.lit(1).alias("due")).join(ids, "idx", "full")
    counts = both.agg(
        F.count_if(F.col("times").isNull()).alias("missing"),
        F.count_if(F.col("times") > 1).alias("repeated"),
        F.count_if(F.col("due").isNull()).alias("extra"),
    )
    bad = graded.agg(F.count_if(~valid).alias("malformed"))
    out = counts.crossJoin(bad)  # one row each
    return out.withColumn("may_freeze", (F.col("missing") + F.col("repeated") + F.col("malformed")) == 0)


def stratified(rows: DataFrame, strata: list[str], quota: int, seed: str, key: str) -> DataFrame:
    """A sample that takes one row of each stratum in turn until the quota is full.

    A row's turn is its place in its stratum by a hash; `pick` orders rows by turn and stratum, counted by ranges
    of that order, so no task sees the turns of all strata.
    """
    w = Window.partitionBy(*strata).orderBy(shuffle_key(seed, key), key)
    turns = rows.withColumn("turn", F.row_number().over(w)).where(F.col("turn") <= quota)
    picked = places_within(turns, [], [F.col("turn"), *[F.col(s) for s in strata]], "pick").where(F.col("pick") <= quota)
    return picked.withColumn("pick", F.col("pick").cast("int"))


def holdout_units(units: DataFrame, share: float, seed: str) -> DataFrame:
    """For each tradition of two units or more, the held-out ones: about a share, one at least, never all."""
    w = Window.partitionBy("tradition")
    n = F.count("*").over(w)
    ranked = units.withColumn("n", n).withColumn("place", F.row_number().over(w.orderBy(shuffle_key(seed, "unit"), "unit")))
    k = F.least(F.col("n") - 1, F.greatest(F.lit(1), F.bround(F.col("n") * share, 0)))
    return ranked.where((F.col("n") >= 2) & (F.col("place") <= k)).select("tradition", "unit")


def held_candidates(candidates: DataFrame, vectors: DataFrame, readable: DataFrame, share: float, seed: str) -> DataFrame:
    """Candidates (a, b) with both ends readable and in held-out works, with ta, the first one's tradition, and leak.

    A tradition's only work is held out with it: pairs with it are disjoint by text only, others by work.
    """
    units = vectors.select("tradition", F.col("work").alias("unit")).distinct()
    only = units.groupBy("tradition").agg(F.min("unit").alias("unit"), F.count("*").alias("n")).where("n = 1").select("unit", F.lit(True).alias("only"))
    held = holdout_units(units, share, seed).select("unit", F.lit(False).alias("only")).union(only)
    known = vectors.join(readable, "vec_id", "left_semi").join(held, F.col("work") == F.col("unit")).select("vec_id", "tradition", "only")
    side = lambda c: known.select(F.col("vec_id").alias(c), F.col("tradition").alias(f"t{c}"), F.col("only").alias(f"only_{c}"))
    leak = F.when(F.col("only_a") | F.col("only_b"), "text-disjoint").otherwise("work-disjoint")
    return candidates.join(side("a"), "a").join(side("b"), "b").withColumn("leak", leak).drop("tb", "only_a", "only_b")


def quarantine_plan(tags: DataFrame, suspects: DataFrame) -> DataFrame:
    """Accepted tags of suspect (concept, tradition) cells, and pending ones that they would collide with."""
    rows = tags.withColumn("tradition", tradition_of("chunk_id")).join(F.broadcast(suspects), ["concept_id", "tradition"])
    per = rows.groupBy("concept_id", "tradition", "chunk_id").agg(
        F.count_if(F.col("status") == "accepted").alias("a"), F.count_if(F.col("status") == "pending").alias("p")
    )
    return per.groupBy("concept_id", "tradition").agg(F.sum("a").alias("accepted"), F.count_if((F.col("a") > 0) & (F.col("p") > 0)).alias("collisions"))


def reopened(tags: DataFrame, suspects: DataFrame, stamp: str) -> DataFrame:
    """A new version of the tags: accepted ones of suspect cells are pending again, with a stamped justification."""
    mark = F.broadcast(suspects.select("concept_id", "tradition", F.lit(True).alias("hit")))
    rows = tags.withColumn("tradition", tradition_of("chunk_id")).join(mark, ["concept_id", "tradition"], "left")
    again = F.coalesce("hit", F.lit(False)) & (F.col("status") == "accepted")
    note = F.concat_ws(" ", F.lit(stamp), "justification")
    return rows.withColumns(
        {"justification": F.when(again, note).otherwise(F.col("justification")), "status": F.when(again, "pending").otherwise(F.col("status"))}
    ).drop("hit", "tradition")


def suspect_cells(tags: DataFrame, least: int, home_share: float) -> DataFrame:
    """Cells (concept, tradition) far below the concept's best ones, with its three home traditions as text."""
    n = tags.where("status = 'accepted'").withColumn("tradition", tradition_of("chunk_id")).groupBy("concept_id", "tradition").agg(F.count("*").alias("n_now"))
    w = Window.partitionBy("concept_id").orderBy(F.desc("n_now"), "tradition")
    homes = n.withColumn("place", F.row_number().over(w)).where("place <= 3").groupBy("concept_id")
    shown = F.array_sort(F.collect_list(F.struct("place", F.concat("tradition", F.lit(":"), "n_now").alias("s"))))
    home = homes.agg(F.array_join(F.transform(shown, lambda x: x["s"]), " ").alias("home_top"), F.max("n_now").alias("home_n"))
    return n.join(home, "concept_id").where((F.col("n_now") >= least) & (F.col("n_now") < F.col("home_n") * home_share))


def probe_arms(current: DataFrame, challenger: DataFrame, readable: DataFrame, quota: int, seed: str) -> DataFrame:
    """Up to `quota` pairs each that both selections, only the first, and only the second hold, in hash order."""
    both = current.join(challenger, ["a", "b"], "left_semi").withColumn("arm", F.lit("shared"))
    left = current.join(challenger, ["a", "b"], "left_anti").withColumn("arm", F.lit("current_only"))
    right = challenger.join(current, ["a", "b"], "left_anti").withColumn("arm", F.lit("challenger_only"))
    arms = [
        hash_ranked(x.join(readable.selectExpr("vec_id AS a"), "a", "left_semi").join(readable.selectExpr("vec_id AS b"), "b", "left_semi"), seed, "a", "b")
        .where(F.col("rank") <= quota)
        .select("arm", "a", "b")
        for x in (both, left, right)
    ]
    return reduce(DataFrame.unionByName, arms)
