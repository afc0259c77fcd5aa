"""Directions of concepts in traditions, their cosines and null distributions; derived relations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagmill.functions.columns import dot, norm, rounded, shuffle_key, unit
from tagmill.functions.working import checkpointed, places_within, sums_within

#: Anchors of one concept that meet its list's head in one task.
SLICE = 20_000


def mean_vectors(rows: DataFrame, by: list[str], least: int = 1) -> DataFrame:
    """The mean of `v` of each group of `least` rows or more; sums by component, so groups may be of any size."""
    parts = rows.select(*by, F.posexplode("v").alias("pos", "x")).groupBy(*by, "pos").agg(F.avg("x").alias("x"), F.count("*").alias("n"))
    back = F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"])
    return parts.where(F.col("n") >= least).groupBy(*by).agg(back.alias("v"), F.max("n").alias("n"))


def cell_table(tagged: DataFrame, least: int) -> DataFrame:
    """tradition, concept, chunk_id, n: the rows of each cell of `least` rows or more; counts first, so cells may be of any size.

    Rows without a tradition are a cell of their own for each concept.
    """
    sizes = tagged.groupBy(F.col("tradition").alias("t_"), F.col("concept").alias("c_")).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    same = F.col("tradition").eqNullSafe(F.col("t_")) & F.col("concept").eqNullSafe(F.col("c_"))
    return tagged.join(sizes, same).select("tradition", "concept", "chunk_id", "n")


def directions(cells: DataFrame, least: int) -> DataFrame:
    """tradition, concept, v: a cell's mean less its tradition's, of unit length; zero ones are dropped."""
    base = mean_vectors(cells, ["tradition"]).select("tradition", F.col("v").alias("base"))
    both = mean_vectors(cells, ["tradition", "concept"], least).join(F.broadcast(base), "tradition")
    moved = both.withColumn("v", F.zip_with("v", "base", lambda a, b: a - b)).where(norm("v") > 0)
    return moved.select("tradition", "concept", unit("v").alias("v"))


def matched_negatives(cells: DataFrame, concept: str, seed: str, times: int = 3) -> DataFrame:
    """vec_id, tradition, pick of negatives for a concept: from each work `times` its positives as far as it has
    them ("work"), and what is short from the rest of the tradition ("rest"), both in hash order."""
    is_positive = F.col("concept") == concept
    works = cells.groupBy("tradition", "work").agg(F.count_if(is_positive).alias("k"), F.count_if(~is_positive).alias("avail"))
    works = works.withColumn("take", F.least(F.col("k") * times, F.col("avail"))).withColumn("short", F.col("k") * times - F.col("take"))
    short = works.groupBy("tradition").agg(F.sum("short").alias("due"))
    ranked = places_within(cells.where(~is_positive), ["tradition", "work"], [shuffle_key(seed, "vec_id")], "place").join(works, ["tradition", "work"]).join(short, "tradition")
    taken = ranked.where(F.col("place") <= F.col("take")).select("vec_id", "tradition", F.lit("work").alias("pick"))
    left = ranked.where(F.col("place") > F.col("take")).drop("place")
    more = places_within(left, ["tradition"], [shuffle_key(seed, "vec_id")], "place").where(F.col("place") <= F.col("due"))
    return taken.unionByName(more.select("vec_id", "tradition", F.lit("rest").alias("pick")))


def difference_directions(cells: DataFrame, concept: str, seed: str) -> DataFrame:
    """tradition, v: mean of a concept's vectors less the mean of its matched negatives, of unit length."""
    negative = matched_negatives(cells, concept, seed).join(cells.select("vec_id", "v"), "vec_id")
    low = mean_vectors(negative.select("tradition", "v"), ["tradition"]).select("tradition", F.col("v").alias("low"))
    high = mean_vectors(cells.where(F.col("concept") == concept).select("tradition", "v"), ["tradition"])
    moved = high.join(low, "tradition").withColumn("v", F.zip_with("v", "low", lambda a, b: a - b)).where(norm("v") > 0)
    return moved.select("tradition", unit("v").alias("v"))


def pair_cosines(gold: DataFrame, dirs: DataFrame) -> DataFrame:
    """`gold` (ta, tb, concept) with the cosine of both cells' directions; null where one is missing."""
    a = dirs.select(F.col("tradition").alias("ta"), "concept", F.col("v").alias("va"))
    b = dirs.select(F.col("tradition").alias("tb"), "concept", F.col("v").alias("vb"))
    both = gold.join(F.broadcast(a), ["ta", "concept"], "left").join(F.broadcast(b), ["tb", "concept"], "left")
    return both.withColumn("cosine", dot("va", "vb")).drop("va", "vb")


def null_percentiles(scored: DataFrame, dirs: DataFrame) -> DataFrame:
    """`scored` with the share, in percent, of all cells of ta against all cells of tb that lie strictly below its cosine.

    The null's cosines and the scored ones of two traditions stand in one order, in which a count runs along. A
    cosine that is null, or has no cells to lie among, has a null percentile.
    """
    traditions, dirs = scored.select("ta", "tb").distinct(), dirs.where("v IS NOT NULL")
    a = dirs.select(F.col("tradition").alias("ta"), F.col("v").alias("va"))
    b = dirs.select(F.col("tradition").alias("tb"), F.col("v").alias("vb"))
    null = traditions.join(a, "ta").join(b, "tb").select("ta", "tb", dot("va", "vb").alias("value_"), F.lit(1).alias("cell_"))
    # a scored value comes before the cells that it equals
    both = scored.withColumns({"value_": F.col("cosine") - 1e-12, "cell_": F.lit(0)}).unionByName(null, allowMissingColumns=True)
    placed = sums_within(both, ["ta", "tb"], [F.col("value_"), F.col("cell_")], {"cell_": "below_"}).where("cell_ = 0")
    sizes = dirs.groupBy("tradition").agg(F.count("*").alias("n"))
    side = lambda c: sizes.select(F.col("tradition").alias(c), F.col("n").alias(f"n_{c}"))
    share = 100 * (F.col("below_") / (F.col("n_ta") * F.col("n_tb")))
    out = placed.join(side("ta"), "ta", "left").join(side("tb"), "tb", "left")
    return out.withColumn("percentile", F.when(F.col("cosine").isNotNull(), share)).select(*scored.columns, "percentile")


def edge_vias(pairs: DataFrame, expresses: DataFrame) -> DataFrame:
    """source_id, target_id, via: the concepts that both ends express; null for a pair without any."""
    left = expresses.select(F.col("source_id"), F.col("target_id").alias("via"))
    right = expresses.select(F.col("source_id").alias("target_id"), F.col("target_id").alias("via"))
    both = pairs.join(left, "source_id").join(right, ["target_id", "via"]).select("source_id", "target_id", "via")
    return pairs.join(both, ["source_id", "target_id"], "left")


def edge_grades(vias: DataFrame, scores: DataFrame) -> DataFrame:
    """source_id, target_id, n_vias, grade, via: the best via by its weaker leg; the first one on ties."""
    side = lambda c: scores.select(F.col("chunk_id").alias(c), F.col("concept_id").alias("via"), F.col("score").alias(f"s_{c}"))
    legs = vias.join(side("source_id"), ["source_id", "via"], "left").join(side("target_id"), ["target_id", "via"], "left")
    grade = F.when(F.col("s_source_id").isNotNull() & F.col("s_target_id").isNotNull(), F.least("s_source_id", "s_target_id"))
    ranked = legs.withColumn("g", grade)
    return ranked.groupBy("source_id", "target_id").agg(F.count("via").alias("n_vias"), F.max("g").alias("grade"), F.min_by("via", F.when(F.col("g").isNotNull(), F.struct(-F.col("g"), F.col("via")))).alias("via"))


def derived_panels(scores: DataFrame, floor: float, top_k: int) -> DataFrame:
    """anchor, partner, via, round: partners of each anchor through its concepts, one for each concept in turn.

    Each round takes one place of every concept's list of chunks by score; a partner of the anchor's own
    tradition uses up its turn; the first concept keeps a partner; picking stops after the round that reaches
    2 top_k partners. A concept may hold all chunks: places are counted by ranges, and its anchors meet the head
    of its list in slices of about SLICE.
    """
    good = checkpointed(places_within(scores.where(F.col("score") >= floor), ["via"], [F.desc("score"), F.col("chunk")], "round"))
    # one row for each concept
    lengths = F.broadcast(good.groupBy("via").agg(F.count("*").alias("length")).withColumn("slices", F.ceil(F.col("length") / SLICE).cast("int")))
    slice_ = F.pmod(F.xxhash64("chunk"), F.col("slices")).cast("int")
    anchors = good.join(lengths, "via").select("via", slice_.alias("slice"), F.col("chunk").alias("anchor"), F.col("tradition").alias("ta"))
    ranked = good.select("via", F.col("chunk").alias("partner"), F.col("tradition").alias("tp"), "round")
    whole = Window.partitionBy("anchor")
    upto = whole.orderBy("round").rowsBetween(Window.unboundedPreceding, -1)
    # few rounds are enough for most anchors, so only the heads of the lists meet; the others look further down
    done, depth = [], 4 * top_k
    while True:
        heads = ranked.where(F.col("round") <= depth).join(lengths, "via").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        met = anchors.join(heads.drop("length", "slices"), ["via", "slice"]).where("ta <> tp")
        first = met.groupBy("anchor", "partner").agg(F.min(F.struct("round", "via")).alias("x")).select("anchor", "partner", "x.*")
        rounds = first.groupBy("anchor", "round").agg(F.count("*").alias("c"))
        rounds = rounds.withColumns({"before": F.coalesce(F.sum("c").over(upto), F.lit(0)), "total": F.sum("c").over(whole)})
        open_ = rounds.where(F.col("before") < 2 * top_k).select("anchor", "round", (F.col("total") < 2 * top_k).alias("short"))
        longest = anchors.join(lengths, "via").groupBy("anchor").agg(F.max("length").alias("length"))
        some = checkpointed(first.join(open_, ["anchor", "round"]).join(longest, "anchor"))
        more = F.col("short") & (F.col("length") > depth)
        done.append(some.where(~more).select("anchor", "partner", "via", F.col("round").cast("int").alias("round")))
        met_none = longest.where(F.col("length") > depth).join(some.where(~more).select("anchor").distinct(), "anchor", "left_anti").select("anchor")
        left = checkpointed(met_none)
        if left.isEmpty():
            return reduce(DataFrame.unionByName, done)
        anchors, depth = anchors.join(left, "anchor", "left_semi"), 8 * depth


def gold_metrics(scored: DataFrame) -> DataFrame:
    """Means of the cosine by band of verdict: 0-1, 2, 3-4."""
    band = F.when(F.col("verdict") <= 1, "0-1").when(F.col("verdict") == 2, "2").otherwise("3-4")
    return scored.where("cosine IS NOT NULL").groupBy(band.alias("band")).agg(F.count("*").alias("n"), rounded(F.avg("cosine")).alias("mean"))
