"""Selection, de-duplication and assembly of tags, and splits of passages."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.functions.columns import bucket, ratio, shuffle_key, split_name
from tagmill.functions.working import checkpointed


def without_prefixes(tags: DataFrame, prefixes: Sequence[str], model: str = "model") -> DataFrame:
    """Rows whose model starts with none of the prefixes, whatever the case; a null model is dropped."""
    return reduce(lambda df, p: df.where(~F.col(model).ilike(p + "%")), prefixes, tags)


def eligible(
    tags: DataFrame,
    statuses: Sequence[str] = ("accepted",),
    version: str | None = None,
    prefixes: Sequence[str] = (),
    models: Sequence[str] = (),
) -> DataFrame:
    """Rows of given statuses and prompt version, from models that no denylist names."""
    out = tags.where(F.col("status").isin(*statuses))
    if version is not None:
        out = out.where(F.col("prompt_version") == version)
    out = without_prefixes(out, prefixes)
    return out.where(~F.col("model").isin(*models)) if models else out


def supersede(tags: DataFrame, keys: Sequence[str] = ("chunk_id", "concept_id"), order: Sequence[str] = ()) -> DataFrame:
    """One tag for each key: accepted before all others, then the higher score, then the first by `order`."""
    w = Window.partitionBy(*keys).orderBy((F.col("status") == "accepted").desc(), F.col("score").desc(), *order)
    return tags.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str], first: bool = False) -> DataFrame:
    """One row for each key: the last by `order`, or the first."""
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    w = Window.partitionBy(*keys).orderBy(*[c if first else c.desc() for c in by])
    return rows.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def with_tradition(df: DataFrame, nodes: DataFrame, chunk: str, out: str) -> DataFrame:
    """`df` with the tradition of a chunk column: its node's, or else the first part of its id."""
    known = nodes.select(F.col("id").alias(chunk), F.col("tradition_id").alias("t_"))
    joined = df.join(known, chunk, "left")
    return joined.withColumn(out, F.coalesce("t_", F.split_part(F.col(chunk), F.lit("."), F.lit(1)))).drop("t_")


def tagged_chunks(tags: DataFrame) -> DataFrame:
    """One row for each chunk with its tags in the order of their concepts."""
    fields = ["concept_id", "score", "justification", "is_new_concept"]
    nested = F.array_sort(F.collect_list(F.struct(*fields)))
    return tags.groupBy("chunk_id").agg(nested.alias("tags"), F.count("*").alias("n_tags"))


def contributions(eligible_tags: DataFrame, nodes: DataFrame, bodies: DataFrame) -> DataFrame:
    """For each model the rows that survive the denylists, and the tags that are really exported."""
    exported = (
        eligible_tags.join(nodes.where("type = 'chunk'").select(F.col("id").alias("chunk_id")), "chunk_id", "left_semi")
        .join(bodies.select("chunk_id"), "chunk_id", "left_semi")
        .groupBy("model")
        .agg(F.count("*").alias("n_exported"))
    )
    rows = eligible_tags.groupBy("model").agg(F.count("*").alias("n_rows"))
    return rows.join(exported, "model", "left").na.fill(0, ["n_exported"])


def manifest(nodes: DataFrame, tags: DataFrame, edges: DataFrame) -> DataFrame:
    """Six counts of a snapshot in one row, each table scanned once."""
    n = nodes.agg(F.count_if(F.col("type") == "chunk").alias("n_chunks"), F.count_if(F.col("type") == "concept").alias("n_concepts"))
    t = tags.agg(F.count("*").alias("n_tags"), F.count_if(F.col("status") == "accepted").alias("n_accepted"))
    e = edges.agg(F.count_if(F.col("type") == "EXPRESSES").alias("n_expresses"), F.count_if(F.col("type") == "PARALLELS").alias("n_parallels"))
    return n.crossJoin(t).crossJoin(e)  # one row each


def assign_split(chunks: DataFrame, seed: str = "0", val: float = 0.05, test: float = 0.05) -> DataFrame:
    """chunk_id, bucket and split; depends on seed and id alone, so a chunk never changes its split."""
    return chunks.select("chunk_id", bucket(seed, "chunk_id").alias("bucket"), split_name(seed, "chunk_id", val, test).alias("split"))


def stratified_split(chunks: DataFrame, stratum: str, seed: str = "0", val: float = 0.1, test: float = 0.1) -> DataFrame:
    """Splits with the same shares in every stratum: by rank of a hash within it."""
    w = Window.partitionBy(stratum)
    rank = F.row_number().over(w.orderBy(shuffle_key(seed, "chunk_id")))
    place = ratio(rank - 1, F.count("*").over(w))
    return chunks.withColumn("place", place).withColumn(
        "split", F.when(F.col("place") < val, "val").when(F.col("place") < val + test, "test").otherwise("train")
    )


def keyed_split(keys: DataFrame, key: str, seed: str, share: float = 0.1) -> DataFrame:
    """Distinct keys with split val for a share of them (one at least), in the order of a salted hash."""
    ranked = hash_ranked(keys.select(key).distinct(), seed, key)
    val = F.col("rank") <= F.greatest(F.lit(1), F.floor(F.col("n") * share))
    return ranked.select(key, F.when(val, "val").otherwise("train").alias("split"))


def hash_ranked(rows: DataFrame, seed: str, *keys: str) -> DataFrame:
    """`rows` with their rank in the order of a hash of `keys`, and their number n; no task ranks more than a share.

    Rows are ranked within the first four digits of their hash, and the digits' groups, at most 65,536, among
    each other.
    """
    hashed = rows.withColumn("h_", shuffle_key(seed, *keys)).withColumn("p_", F.substring("h_", 1, 4))
    sizes = hashed.groupBy("p_").agg(F.count("*").alias("c_"))
    over = Window.partitionBy(F.lit(0)).orderBy("p_")
    before = sizes.select(
        "p_",
        (F.sum("c_").over(over.rowsBetween(Window.unboundedPreceding, 0)) - F.col("c_")).alias("b_"),
        F.sum("c_").over(Window.partitionBy(F.lit(0))).alias("n"),
    )
    inner = F.row_number().over(Window.partitionBy("p_").orderBy("h_", *keys))
    return hashed.join(F.broadcast(before), "p_").withColumn("rank", F.col("b_") + inner).drop("h_", "p_", "b_")


def dedupe_queries(queries: DataFrame, order: str) -> DataFrame:
    """The first of all queries that are equal but for case and outer white space, with how many there were."""
    k = F.lower(F.regexp_replace("query", r"^[\s\u00a0\u2000-\u200a\u3000]+|[\s\u00a0\u2000-\u200a\u3000]+$", ""))
    keyed = queries.withColumn("k", k)
    return keyed.groupBy("k").agg(F.min_by("query", order).alias("query"), F.count("*").alias("n")).select("query", "n")


def exclude_frozen(queries: DataFrame, frozen: DataFrame) -> DataFrame:
    """Queries whose work is not frozen."""
    return queries.join(frozen.select("work").distinct(), "work", "left_anti")


#: Words of the runs by which texts that may hold an item are found: two doublings of one.
RUN = 4


def _runs(text: str) -> Column:
    """The distinct runs of RUN words between spaces, as hashes; pairs of words first, then pairs of pairs."""
    joined = lambda xs, by: F.zip_with(xs, F.slice(xs, by + 1, F.size(xs)), lambda x, y: F.concat(x, F.lit(" "), y))
    four = joined(joined(F.split(F.col(text), " ", -1), 1), 2)
    # the last places have no run
    return F.array_distinct(F.transform(F.array_compact(four), lambda x: F.xxhash64(x)))


#: Characters of the items that one automaton looks for, apart from a single longer item.
TRIE_CHARS = 1 << 20


def found_briefly(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, n_leaks of items (item_id, item) that a row of docs holds: all items of a batch in one reading of each text.

    A task builds the automaton of its batch, counts the texts that hold each item, and emits its counts at its end.
    """
    texts = checkpointed(items.select("item").distinct())
    size = texts.agg(F.coalesce(F.sum(F.length("item")), F.lit(0))).first()[0]
    batches, parts = -(-size // TRIE_CHARS), []
    whole = docs.agg(F.count("text").alias("n")).select(F.lit("").alias("item"), "n")  # an empty item is everywhere
    for number in range(batches):
        # a batch of bounded size
        some = [r["item"] for r in texts.where("item <> ''").where(F.pmod(F.xxhash64("item"), F.lit(batches)) == number).collect()]
        if some:
            parts.append(docs.select("text").mapInArrow(_counter(some), "item string, n long").groupBy("item").agg(F.sum("n").alias("n")))
    counts = reduce(DataFrame.unionByName, parts, whole)
    return items.join(counts, "item").select("item_id", F.col("n").alias("n_leaks")).where("n_leaks > 0")


def _counter(wanted: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = ahocorasick.Automaton()
        for i, item in enumerate(wanted):
            trie.add_word(item, i)
        trie.make_automaton()
        counts: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                if text.is_valid:
                    counts.update({i for _, i in trie.iter(text.as_py())})
        yield pa.RecordBatch.from_arrays([pa.array([wanted[i] for i in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], ["item", "n"])

    return run


def containments(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, n_leaks: in how many rows of docs (doc_id, text) an item's text stands, wherever it begins.

    A text that holds an item holds the item's inner words as whole words. So an item of RUN + 2 words or more is
    looked for only in the texts that share its rarest inner run of words, and is then compared as it is. Shorter
    items go into automata of TRIE_CHARS characters, each of which reads every text once. A null text holds none, a
    null item is in none, an empty one in every text.
    """
    inner = F.size(F.split("item", " ", -1)) - 2
    named = items.select("item_id", F.col("text").alias("item")).where("item IS NOT NULL")
    cut = F.array_join(F.slice(F.split("item", " ", -1), 2, F.greatest(inner, F.lit(1))), " ")
    long = named.where(inner >= RUN).withColumn("inner", cut)
    gram = long.select("item_id", "item", F.explode(_runs("inner")).alias("run"))
    # only the runs that an item has too are kept
    enough = F.size(F.split("text", " ", -1)) >= RUN + 2
    seen = checkpointed(docs.where(enough).select("doc_id", F.explode(_runs("text")).alias("run")).join(gram.select("run").distinct(), "run", "left_semi"))
    times = seen.groupBy("run").agg(F.count("*").alias("times"))
    rarest = gram.join(times, "run").groupBy("item_id").agg(F.count("*").alias("known"), F.min(F.struct("times", "run")).alias("x"))
    # a text with the item has all of its runs, so an item with a run that no text has is in none
    all_runs = long.select("item_id", F.size(_runs("inner")).alias("runs"))
    rarest = rarest.join(all_runs, "item_id").where("known = runs").select("item_id", F.col("x.run").alias("run"))
    meet = seen.join(rarest, "run").select("doc_id", "item_id").distinct()
    found = meet.join(long.select("item_id", "item"), "item_id").join(docs, "doc_id").where(F.contains(F.col("text"), F.col("item"))).select("item_id")
    brief = found_briefly(docs, named.where(inner < RUN).select("item_id", "item"))
    counts = found.groupBy("item_id").agg(F.count("*").alias("n_leaks")).unionByName(brief)
    return items.select("item_id").join(counts, "item_id", "left").na.fill(0, ["n_leaks"])
