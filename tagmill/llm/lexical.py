"""Ranked lexical search: document-sharded postings with precomputed integer impacts.

Each task turns its own documents into shards of bounded size, without a shuffle: a sorted dictionary, and per
term a compressed sparse row of documents and impacts. Impacts need only the corpus totals, which one scan gives,
so a stored index answers any later query. A batch of queries of bounded size meets every shard: document
frequencies are lengths of posting rows, summed over shards; then each item's terms add their weighted impacts
to a dense array over the shard's documents, and the best few leave the task. Everything is integer but the
terms' weights, which the driver takes once for a batch.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagmill.llm.common import forget, pack, stored, text_column, text_slices, unpack
from tagmill.llm.wordhash import hashes_of, lowered

#: Text bytes of a shard, apart from a single longer text.
SHARD_BYTES = 12_000_000
#: UTF-8 bytes of query texts that one pass over the index answers, apart from a single longer item.
BATCH_BYTES = 1 << 20
#: Terms whose places are gathered in one go.
_AT_ONCE = 1 << 20
_TERM = np.ones(256, bool)
_TERM[:128] = [chr(c).isascii() and chr(c).isalnum() for c in range(128)]
#: The bytes between terms, for Spark's regular expressions.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SHARD = "ids binary, known binary, words binary, sizes binary, starts binary, docs binary, impacts binary"


@dataclass
class Index:
    """Shards in the shared folder, and the totals that their impacts hold: documents with terms, and terms."""

    shards: DataFrame
    documents: int
    terms: int


def term_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all terms, and the n + 1 bounds of each text among them."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(bounds), np.int64)
    term = _TERM[data]
    first, last = term.copy(), term.copy()
    first[1:] &= ~term[:-1]
    last[:-1] &= ~term[1:]
    # a term at a text's edge ends there
    edges = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(data))]
    first[edges] = term[edges]
    last[edges - 1] = term[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds)


def _gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The strings data[starts:ends] in a row."""
    sizes, out = ends - starts, []
    for a in range(0, len(starts), _AT_ONCE):
        n = sizes[a : a + _AT_ONCE]
        before = np.cumsum(n) - n
        out.append(data[np.arange(int(n.sum())) + np.repeat(starts[a : a + _AT_ONCE] - before, n)].tobytes())
    return b"".join(out)


def dictionary(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of a first occurrence of each distinct term, by hash, and the number of each term among them.

    Terms with one 64-bit hash are told apart by a second one.
    """
    one = hashes_of(data, starts, ends)
    _, first, back = np.unique(one, return_index=True, return_inverse=True)
    two = hashes_of(data, starts, ends, lane=1)
    if (two[first][back] != two).any():
        both = np.empty(len(one), [("a", "<u8"), ("b", "<u8")])
        both["a"], both["b"] = one, two
        _, first, back = np.unique(both, return_index=True, return_inverse=True)
    return first, back


def impacts_of(tf: np.ndarray, owner: np.ndarray, lengths: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """The impact of each posting, from its count, its document and the documents' lengths."""
    if 75 * documents * int(lengths.max(initial=0)) < 1 << 63:
        relative = 75 * documents * lengths // terms
    else:  # exact beyond 64 bits too
        relative = np.array([75 * documents * n // terms for n in lengths.tolist()], np.int64)
    m = 25 + relative
    return 1_000_000_000 * tf // (1000 * tf + 8 * m[owner])


def shard(ids: pa.Array, data: np.ndarray, bounds: np.ndarray, documents: int, terms: int) -> dict[str, bytes]:
    """The shard of some texts: documents without terms are left out of it."""
    data = lowered(data)
    starts, ends, at = term_spans(data, bounds)
    lengths = np.diff(at)
    some = np.flatnonzero(lengths)
    owner = np.repeat(np.arange(len(some)), lengths[some])
    first, back = dictionary(data, starts, ends)
    # one key for each term and document
    keys, tf = np.unique(back.astype(np.int64) * max(len(some), 1) + owner, return_counts=True)
    term, doc = np.divmod(keys, max(len(some), 1))
    sizes = (ends - starts)[first]
    known = np.asarray(ids.is_valid())[some]
    return {
        "ids": pack(np.asarray(ids.fill_null(0)).astype(np.int64)[some]),
        "known": pack(known.view(np.uint8)),
        "words": pack(np.frombuffer(_gathered(data, starts[first], ends[first]), np.uint8)),
        "sizes": pack(sizes.astype(np.uint32)),
        "starts": pack(np.searchsorted(term, np.arange(len(first) + 1)).astype(np.uint32)),
        "docs": pack(doc.astype(np.uint32)),
        "impacts": pack(impacts_of(tf, doc, lengths[some], documents, terms).astype(np.uint32)),
    }


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Index:
    """The index of all whole texts under their integer keys.

    Null, empty and term-less texts are in no shard and not counted. A null key is kept; repeated rows are
    documents each. A text longer than SHARD_BYTES is a shard of its own; its task takes some twenty times its
    bytes. Other columns are not read, whatever their names; an empty table gives an index without shards.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    # runs of other characters become one space; counted without making the terms
    bare = F.btrim(F.regexp_replace(F.coalesce("text", F.lit("")), _BETWEEN, " "))
    n = F.when(F.octet_length("bare") > 0, F.octet_length("bare") - F.octet_length(F.replace("bare", F.lit(" "), F.lit(""))) + 1).otherwise(0)
    sums = rows.select(bare.alias("bare")).agg(F.count_if(n > 0), F.coalesce(F.sum(n.cast("long")), F.lit(0))).first()
    documents, terms = int(sums[0]), int(sums[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        size = 0

        def made() -> pa.RecordBatch:
            offsets = np.cumsum([0, *[len(d) for _, d, _ in held]])
            bounds = np.concatenate([np.zeros(1, np.int64), *[b[1:] + o for (_, _, b), o in zip(held, offsets[:-1])]])
            row = shard(pa.concat_arrays([k for k, _, _ in held]), np.concatenate([d for _, d, _ in held]), bounds, documents, terms)
            held.clear()
            return pa.RecordBatch.from_pydict({c: pa.array([v], pa.binary()) for c, v in row.items()})

        for batch in batches:
            data, bounds = text_column(batch, "text")
            for a, b in text_slices(bounds):
                part = int(bounds[b] - bounds[a])
                if held and size + part > SHARD_BYTES:
                    yield made()
                    size = 0
                held.append((batch.column("key").slice(a, b - a), data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]))
                size += part
        if held:
            yield made()

    return Index(stored(rows.mapInArrow(run, _SHARD), "shards"), documents, terms)


class _Terms:
    """The distinct terms of a batch of items, and each item's terms with their repeats."""

    def __init__(self, texts: list[str | None]) -> None:
        raw = [(t or "").encode() for t in texts]
        data = lowered(np.frombuffer(b"".join(raw), np.uint8))
        starts, ends, at = term_spans(data, np.cumsum([0, *map(len, raw)]))
        first, back = dictionary(data, starts, ends)
        self.words = [data[a:b].tobytes() for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        self.hashes = hashes_of(data, starts[first], ends[first])
        self.items = [np.unique(back[a:b], return_counts=True) for a, b in zip(at.tolist(), at[1:].tolist())]

    def places(self, words: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the terms that a shard's dictionary holds: their numbers and their rows in it."""
        ends = np.cumsum(sizes.astype(np.int64))
        starts = ends - sizes
        have = hashes_of(np.frombuffer(words, np.uint8), starts, ends)
        terms, rows = [], []
        low = np.searchsorted(have, self.hashes)
        for i, j in enumerate(low.tolist()):
            while j < len(have) and have[j] == self.hashes[i]:
                if words[starts[j] : ends[j]] == self.words[i]:
                    terms.append(i)
                    rows.append(j)
                    break
                j += 1
        return np.array(terms, np.int64), np.array(rows, np.int64)


def _open(batch: pa.RecordBatch, i: int, wanted: _Terms) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    get = lambda c, kind: unpack(batch.column(c)[i].as_py(), kind)
    terms, rows = wanted.places(get("words", "uint8").tobytes(), get("sizes", "uint32"))
    return terms, rows, get("starts", "uint32").astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, known: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores above 0, highest first, equal ones by ascending id, unknown ids last."""
    go = np.flatnonzero(scores > 0)
    if len(go) > k:
        least = scores[go[np.argpartition(scores[go], len(go) - k)[len(go) - k]]]
        above, tied = go[scores[go] > least], go[scores[go] == least]
        tied = tied[np.lexsort((ids[tied], ~known[tied]))][: k - len(above)]
        go = np.concatenate([above, tied])
    return go[np.lexsort((ids[go], ~known[go], -scores[go]))]


def _frequencies(index: Index, wanted: _Terms) -> np.ndarray:
    """How many documents hold each term; the driver gets one row for each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(wanted.words), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                terms, rows, starts = _open(batch, i, wanted)
                df[terms] += starts[rows + 1] - starts[rows]
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["term", "df"])

    out = np.zeros(len(wanted.words), np.int64)
    for r in index.shards.select("words", "sizes", "starts").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


def _answers(index: Index, wanted: _Terms, weights: np.ndarray, k: int) -> DataFrame:
    """at, id, score: of each task the k best documents for each item of the batch, and ties cut by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64))] * len(wanted.items)
        for batch in batches:
            for i in range(batch.num_rows):
                ids = unpack(batch.column("ids")[i].as_py(), "int64")
                known = unpack(batch.column("known")[i].as_py(), "uint8").astype(bool)
                terms, rows, starts = _open(batch, i, wanted)
                docs, impacts = (unpack(batch.column(c)[i].as_py(), "uint32") for c in ("docs", "impacts"))
                row = np.full(len(wanted.words), -1)
                row[terms] = rows
                for item, (own, times) in enumerate(wanted.items):
                    scores = np.zeros(len(ids), np.int64)
                    for t, n in zip(own.tolist(), times.tolist()):
                        if row[t] >= 0 and weights[t]:
                            a, b = starts[row[t]], starts[row[t] + 1]
                            scores[docs[a:b]] += n * int(weights[t]) * impacts[a:b].astype(np.int64)
                    top = best(scores, ids, known, k)
                    if len(top):
                        more = [np.concatenate(x) for x in zip(kept[item], (ids[top], known[top], scores[top]))]
                        go = best(more[2], more[0], more[1], k)
                        kept[item] = tuple(x[go] for x in more)
        for item, (ids, known, scores) in enumerate(kept):
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), item)), pa.array(ids, mask=~known), pa.array(scores)], ["at", "id", "score"])

    return index.shards.mapInArrow(run, "at long, id long, score long")


def search(index: Index, queries: DataFrame, key: str = "item_id", text: str = "text", k: int = 10) -> DataFrame:
    """key, rank, doc_id, score: the k documents of the highest score above 0 for each item.

    Equal scores rank by ascending doc_id, a null one last; of equal rows of the index each counts. Items go in
    batches of BATCH_BYTES of text, a longer one alone, and each batch passes over the index twice. Rows with
    one key and text are one item; rows of one key with different texts are items of their own, each with ranks
    from 1; a null key is kept. Items without terms or without matches give no rows, as do empty tables. A key
    column with the name of another result column goes under that name with a leading underscore.
    """
    items = queries.select(F.col(key).alias("key"), F.col(text).alias("text")).distinct()
    size = int(items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0])
    batches = max(1, -(-size // BATCH_BYTES))
    kind = queries.schema[key].dataType
    items = stored(items.withColumn("batch", F.pmod(F.xxhash64("key", "text"), F.lit(batches))), "items")
    spark, parts = queries.sparkSession, []
    for number in range(batches):
        # a batch of bounded size
        rows = items.where(F.col("batch") == number).orderBy("key", "text").collect()
        wanted = _Terms([r["text"] for r in rows])
        df = _frequencies(index, wanted)
        weights = np.array([math.floor(1000 * math.log((2 * index.documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
        names = spark.createDataFrame([(i, r["key"]) for i, r in enumerate(rows)], f"at long, key {kind.simpleString()}")
        order = Window.partitionBy("at").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        ranked = _answers(index, wanted, weights, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        parts.append(stored(ranked.join(F.broadcast(names), "at").select("key", "rank", F.col("id").alias("doc_id"), "score"), "ranked"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    forget(items)
    taken = key.lower() in ("rank", "doc_id", "score")
    return out.withColumnRenamed("key", f"_{key}" if taken else key)


def ranking_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Each benchmark item's ten best documents."""
    index = build_index(docs)
    out = search(index, items)
    forget(index.shards)
    return out


RANKING_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
n AS (SELECT r, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
total AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM n),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
q AS (
  SELECT item_id, text, term, count(*) AS times FROM (
    SELECT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY item_id, text, term),
w AS (
  SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, total WHERE term IN (SELECT term FROM q) GROUP BY term),
p AS (
  SELECT item_id, q.text, n.r, n.doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN n ON n.r = tf.r, total GROUP BY item_id, q.text, n.r, n.doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM p WHERE score > 0)
WHERE rank <= 10"""
