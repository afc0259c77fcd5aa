"""Approximate nearest neighbours by additive quantisation.

A vector's direction is encoded as a sum of one full-dimensional codeword from each of several codebooks; its
length is stored beside the codes, so lengths of any size are told apart. Codebooks start as k-means of residuals
and are refitted in turn on a bounded sample; beam search finds the codes. With one lookup table for each
codebook the squared distance to a query follows from the stored length and the looked-up products. Blocks of
queries meet chunks of the index, which hold codes and lengths only; the best RERANK candidates of each query over
all chunks are joined with their vectors and ranked by exact distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.llm.common import stored

BOOKS = 24
WORDS = 256
BEAM = 8
#: Vectors that the codebooks are fitted on, at most; numbers in all of them, and in all codebooks, at most.
SAMPLE = 8192
SAMPLE_NUMBERS = 8_000_000
CHUNK = 16_384
QUERY_BLOCK = 512
#: Candidates of a query that are compared exactly, over the whole index.
RERANK = 100
#: A query that is so many times longer or shorter than the sample's median is compared with all vectors exactly:
#: rounding, not direction, orders its neighbours.
EXTREME = 1e12


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        near = (x @ centres.T * -2 + (centres**2).sum(1)).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=k)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """Codes of vectors by beam search over the codebooks in order; books: codebooks x words x dimensions."""
    n, (m, k, d) = len(x), books.shape
    codes = np.zeros((n, 1, 0), np.uint8)
    residual = x[:, None, :].astype(np.float32)
    for j in range(m):
        error = (residual**2).sum(2)[:, :, None] - 2 * residual @ books[j].T + (books[j] ** 2).sum(1)
        flat = error.reshape(n, -1)
        keep = min(beam, flat.shape[1])
        best = np.argpartition(flat, keep - 1, axis=1)[:, :keep] if keep < flat.shape[1] else np.tile(np.arange(keep), (n, 1))
        parent, word = best // k, best % k
        rows = np.arange(n)[:, None]
        codes = np.concatenate([codes[rows, parent], word[:, :, None].astype(np.uint8)], axis=2)
        residual = residual[rows, parent] - books[j][word]
    last = (residual**2).sum(2).argmin(1)
    return codes[np.arange(n), last]


def decode(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    """The sums of codewords."""
    return sum(books[j][codes[:, j]] for j in range(len(books)))


def fit(x: np.ndarray, books: int = BOOKS, words: int = WORDS, rounds: int = 3, seed: int = 7) -> np.ndarray:
    """Codebooks: residual k-means, then rounds of beam-search codes and of refitting each codebook to what the others leave."""
    rng = np.random.default_rng(seed)
    x = x.astype(np.float32)
    rest, made = x.copy(), []
    # a small sample cannot tell many words apart
    words = int(max(1, min(words, len(x) // 4 + 1, SAMPLE_NUMBERS // (books * x.shape[1]) + 1)))
    for _ in range(books):
        centres = _kmeans(rest, words, rng)
        rest = rest - centres[(rest @ centres.T * -2 + (centres**2).sum(1)).argmin(1)]
        made.append(centres)
    out = np.stack(made)
    for _ in range(rounds):
        codes = encode(x, out).astype(np.int64)
        rest = x - decode(codes, out)
        for j in np.tile(np.arange(books), 2).tolist():
            target = rest + out[j][codes[:, j]]
            sums, n = np.zeros_like(out[j]), np.bincount(codes[:, j], minlength=words)
            np.add.at(sums, codes[:, j], target)
            out[j][n > 0] = sums[n > 0] / n[n > 0, None]  # unused words stay where they are
            rest = target - out[j][codes[:, j]]
    return out


def usable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """Rows with a key and a finite, non-zero vector without nulls."""
    bad = F.exists(column, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    some = F.exists(column, lambda v: v != 0)
    return vectors.where(F.col(key).isNotNull() & F.col(column).isNotNull() & F.coalesce(~bad & some, F.lit(False)))


def _matrix(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return np.asarray(col.flatten()).reshape(len(col), -1) if len(col) else np.empty((0, 0))


def directions(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and lengths, whatever the size of the numbers."""
    most = np.abs(v).max(axis=1)
    scaled = v / most[:, None]
    size = np.sqrt((scaled**2).sum(1))
    with np.errstate(over="ignore"):
        return scaled / size[:, None], most * size


def exact_distances(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to q; numbers whose squares leave the doubles are scaled first."""
    with np.errstate(over="ignore", under="ignore"):
        d = v - q
        out = np.sqrt((d**2).sum(1))
        odd = np.flatnonzero(~np.isfinite(out) | (out < 1e-150))
        most = np.abs(d[odd]).max(axis=1) if len(odd) else np.empty(0)
        scale = np.where((most > 0) & np.isfinite(most), most, 1.0)
        out[odd] = scale * np.sqrt(((d[odd] / scale[:, None]) ** 2).sum(1))
    return out


def smallest(values: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k smallest values, ties by id, in order."""
    if k < len(values):
        edge = np.partition(values, k - 1)[k - 1]
        at = np.flatnonzero(values <= edge)
    else:
        at = np.arange(len(values))
    return at[np.lexsort((ids[at], values[at]))[:k]]


_FOUND = "query_id long, id long, guess double"


def _guesses(books, rerank: int):
    def compare(probe: pa.Table, part: pa.Table) -> pa.Table:
        names = ["query_id", "id", "guess"]
        if not probe.num_rows or not part.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        asks, ids = np.asarray(probe.column("id")), np.asarray(part.column("id"))
        codes = np.frombuffer(b"".join(part.column("codes").to_pylist()), np.uint8).reshape(len(ids), -1).T.copy()
        lengths = np.asarray(part.column("length"))
        unit, size = directions(_matrix(probe.column("v")))
        several = len(np.unique(ids)) < len(ids)
        out = []
        for a in range(len(asks)):
            lookup = books.value @ unit[a].astype(np.float32)
            dot = np.zeros(len(ids))
            for j in range(len(lookup)):
                dot += lookup[j][codes[j]]
            with np.errstate(over="ignore", invalid="ignore"):
                r = lengths / size[a]
                guess = np.nan_to_num(r * (r - 2 * dot), nan=np.inf)
            keep = np.flatnonzero(ids != asks[a])
            if several:  # each key by its best row
                order = keep[np.lexsort((guess[keep], ids[keep]))]
                keep = order[np.r_[True, ids[order][1:] != ids[order][:-1]]] if len(order) else order
            mine, known = ids[keep], guess[keep]
            near = smallest(known, mine, rerank)
            out.append((np.full(len(near), asks[a]), mine[near], known[near]))
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names)

    return compare


def _all_compared(k: int):
    def compare(probe: pa.Table, part: pa.Table) -> pa.Table:
        names = ["query_id", "id", "guess"]
        if not probe.num_rows or not part.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        asks, ids = np.asarray(probe.column("id")), np.asarray(part.column("id"))
        q, v = _matrix(probe.column("v")), _matrix(part.column("v"))
        out = []
        for a in range(len(asks)):
            score = exact_distances(v, q[a])
            order = np.lexsort((score, ids))
            order = order[(ids[order] != asks[a]) & np.r_[True, ids[order][1:] != ids[order][:-1]]]
            near = order[smallest(score[order], ids[order], k)]
            out.append((np.full(len(near), asks[a]), ids[near], score[near]))
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names)

    return compare


def _within(books, k: int):
    """Of a chunk each query's k nearest rows that can be at its distance `kth` or nearer, by codes and errors, then exactly."""

    def compare(probe: pa.Table, part: pa.Table) -> pa.Table:
        names = ["query_id", "id", "guess"]
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if probe.num_rows and part.num_rows:
            asks, ids, kth = (np.asarray(x) for x in (probe.column("id"), part.column("id"), probe.column("kth")))
            q, v = _matrix(probe.column("v")), _matrix(part.column("v"))
            codes = np.frombuffer(b"".join(part.column("codes").to_pylist()), np.uint8).reshape(len(ids), -1).T.copy()
            length, error, square = (np.asarray(part.column(c)) for c in ("length", "error", "square"))
            unit, size = directions(q)
            words = books.value.astype(np.float64)
            for a in range(len(asks)):
                lookup, dot = words @ unit[a], np.zeros(len(ids))
                for j in range(len(lookup)):
                    dot += lookup[j][codes[j]]
                with np.errstate(all="ignore"):
                    r = length / size[a]
                    # the code's distance, a little less than rounding can add, and the error, in lengths of the query
                    least = np.sqrt(np.maximum(1 + r * (r * square - 2 * dot) - 1e-12 * (1 + r) ** 2, 0)) - r * error
                    near = ~(least > kth[a] / size[a] * (1 + 1e-9)) | ~np.isfinite(r)
                at = np.flatnonzero(near & (ids != asks[a]))
                score = np.concatenate([np.empty(0), *[exact_distances(v[at[x : x + 8192]], q[a]) for x in range(0, len(at), 8192)]])
                order = np.lexsort((score, ids[at]))
                order = order[np.r_[True, ids[at][order][1:] != ids[at][order][:-1]]] if len(order) else order
                best = order[smallest(score[order], ids[at][order], k)]
                out.append((np.full(len(best), asks[a]), ids[at][best], score[best]))
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names)

    return compare


def _met(asked: DataFrame, part: DataFrame, n_asked: int, chunks: int, compare) -> DataFrame:
    """compare(block of queries, chunk of rows) for every block and chunk."""
    blocks = max(1, -(-n_asked // QUERY_BLOCK))
    chunk, block = F.pmod(F.xxhash64("id"), F.lit(chunks)), F.pmod(F.xxhash64("id"), F.lit(blocks))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    side = part.withColumns({"chunk": chunk, "block": every(blocks)})
    probes = asked.select("id", "v", *[c for c in ("kth",) if c in asked.columns], block.alias("block"), every(chunks).alias("chunk"))
    return probes.groupBy("chunk", "block").cogroup(side.groupBy("chunk", "block")).applyInArrow(compare, _FOUND)


def _distance(v: Column, q: Column) -> Column:
    """The Euclidean distance of two arrays; scaled where squares leave the doubles."""
    total = lambda d, by: F.sqrt(F.aggregate(d, F.lit(0.0), lambda s, x: s + (x / by) * (x / by)))
    d = F.zip_with(v, q, lambda x, y: x - y)
    plain, most = total(d, F.lit(1.0)), F.array_max(F.transform(d, F.abs))
    odd = (most > 0) & (most < float("inf")) & ((plain == float("inf")) | (plain < 1e-150))
    return F.when(odd, most * total(d, most)).otherwise(plain)


def search(
    vectors: DataFrame, queries: Column, key: str = "vec_id", column: str = "embedding", k: int = 10, rerank: int = RERANK
) -> DataFrame:
    """query_id, rank, `key`, score: for each row where `queries` holds its k nearest other rows.

    Nearness is the Euclidean distance in double precision, smallest first, ties to the smaller key. Vectors
    that are null, zero, or hold a null or a non-finite number take no part, as rows with a null key; vectors of
    another length than the most frequent one take no part either. Rows with one key are one neighbour, or one
    query, at the distance of the nearest of them; rows with a query's own key are not its candidates. Fewer
    candidates than k give all of them; an empty table gives none. Codebooks are fitted in one task on at most
    SAMPLE vectors in the order of a hash of the key; every vector is indexed, and what the codes cannot rule out
    is compared exactly, so the result does not depend on that sample. The driver gathers the codebooks only. Queries of lengths beyond EXTREME are compared with all vectors. Other columns are not carried.
    """
    spark = vectors.sparkSession
    clean = usable(vectors.select(F.col(key).alias("id"), F.col(column).cast("array<double>").alias("v"), queries.alias("asks")), "id", "v")
    clean = clean.withColumn("d", F.size("v"))
    sizes = clean.groupBy("d").count().orderBy(F.desc("count"), "d").limit(1).collect()
    schema = f"query_id long, rank int, {key} long, score double"
    if not sizes:
        return spark.createDataFrame([], schema)
    d, total = sizes[0]["d"], sizes[0]["count"]
    clean = clean.where(F.col("d") == d).drop("d")
    most = max(256, min(SAMPLE, SAMPLE_NUMBERS // d))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, size = directions(np.concatenate([_matrix(b.column("v")) for b in batches]))
        made = fit(unit)
        yield pa.RecordBatch.from_arrays([pa.array([made.shape[1]]), pa.array([float(np.median(size))]), pa.array([made.tobytes()], pa.large_binary()).cast(pa.binary())], ["words", "median", "books"])

    picked = clean.select("v", F.xxhash64(F.col("id").cast("string")).alias("h"), "id").orderBy("h", "id").limit(most).coalesce(1)
    learned = picked.select("v").mapInArrow(learn, "words long, median double, books binary").first()
    books = spark.sparkContext.broadcast(np.frombuffer(bytes(learned["books"]), np.float32).reshape(-1, learned["words"], d))
    median = learned["median"]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                unit, size = directions(_matrix(part.column("v")))
                codes = encode(unit, books.value)
                made = decode(codes, books.value.astype(np.float64))
                error, square = np.sqrt(((unit - made) ** 2).sum(1)), (made**2).sum(1)
                codes = pa.array([c.tobytes() for c in codes], pa.binary())
                columns = [part.column("id"), part.column("v"), part.column("asks"), codes, pa.array(size), pa.array(error), pa.array(square)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "v", "asks", "codes", "length", "error", "square"])

    table = stored(clean.mapInArrow(index, "id long, v array<double>, asks boolean, codes binary, length double, error double, square double"), "additive-index")
    asked = stored(clean.where("asks").select("id", "v"), "additive-queries")
    odd = ~table["length"].between(median / EXTREME, median * EXTREME)
    n = table.where("asks").agg(F.count("*").alias("n"), F.count_if(odd).alias("odd")).first()
    chunks = max(1, -(-total // CHUNK))
    found = _met(asked, table.select("id", "codes", "length"), n["n"], chunks, _guesses(books, rerank))
    # the best of all chunks; what cannot be among them stays in its task
    best = Window.partitionBy("query_id").orderBy("guess", "id")
    near = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= rerank).select("query_id", "id").distinct()
    if n["odd"]:
        far = table.where(F.col("asks") & odd).select("id").distinct()
        sure = _met(asked.join(far, "id", "left_semi"), clean.select("id", "v"), n["odd"], chunks, _all_compared(k))
        near = near.union(sure.select("query_id", "id")).distinct()
    places = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))

    def ranked(found: DataFrame) -> DataFrame:
        pairs = found.join(table.select("id", "v"), "id").join(asked.select(F.col("id").alias("query_id"), F.col("v").alias("q")), "query_id")
        scored = pairs.groupBy("query_id", "id").agg(F.min(_distance(F.col("v"), F.col("q"))).alias("score"))
        return scored.withColumn("rank", places).where(F.col("rank") <= k)

    first = stored(ranked(near).select("query_id", "id", "score", "rank"), "additive-first")
    kth = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("kth"))
    bounded = asked.join(kth, "id", "left").na.fill({"kth": float("inf")})
    more = _met(bounded, table.drop("asks"), n["n"], chunks, _within(books, k))
    more = more.withColumn("r", F.row_number().over(best)).where(F.col("r") <= 2 * k).select("query_id", "id")
    out = ranked(first.select("query_id", "id").union(more).distinct())
    return out.select("query_id", "rank", F.col("id").alias(key), "score")


def neighbours_report(vectors: DataFrame) -> DataFrame:
    """The ten nearest of every vector whose id is divisible by 100."""
    return search(vectors, F.col("vec_id") % 100 == 0)
