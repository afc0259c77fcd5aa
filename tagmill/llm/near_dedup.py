"""Near-duplicate documents by bottom-k sketches of word shingles, with exact verification.

One hash function: a document's sketch is the SKETCH smallest hashes of its distinct shingles. Documents with
equal shingle sets form one class first. Sketch values are inverted to lists of classes; two sets as similar as
the threshold share at least an overlap of SKETCH values (but for a chance below 1e-10: 32 at 85 %, 28 at 80 %), so
each class enters only the lists of its rarest SKETCH - overlap + 1 values, and must meet every partner in one. Pairs from the
lists are filtered by the similarity estimated from the union's sketch, and verified on the shingles themselves:
words are numbered, so a hash never decides on a link.

No list is expanded into all its pairs. Every member is first paired with the list's first and last member;
verified links are joined to components. The members of lists that still span several components are inverted
once more, by all their shingles: two sets that are similar enough share one of each one's rarest shingles, so
sets that have only a common passage in common no longer meet. What still meets across components is compared
in tasks of bounded size. Links inside a component cannot change the result.

Keys that hold many rows (a value of a great group of copies, the first member of a long list) are joined by
broadcast or dealt over several tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import forget, heavy_above, join_heavy, stored, text_column, text_slices
from tagmill.llm.wordhash import lowered, mix64, sequence_hashes, window_hashes, word_hashes, word_spans

SHINGLE = 5
SKETCH = 64
OVERLAP = 32
#: The chance that a pair at the threshold shares fewer values of its sketches.
MISSED = 1e-10
#: Texts, and shingles of all texts together, of each of the two chunks that a task compares.
CHUNK = 512
CHUNK_SHINGLES = 250_000
#: Bytes of texts that are verified in one go.
VERIFY_BYTES = 2_000_000


def least_overlap(percent: int, k: int = SKETCH) -> int:
    """How many of k values two sets at the threshold share but for a chance of MISSED; OVERLAP at most, 1 at least."""
    p, below, n = percent / 100, 0.0, 0
    while n < OVERLAP and (below := below + math.comb(k, n) * p**n * (1 - p) ** (k - n)) <= MISSED:
        n += 1
    return max(n, 1)


def _sets(owner: np.ndarray, values: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of distinct values of each text, sorted, as places in `values`; and the bounds between texts."""
    order = np.lexsort((values, owner))
    o, v = owner[order], values[order]
    first = np.ones(len(order), bool)
    first[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    return order[first], np.searchsorted(o[first], np.arange(texts + 1))


def _windows(at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end and text of each shingle; a text of fewer words than `size`, but some, is one shingle."""
    n = np.diff(at)
    counts = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(n)), counts)
    first = np.arange(len(owner)) + np.repeat(at[:-1] - (np.cumsum(counts) - counts), counts)
    return first, np.minimum(first + size, at[1:][owner]), owner


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, hashes of a second lane, and bounds between texts."""
    lanes = []
    for lane in (0, 1):
        words, at = word_hashes(data, bounds, lower=True, lane=lane)
        first, end, owner = _windows(at, size)
        hashes = np.empty(len(first), np.uint64)
        whole = end - first == size
        hashes[whole] = window_hashes(words, at, size, lane)[0]
        hashes[~whole] = sequence_hashes(words, first[~whole], end[~whole], lane)
        lanes.append(hashes)
    keep, to = _sets(owner, lanes[0], len(bounds) - 1)
    return lanes[0][keep], lanes[1][keep], to


def exact_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The shingle set of each text as sorted numbers, equal for equal shingles of these texts and only for those."""
    bounds = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    data = lowered(np.frombuffer(b"".join(texts), np.uint8))
    starts, ends, at = word_spans(data, bounds)
    if not len(starts):
        return [np.empty(0, np.int64)] * len(texts)
    # words without the space between them, numbered by what they are
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    # a word that ends where a text does may touch the next text's first word
    letters = data[np.cumsum(inside[:-1]) > 0]
    offsets = np.r_[0, np.cumsum(ends - starts)]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    number = np.asarray(words.dictionary_encode().indices).astype(np.int64)
    first, end, owner = _windows(at, size)
    final = len(number) - 1
    # the j-th word of every shingle, -1 where a short text has none; never the words of all places at once
    word = lambda j: np.where(first + j < end, number[np.minimum(first + j, final)], -1)
    key = np.zeros(len(first), np.uint64)
    for j in range(size):
        key = mix64(key ^ word(j).astype(np.uint64))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    differ = np.zeros(len(same), bool)
    for j in range(size):
        placed = word(j)[order]
        differ |= placed[1:] != placed[:-1]
    if (same & differ).any():  # two shingles with one key
        ids = np.unique(np.stack([word(j) for j in range(size)], axis=1), axis=0, return_inverse=True)[1].ravel()
    else:
        ids = np.empty(len(first), np.int64)
        ids[order] = np.r_[0, np.cumsum(~same)]
    keep, to = _sets(owner, ids, len(texts))
    return [ids[keep[a:b]] for a, b in zip(to[:-1].tolist(), to[1:].tolist())]


def _signatures(docs: DataFrame, key: str, text: str, size: int, k: int) -> DataFrame:
    """A row for each document: its key, set size, a digest of its set, and its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_column(batch, text)
            for a, b in text_slices(bounds):
                sets, second, at = shingle_sets(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], size)
                each = list(zip(at[:-1].tolist(), at[1:].tolist()))
                digest = lambda x, y: hashlib.blake2b(sets[x:y].tobytes() + second[x:y].tobytes(), digest_size=16).digest()  # noqa: B023, E731
                cols = [
                    batch.column(key).slice(a, b - a),
                    pa.array(np.diff(at)),
                    pa.array([digest(x, y) for x, y in each], pa.binary()),
                    pa.array([sets[x : min(x + k, y)].tobytes() for x, y in each], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["id", "n", "digest", "sketch"])

    return docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, "id long, n long, digest binary, sketch binary")


def _entries(classes: DataFrame) -> DataFrame:
    """A row for each value of each class's sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = batch.column("sketch").to_pylist()
            sizes = np.array([len(s) // 8 for s in sketches])
            values = np.frombuffer(b"".join(sketches), np.int64)
            cols = [pa.array(np.repeat(np.asarray(batch.column(c)), sizes)) for c in ("id", "set", "n")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(values)], ["id", "set", "n", "value"])

    return classes.select("id", "set", "n", "sketch").mapInArrow(run, "id long, set long, n long, value long")


def _lists(entries: DataFrame, total: int, least: Column) -> DataFrame:
    """value, id, low, high, size: the inverted lists, of two sets at least, that must show every similar pair; stored.

    entries: id, set (which tells an id's sets apart), n and value. `least` is how many of a set's values any
    partner must share; so each set enters the lists of all but its least - 1 most frequent ones.
    """
    much = heavy_above(total)
    shared = stored(entries.groupBy("value").agg(F.count("*").alias("times")).where("times > 1"), "shared")
    mine = join_heavy(entries, shared, "value", shared.where(F.col("times") > much))
    mine = mine.groupBy("id", "set", "n").agg(F.sort_array(F.collect_list(F.struct("times", "value"))).alias("vs"))
    # values of no other set are the rarest, and need no list
    take = F.greatest(F.size("vs") - least + 1, F.lit(0)).cast("int")
    picked = mine.select("id", F.explode(F.slice("vs", 1, take)).alias("v"))
    # written, as each of its uses would repeat its plan on the driver
    picked = stored(picked.select(F.col("v.value").alias("value"), "id"), "picked")
    ends = picked.groupBy("value").agg(F.count("*").alias("size"), F.min("id").alias("low"), F.max("id").alias("high")).where("size > 1")
    lists = stored(join_heavy(picked, ends, "value", ends.where(F.col("size") > much)), "lists")
    forget(shared, picked)
    return lists


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def estimates(x: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
    """The similarity of each row's two sets from the k smallest values of their sketches' union.

    x and y have a sketch in each row, filled up with the largest number, which is no value.
    """
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    both = np.sort(np.concatenate([x, y], axis=1), axis=1)
    twice = np.zeros(both.shape, bool)
    twice[:, 1:] = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != none)
    rank = np.cumsum(~twice & (both != none), axis=1)
    shared = (twice & (rank <= k)).sum(axis=1)
    return shared / np.maximum(np.minimum(rank[:, -1], k), 1)


def _sketch_rows(col: pa.Array, k: int) -> np.ndarray:
    rows = col.to_pylist()
    out = np.full((len(rows), k), 0xFFFFFFFFFFFFFFFF, np.uint64)
    sizes = np.array([len(r) // 8 for r in rows])
    out[np.arange(k) < sizes[:, None]] = np.frombuffer(b"".join(rows), np.uint64)
    return out


def _hubs(pairs: DataFrame, side: DataFrame, first: str, second: str, total: int) -> dict[str, DataFrame]:
    """For `first` and `second`, joined with side's ids in this order: id and parts of ids with very many pairs; stored.

    Both are counted on the pairs: a plan that counted the second on what the first join gives would hold that
    join three times. A pair counts to its second as often as side has its first.
    """
    much = heavy_above(total)
    many = lambda c, rows: stored(rows.groupBy(F.col(c).alias("id")).agg(F.sum("n_").alias("n_")).where(F.col("n_") > much).select("id", F.ceil(F.col("n_") / much).cast("int").alias("parts")), "hubs")
    again = stored(side.groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1"), "again")
    times = pairs.join(again.withColumnRenamed("id", first), first, "left").withColumn("n_", F.coalesce("rows", F.lit(1)))
    hubs = {first: many(first, pairs.withColumn("n_", F.lit(1))), second: many(second, times)}
    forget(again)
    return hubs


def _beside(pairs: DataFrame, side: DataFrame, mine: str, other: str, hubs: dict[str, DataFrame]) -> DataFrame:
    """pairs joined with side on `mine`; the pairs of a hub are dealt over its parts, with a copy of its row for each."""
    own = hubs[mine].withColumnRenamed("id", mine)
    parts = F.coalesce("parts", F.lit(1))
    marked = pairs.join(F.broadcast(own), mine, "left").withColumn("part", F.pmod(F.xxhash64(other), parts).cast("int")).drop("parts")
    copies = side.join(F.broadcast(own), mine, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return marked.join(copies, [mine, "part"]).drop("part")


def _promising(pairs: DataFrame, classes: DataFrame, k: int, least: float, hubs: dict[str, DataFrame]) -> DataFrame:
    """The pairs whose estimated similarity reaches `least`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = estimates(_sketch_rows(batch.column("sketch_a"), k), _sketch_rows(batch.column("sketch_b"), k), k) >= least
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    side = lambda c: classes.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
    both = _beside(_beside(pairs, side("a"), "a", "b", hubs), side("b"), "b", "a", hubs)
    near = F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * least
    # an id with several sets has a row for each
    return both.where(near).select("a", "b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long").distinct()


def _packed_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """id, body: each document's text, deflated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            bodies = [z.compress((t or "").encode()) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(bodies, pa.binary())], ["id", "body"])

    return docs.select(F.col(key).cast("long").alias(key), text).where(F.col(key).isNotNull()).mapInArrow(run, "id long, body binary")


def _verified(pairs: DataFrame, bodies: DataFrame, size: int, percent: int, hubs: dict[str, DataFrame]) -> DataFrame:
    """The pairs that are similar by their full shingle sets."""

    def similar(texts: dict[bytes, int], plain: list[bytes], which: list[tuple[int, int]]) -> list[bool]:
        sets, out = exact_sets(plain, size), []
        for i, j in which:
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            out.append(common > 0 and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for batch in batches:
            good: list[bool] = []
            texts, plain, which, held = {}, [], [], 0
            for both in zip(batch.column("body_a"), batch.column("body_b"), strict=True):
                pair = [body.as_py() for body in both]
                for body in pair:
                    if body not in texts:
                        texts[body] = len(plain)
                        plain.append(z.decompress(body))
                        held += len(plain[-1])
                which.append((texts[pair[0]], texts[pair[1]]))
                if held > VERIFY_BYTES:
                    good += similar(texts, plain, which)
                    texts, plain, which, held = {}, [], [], 0
            good += similar(texts, plain, which)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    side = lambda c: bodies.select(F.col("id").alias(c), F.col("body").alias(f"body_{c}"))
    return _beside(_beside(pairs, side("b"), "b", "a", hubs), side("a"), "a", "b", hubs).mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """id, root: for every id in links (a, b), the smallest id it is connected with; stored.

    Alternates between linking each id's larger neighbours, and each id, to its smallest neighbour, until
    nothing changes; both halves of a round are written to the shared folder, which keeps their plans small.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    summary = lambda: edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before, now = None, summary()
    while now != before:
        much = heavy_above(2 * now[0])
        both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("times"))
        wide = join_heavy(both, low, "u", low.where(F.col("times") > much)).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ups = stored(edges.union(wide).where("u <> v"), "links")
        least = ups.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("times"))
        hop = join_heavy(ups, least, "u", least.where(F.col("times") > much)).select(F.col("v").alias("u"), F.col("m").alias("v"))
        linked = least.select("u", F.col("m").alias("v")).union(hop).where("u <> v")
        last, edges = edges, stored(linked.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
        forget(last, ups)
        before, now = now, summary()
    stars = edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("id"), "root")
    roots = stored(stars.union(edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()).groupBy("id").agg(F.min("root").alias("root")), "roots")
    forget(edges)
    return roots


def common_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many numbers each of the sets `left` has in common with each of `right`."""
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    many = np.bincount(column, minlength=len(values)) > 1
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    keep = many[column]
    owner, column, width = owner[keep], (np.cumsum(many) - 1)[column[keep]], int(many.sum())
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)))
    for at in range(0, width, 2048):
        a, b = np.searchsorted(column, [at, at + 2048])
        part = np.zeros((len(sets), min(2048, width - at)), np.float32)
        part[owner[a:b], column[a:b] - at] = 1
        out += part[left] @ part[right].T
    return out.astype(np.int64)


def _shingles(members: DataFrame, bodies: DataFrame, size: int) -> DataFrame:
    """A row for each shingle of each of the members' texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for batch in batches:
            plain = [z.decompress(b) for b in batch.column("body").to_pylist()]
            bounds = np.r_[0, np.cumsum([len(t) for t in plain])].astype(np.int64)
            ids = np.asarray(batch.column("id"))
            for a, b in text_slices(bounds):
                data = np.frombuffer(b"".join(plain[a:b]), np.uint8)
                values, _, at = shingle_sets(data, bounds[a : b + 1] - bounds[a], size)
                n = np.diff(at)
                # which of an id's texts it is
                which = np.array([int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little", signed=True) for t in plain[a:b]], np.int64)
                cols = [np.repeat(ids[a:b], n), np.repeat(which, n), np.repeat(n, n), values.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["id", "set", "n", "value"])

    return bodies.join(members, "id", "left_semi").select("id", "body").mapInArrow(run, "id long, set long, n long, value long")


def _rest(lists: DataFrame, bodies: DataFrame, roots: DataFrame, size: int, percent: int) -> DataFrame:
    """Verified links across components between members of lists of four or more that still span several.

    These members are inverted by all their shingles: each enters the lists of its rarest ones, of which any
    set as similar as percent % shares one. Lists with the same first member are one bundle, so members that
    share many lists meet once. A bundle is cut into chunks; each pair of chunks is a task of its own, which
    counts what its sets have in common, pair by pair as products of matrices.
    """
    spanning = lambda some: some.groupBy("value").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("times")).where("x <> y").select("value", "times")
    rooted = lambda some: some.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    open_lists = rooted(lists.where("size > 3").select("value", "id"))
    split = stored(spanning(open_lists), "split")
    members = join_heavy(open_lists, split, "value", split.where(F.col("times") > heavy_above(lists.count()))).select("id").distinct()
    entries = stored(_shingles(members, bodies, size), "shingles")
    total = entries.count()
    forget(split)
    narrow = _lists(entries, total, F.ceil(F.col("n") * percent / 100))
    again = rooted(narrow.select("value", "id", "low"))
    split = stored(spanning(again), "split")
    meets = join_heavy(again, split, "value", split.where(F.col("times") > heavy_above(total))).groupBy("low", "id").agg(F.min("root").alias("root"))
    meets = stored(meets.join(entries.groupBy("id").agg(F.count("*").alias("n")), "id"), "meets")
    weight = F.greatest(F.count("*") / CHUNK, F.sum("n") / CHUNK_SHINGLES)
    sizes = meets.groupBy("low").agg(F.ceil(weight).cast("int").alias("chunks"), F.count("*").alias("times"))
    dealt = join_heavy(meets, sizes, "low", sizes.where(F.col("times") > heavy_above(meets.count())))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.select("low", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "mine", "id", "root")
    dealt = dealt.join(bodies, "id")

    def compare(group: pa.Table) -> pa.Table:
        x, y = group.column("x")[0].as_py(), group.column("y")[0].as_py()
        mine, ids, root = (np.asarray(group.column(c).combine_chunks()) for c in ("mine", "id", "root"))
        z = zstandard.ZstdDecompressor()
        sets = exact_sets([z.decompress(b) for b in group.column("body").to_pylist()], size)
        n = np.array([len(s) for s in sets])
        left, right = np.flatnonzero(mine == x), np.flatnonzero(mine == y)
        common = common_counts(sets, left, right)
        near = 100 * common >= percent * (n[left][:, None] + n[right][None, :] - common)
        near &= (common > 0) & (root[left][:, None] != root[right][None, :])
        if x == y:
            near &= ids[left][:, None] < ids[right][None, :]
        joined: dict[int, int] = {}

        def top(r: int) -> int:
            while (up := joined.get(r, r)) != r:
                r = up
            return r

        links = []
        # one link for each two components is enough
        for i, j in np.argwhere(near).tolist():
            i, j = left[i], right[j]
            ri, rj = top(int(root[i])), top(int(root[j]))
            if ri != rj:
                joined[max(ri, rj)] = min(ri, rj)
                links.append((ids[i], ids[j]))
        return pa.table([pa.array([p[i] for p in links], pa.int64()) for i in (0, 1)], ["a", "b"])

    found = stored(dealt.groupBy("low", "x", "y").applyInArrow(compare, "a long, b long"), "verified")
    forget(entries, narrow, split, meets)
    return found


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = 85, k: int = SKETCH, overlap: int | None = None
) -> DataFrame:
    """n_shingles, component_id and kept for each row's key: who is connected by similarities of percent % or more.

    Words are runs of bytes other than space and bytes 9 to 13, with A-Z in lower case; a text's set is its
    distinct `size`-word shingles, of a shorter text its whole sequence. `overlap` follows from percent. Null and empty texts and texts without
    words have an empty set and link with nothing. component_id is the smallest key reachable; kept says that
    the key is that. A row with a null key links with nothing, has a null component_id and is kept. Rows with
    one key give a row each, are connected with each other, and connect what their texts are similar to; rows
    without words are not. An empty table gives none. The key must be an integer; the
    result has no other columns of `docs`, so clashing names do not matter. Texts are taken whole, however long;
    a task that compares a text holds all its shingles.
    """
    overlap = least_overlap(percent, k) if overlap is None else overlap
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    signed = stored(_signatures(rows, "id", "text", size, k), "signatures")
    keyed = signed.where("id is not null and n > 0")
    # one row for each class: its smallest member, whose sketch is every member's
    first = F.min(F.struct("id", "n", "sketch")).alias("m")
    classes = keyed.groupBy("digest").agg(first, F.count("*").alias("times")).select("digest", "m.*", "times")
    classes = stored(classes.withColumn("set", F.xxhash64("digest")), "classes")
    held, whole = F.least(F.col("n"), F.lit(k)), F.col("n") * 100 <= F.lit(k * percent)
    # a set whose partners all fit their sketches too has at least percent % of it in common with any of them
    least = F.when(whole, F.ceil(F.col("n") * percent / 100)).otherwise(F.lit(overlap))
    total = classes.agg(F.coalesce(F.sum(held), F.lit(0)), F.coalesce(F.sum("times"), F.lit(0))).first()
    lists = _lists(_entries(classes), total[0], least)
    stars = lists.select(F.col("id").alias("a"), F.explode(F.array("low", "high")).alias("b"))
    pairs = stored(_ordered(stars), "pairs")
    n_pairs = pairs.count()
    hubs = _hubs(pairs, classes, "a", "b", n_pairs)
    likely = stored(_promising(pairs, classes, k, overlap / k, hubs), "pairs")
    forget(*hubs.values())
    texts = _packed_texts(rows, "id", "text")
    bodies = stored(texts.join(lists.select("id").distinct(), "id", "left_semi").dropDuplicates(["id", "body"]), "bodies")
    hubs = _hubs(likely, bodies, "b", "a", n_pairs)
    links = stored(_verified(likely, bodies, size, percent, hubs), "verified")
    forget(*hubs.values())
    roots = components(links)
    more = _rest(lists, bodies, roots, size, percent)
    # a key with several texts connects their classes
    several = keyed.select("id", F.xxhash64("digest").alias("set")).groupBy("id").agg(F.min("set").alias("x"), F.max("set").alias("y")).where("x <> y").select("id")
    heavy = classes.where(F.col("times") > heavy_above(total[1]))
    same = join_heavy(keyed.join(several, "id", "left_semi").select("id", "digest").distinct(), classes.select("digest", F.col("id").alias("rep")), "digest", heavy.select("digest", F.col("id").alias("rep")))
    # what is connected already is a star by now
    stars, roots = roots, components(roots.select("id", "root").toDF("a", "b").union(more).union(same.select(F.col("id").alias("a"), F.col("rep").alias("b"))))
    forget(lists, pairs, likely, bodies, links, more, stars)
    named = classes.join(roots, "id", "left").select("digest", F.coalesce("root", "id").alias("root"), "times")
    out = join_heavy(keyed.select("id", "n", "digest"), named, "digest", named.where(F.col("times") > heavy_above(total[1]))).select("id", "n", "root")
    alone = signed.where("id is null or n = 0").select("id", "n", F.col("id").alias("root"))
    return out.union(alone).select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("root").alias("component_id"), F.coalesce(F.col("id") == F.col("root"), F.lit(True)).alias("kept")
    )


def near_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document, at 85 %."""
    return near_duplicates(docs)
