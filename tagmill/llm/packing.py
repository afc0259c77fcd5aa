"""Best-fit packing of documents into sequences of a fixed number of tokens, under conflicts.

A bin may hold one piece of each source and of each cluster of duplicates only. Bins stand in the order of their
residual room; each carries bitmaps of its sources and clusters. A piece goes to the first bin, from the tightest
that has room upwards, that has neither its source nor its cluster; if none has, to a new one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import text_column, text_slices
from tagmill.llm.wordhash import word_spans

CAPACITY = 2048
#: Documents that are packed together; bins do not span such groups.
GROUP = 8192


class Bins:
    """Open bins in the order of residual room, with bitmaps."""

    def __init__(self, capacity: int, sources: int, clusters: int) -> None:
        self.capacity, self.made = capacity, 0
        self.room, self.ids = np.empty(1024, np.int64), np.empty(1024, np.int64)
        # a column of 64 bits for every 64 sources or clusters
        self.maps = np.zeros((-(-(sources + clusters) // 64) or 1, 1024), np.uint64)
        self.n, self.clusters_at = 0, sources

    def place(self, size: int, source: int, cluster: int) -> int:
        """The bin for a piece; cluster -1: no other piece of its cluster here."""
        bits = [source] + ([self.clusters_at + cluster] if cluster >= 0 else [])
        n = self.n
        at = int(np.searchsorted(self.room[:n], size))
        while at < n:
            # successor search, a stretch of bins at a time
            to = min(n, at + 256)
            taken = np.zeros(to - at, bool)
            for b in bits:
                taken |= (self.maps[b >> 6, at:to] >> np.uint64(b & 63)) & np.uint64(1) > 0
            free = int(taken.argmin())
            if not taken[free]:
                return self._fill(at + free, size, bits)
            at = to
        if n == len(self.room):
            self.room, self.ids = np.resize(self.room, 2 * n), np.resize(self.ids, 2 * n)
            self.maps = np.concatenate([self.maps, np.zeros_like(self.maps)], axis=1)
        self.room[n], self.ids[n], self.maps[:, n] = self.capacity, self.made, 0
        self.made, self.n = self.made + 1, n + 1
        return self._fill(n, size, bits)

    def _fill(self, at: int, size: int, bits: list[int]) -> int:
        """Put a piece into the bin at `at`, and move the bin to its new place in the order."""
        room, made = int(self.room[at]) - size, int(self.ids[at])
        column = self.maps[:, at].copy()
        for b in bits:
            column[b >> 6] |= np.uint64(1) << np.uint64(b & 63)
        to = int(np.searchsorted(self.room[:at], room))
        for a in (self.room, self.ids):
            a[to + 1 : at + 1] = a[to:at].copy()
        self.maps[:, to + 1 : at + 1] = self.maps[:, to:at].copy()
        self.room[to], self.ids[to], self.maps[:, to] = room, made, column
        if room == 0:  # full: no piece of one token or more can follow
            self.n -= 1
            for a in (self.room, self.ids):
                a[to : self.n] = a[to + 1 : self.n + 1].copy()
            self.maps[:, to : self.n] = self.maps[:, to + 1 : self.n + 1].copy()
        return made


def _measured(docs: DataFrame, keys: list[str], text: str) -> DataFrame:
    """The keys of each document, its number of words, and a digest of its words as its cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_column(batch, text)
            sizes, digests = [], []
            for a, b in text_slices(bounds):
                raw = data[bounds[a] : bounds[b]].tobytes()
                at = word_spans(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])[2]
                sizes += np.diff(at).tolist()
                ends = (bounds[a : b + 1] - bounds[a]).tolist()
                for x, y in zip(ends, ends[1:]):
                    words = b" ".join(raw[x:y].lower().split())
                    digests.append(int.from_bytes(hashlib.blake2b(words, digest_size=8).digest(), "little", signed=True))
            cols = [batch.column(c) for c in keys]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sizes, pa.int64()), pa.array(digests, pa.int64())], [*keys, "size", "cluster"])

    return docs.select(*keys, text).mapInArrow(run, "id long, source string, size long, cluster long")


def pack_bins(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """doc_id, piece, start, n_tokens, bin_id, bin_tokens for every piece of every document.

    Tokens are words. A text of more than `capacity` words is cut into pieces of `capacity` and a rest; start
    is a piece's first word. Pieces are placed by decreasing size, then key, then piece. The cluster of a
    document is its sequence of words in lower case; so a document's equal copies, and its own pieces, never
    share a bin, nor do two documents of one source. A null source is a source of its own. A null, empty or
    blank text has one piece of 0 tokens. Repeated rows are packed each. An empty table gives none. Documents are
    dealt by a hash of key and cluster to groups of about `group`, each packed by itself; bin_id is unique over
    all. The result names the key as it is in `docs`; it has no other columns of `docs`.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(source).cast("string"), F.lit("\0")).alias("source"), F.col(text).alias("text"))
    sized = _measured(rows, ["id", "source"], "text")
    groups = max(1, -(-docs.count() // group))
    dealt = sized.withColumn("group", F.pmod(F.xxhash64("id", "cluster"), F.lit(groups)))
    names = ["id", "piece", "start", "n_tokens", "bin_id", "bin_tokens"]

    def run(part: pa.Table) -> pa.Table:
        size, ids, cluster = (np.asarray(part.column(c).combine_chunks().fill_null(-1)) for c in ("size", "id", "cluster"))
        _, sources = np.unique(np.array(part.column("source").to_pylist(), object).astype(str), return_inverse=True)
        pieces = np.maximum(-(-size // capacity), 1)
        doc = np.repeat(np.arange(len(size)), pieces)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        tokens = np.minimum(size[doc] - piece * capacity, capacity)
        _, back, times = np.unique(cluster[doc], return_inverse=True, return_counts=True)
        alone = times[back] == 1
        _, dense = np.unique(np.where(alone, -1, back), return_inverse=True)
        dense = np.where(alone, -1, dense - (1 if alone.any() else 0))
        bins = Bins(capacity, int(sources.max()) + 1, int(dense.max()) + 1)
        put = np.empty(len(doc), np.int64)
        for i in np.lexsort((piece, cluster[doc], ids[doc], -tokens)).tolist():
            put[i] = bins.place(int(tokens[i]), int(sources[doc[i]]), int(dense[i]))
        filled = np.bincount(put, weights=tokens, minlength=bins.made).astype(np.int64)
        base = int(part.column("group")[0].as_py()) << 32
        key_col = part.column("id").combine_chunks().take(pa.array(doc))
        return pa.table([key_col, pa.array(piece), pa.array(piece * capacity), pa.array(tokens), pa.array(base + put), pa.array(filled[put])], names)

    packed = dealt.groupBy("group").applyInArrow(run, ", ".join(f"{c} long" for c in names))
    return packed.withColumnRenamed("id", key)
